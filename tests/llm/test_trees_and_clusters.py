"""The Merkle manifest, clustering and SimHash against plain versions, on odd rows."""

import glob
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from lorefold.llm import centroids, merkle, queries, simhash

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, hash string, _at long"
ROWS = [
    (1, "a\nb", "en", "s", 3), (2, None, None, "s", None), (3, "", "en", "", 0), (3, "é\n", "en", "", 2), (4, "x " * 20_000, "de", None, -5), (None, "y\n", "en", None, 2), (None, None, None, None, None),
    (5, "same", "en", "s", 4), (5, "same", "en", "s", 4), (6, "one two three", "en", "S", 13), (7, "日本語\nテ", "ja", "é", 5),
] + [(100 + i, f"t{i}\nu", "en", "hot", i) for i in range(250)]


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], DOCS)


def at(spark, folder, rows, schema, name):
    """rows as a table of their own folder."""
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def sql(name):
    c = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {path.split('/')[-1][:-8]} AS SELECT * FROM '{path}'")
    return c.sql(queries.ORACLES[name])


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_centroid_clustering"])
def test_like_sql(spark, name):
    want = sql(name)
    assert sorted(map(str, queries.QUERIES[name](spark, DATA).select(*want.columns).toPandas().itertuples(index=False, name=None))) == sorted(map(str, want.df().itertuples(index=False, name=None)))


# 11 Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(i, text, lang, source, n):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (i, source, lang, n, text)])


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def walk(levels, at, start):
    """Siblings upward, and what start folds to in the place of node at."""
    proof, own = "", start
    for level in levels[:-1]:
        k = at // 3 * 3
        left, right = "".join(level[k:at]), "".join(level[at + 1 : k + 3])
        proof, own, at = proof + left + right, h(left, own, right), at // 3
    return proof, own


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    names = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        members = sorted(by[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees[name] = (members, levels_of([leaf_of(*r) for r in members]))
    top = levels_of([trees[name][1][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        members, levels = trees[name]
        for i, r in enumerate(members):
            edit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            start = leaf_of(r[0], r[1].replace("\n", ""), *r[2:]) if edit else leaf_of(*r)
            proof, sub = walk(levels, i, start)
            more, folded = walk(top, k, sub)
            out.append((r[0], leaf_of(*r), levels[-1][0], top[-1][0], h(proof + more), folded, folded == top[-1][0]))
    return sorted(map(str, out))


@pytest.mark.parametrize("block_levels", [1, 2, 6])
def test_op11_like_plain_version(spark, tmp_path, monkeypatch, block_levels):
    """With small blocks, trees take several rounds."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(merkle, "WIDTH", 3**block_levels)
    folder = at(spark, tmp_path, [(*r, "x", "y", 7) for r in ROWS], DOCS, "documents")
    assert sorted(str(tuple(r)) for r in merkle.op11_merkle_manifest(spark, folder).collect()) == plain_manifest(ROWS)


def test_op11_one_row_and_none(spark, tmp_path, monkeypatch):
    one = [(8, "a\n", "en", "s", 2)]
    assert sorted(str(tuple(r)) for r in merkle.op11_merkle_manifest(spark, at(spark, tmp_path / "a", [(*r, "x", "y", 7) for r in one], DOCS, "documents")).collect()) == plain_manifest(one)
    assert merkle.op11_merkle_manifest(spark, at(spark, tmp_path / "b", [], DOCS, "documents")).count() == 0


def test_versions_copy_ancestors_alone(spark):
    """A version's copied nodes are the ancestors of its leaf, and nothing else of the tree."""
    from pyspark.sql import functions as F

    df = documents(spark, [(i, f"t{i}\nu", "en", "s", i) for i in range(30)])
    field = [F.col(c) for c in merkle.FIELDS]
    found = merkle.manifest(df, merkle.leaf_hash(*field), F.when(F.col("doc_id") == 17, F.lit("0" * 64))).collect()
    tree = {x for level in levels_of([leaf_of(i, f"t{i}\nu", "en", "s", i) for i in range(30)]) for x in level}
    for r in found:
        assert len(r.copied) == 4 and r.verified == (r.id != 17) and (set(r.copied) <= tree) == (r.id != 17) and r.copied[-1] == r.folded_root


# 12 Clustering


def plain_clusters(vectors, k=40, rounds=5):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in kept[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(c)):
            if members := [v for (_, v), o in zip(kept, own) if o == j]:
                c[j] = [sum(x) // len(members) for x in zip(*members)]
    last = [(i, *nearest(v)) for i, v in kept]
    per = {j: sum(d for _, d, o in last if o == j) for j in range(len(c))}
    return sorted(str((i, o, d, per[o], sum(per.values()), hashlib.sha256(",".join(map(str, c[o])).encode()).hexdigest())) for i, d, o in last)


def some_vectors(n, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(9, 64))
    return [(i, (middle[i % 9] + spread * rng.normal(size=64)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_op12_like_plain_version(spark, tmp_path, n):
    good = some_vectors(n, n)
    odd = [(900, None), (901, [0.5] * 63), (902, [0.5] * 65), (903, [0.5] * 63 + [None]), (904, [float("nan")] * 64), (905, [float("-inf")] * 64), (906, [])]
    ties = [(None, good[0][1]), (3, good[0][1]), (3, good[0][1]), (2, [-0.0] * 64)] if n > 1 else []
    rows = [(i, v, 1, 2.5) for i, v in good + odd + ties]
    folder = at(spark, tmp_path, rows, "vec_id long, embedding array<float>, own int, v double", "embeddings")
    got = centroids.op12_centroid_clustering(spark, folder).collect()
    assert sorted(str(tuple(r)) for r in got) == plain_clusters(good + odd + ties)


def test_bounds_spare_work(spark):
    rows = spark.createDataFrame([(i, [int(256 * x) for x in v]) for i, v in some_vectors(600, 5, 0.1)], "id long, v array<bigint>")
    found, last = centroids.cluster(rows, k=9, rounds=5)
    assert found.agg({"evaluated": "avg"}).first()[0] < 0.6 * 9 * 6 and last.shape == (9, 64)


def test_bounds_by_total_displacement():
    """A centroid that has gone away and come back loosens no bound: its vectors aren't looked at again."""
    v = np.array([[0, 0], [1, 0], [100, 0], [101, 1]])
    first, away = np.array([[0, 0], [100, 0]]), np.array([[70, 0], [30, 0]])
    state = centroids.reassign(v, None, first[None])
    middle = centroids.reassign(v, state, np.stack([first, away]))
    assert (middle[5] > 2).all()
    state = tuple(np.array(x) for x in state)
    assert (centroids.reassign(v, state, np.stack([first, away, first]))[5] == 2).all()


def test_exact_beyond_doubles():
    """Distances whose squares no double holds are still exact, and ties go to the smaller number."""
    big = (1 << 27) - 1
    v = np.array([[big] * 64, [-big] * 64])
    c = np.array([[-big] * 64, [big - 1] + [big] * 63, [big - 1] + [big] * 63])
    sq = centroids.all_squared(v, c)
    assert sq[0].tolist() == [64 * (2 * big) ** 2, 1, 1] and centroids.reassign(v, None, c[None])[0].tolist() == [1, 0]


def test_too_large_component(spark):
    rows = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        centroids.quantise(rows, "vec_id", "embedding").collect()


# 13 SimHash


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def plain_labels(fps, radius=2):
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_texts():
    rng = np.random.default_rng(4)
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "alpha beta"), (None, "alpha beta"), (5, "Alpha\x0bBETA"), (6, "solo"), (7, "é ü ß x 日本"), (7, "other text under the same id"), (8, " ".join(f"w{k}" for k in range(40_000)))]
    for g in range(12):
        words = [f"g{g}w{k}" for k in range(300)]
        for k in range(8):
            own = list(words)
            own[int(rng.integers(300))] = f"new{g}{k}"
            rows.append((1000 - 10 * g - k, " ".join(own)))
    return rows


def test_op13_like_plain_version(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(simhash, "AIM", 20)
    monkeypatch.setattr(simhash, "LEAF_SAMPLE", 2)
    rows = near_texts()
    folder = at(spark, tmp_path, [(i, t, 1, "a", 5) for i, t in rows], "doc_id long, text string, fp long, shard string, least long", "documents")
    got = sorted(str(tuple(r)) for r in simhash.op13_simhash_near_dedup(spark, folder).collect())
    fps = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    label = plain_labels(fps)
    least = {k: min((i for (i, _), x in zip(rows, label) if x == k and i is not None), default=None) for k in set(label.tolist())}
    assert got == sorted(str((i, f"{int(f):016x}", least[k])) for (i, _), f, k in zip(rows, fps, label.tolist()))
    assert len(set(label.tolist())) < len(rows) - 20
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_op13_on_the_tables(spark):
    found = {r.doc_id: r for r in simhash.op13_simhash_near_dedup(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = np.array([plain_fingerprint(r.text) for r in docs], np.uint64)
    assert [found[r.doc_id].fingerprint for r in docs] == [f"{int(f):016x}" for f in fps]
    assert [found[r.doc_id].component_id for r in docs] == [docs[k].doc_id for k in plain_labels(fps).tolist()]


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{k % 700}" for k in range(5000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "RUNS", 7)
    assert simhash.fingerprint(text.encode()) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("flipped", range(1, 8))
def test_link_like_all_pairs(monkeypatch, flipped):
    """Balls of several densities among strangers; small sets force the tree, dense ones the neighbours."""
    monkeypatch.setattr(simhash, "PAIRS", 8)
    rng = np.random.default_rng(flipped)
    middle = rng.integers(0, 2**63, 3, dtype=np.uint64)
    ball = np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, (900, flipped)).astype(np.uint64), axis=1) ^ middle[rng.integers(0, 3, 900)]
    fps = np.unique(np.concatenate([ball, rng.integers(0, 2**63, 300, dtype=np.uint64)]))
    assert (simhash.link(fps) == plain_labels(fps)).all()


def test_links_meet_in_a_shard():
    """Whatever the tree: two fingerprints within the radius share a leaf."""
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    other = fps ^ np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, (4000, 2)).astype(np.uint64), axis=1)
    tree = simhash.fit(fps[:1000], 4.0, aim=64)
    assert sum(x is None for x in tree) > 20
    both = np.concatenate([fps, other])
    leaves = [set() for _ in both]
    for leaf, inside in simhash.route(both, tree):
        for k in inside.tolist():
            leaves[k].add(leaf)
    assert all(leaves[k] & leaves[k + 4000] for k in range(4000))
    assert sum(map(len, leaves)) < 6 * len(both)


def test_shards_divided_again(spark, monkeypatch):
    """Shards over the size get trees of their own, and no link is lost."""
    for name, value in (("SAMPLE", 64), ("LEAF_SAMPLE", 4), ("AIM", 32), ("SHARD", 100)):
        monkeypatch.setattr(simhash, name, value)
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 2**62, 1500, dtype=np.uint64)
    fps = np.unique(np.concatenate([fps, fps ^ np.uint64(5)]))
    nodes = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    by = {}
    for r in simhash.shards(nodes).collect():
        by.setdefault(r.shard, set()).add(r.fp)
    assert max(name.count(".") for name in by) >= 2
    meet = {f for held in by.values() for f in held if f ^ 5 in held}
    assert meet == {int(f) for f in fps.view(np.int64) if f ^ 5 in set(fps.view(np.int64).tolist())}

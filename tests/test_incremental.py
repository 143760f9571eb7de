"""The incremental graph against a full rebuild after every batch; the store's commits; debounced file events."""

import random

import pytest
from pyspark.sql import functions as F

from lorefold.operators import code as C
from lorefold.operators import incremental as I
from lorefold.sources.store import Store

VERSIONS = "path string, language string, text string, seq long"


def source(k, method, calls, base=None, field=None):
    inject = f"    @Autowired\n    private {field} helper;\n" if field else ""
    body = "".join(f"        {c}(x);\n" for c in calls)
    return f"package p{k % 3};\npublic class T{k}{f' extends {base}' if base else ''} {{\n{inject}    public int {method}(int x) {{\n{body}    }}\n}}\n"


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.select("src", "dst", "kind", "confidence").collect())


def whole(spark, files):
    frame = spark.createDataFrame([(p, "java", t) for p, t in files.items()], "path string, language string, text string")
    nodes, edges = C.build(frame)
    return sorted(r.id for r in nodes.select("id").collect()), rows_of(edges)


def test_batches_equal_full_rebuilds(spark, tmp_path):
    """Edits, renames, moves, additions and deletions; equal names in several files; batches that run twice."""
    rng = random.Random(11)
    store = I.open_store(spark, str(tmp_path / "graph"), 8)
    any_text = lambda k: source(k, f"run{rng.randrange(6)}", [f"run{rng.randrange(6)}" for _ in range(2)], f"T{rng.randrange(9)}" if rng.random() < 0.6 else None, f"T{rng.randrange(9)}" if rng.random() < 0.4 else None)
    files, seq = {}, 0
    for number in range(3):
        batch = []
        for k in range(9) if number == 0 else rng.sample(range(11), 3):
            path, seq = f"src/T{k}.java", seq + 1
            if number and rng.random() < 0.3:
                batch.append((path, "java", None, seq))
                files.pop(path, None)
            else:
                if rng.random() < 0.3:
                    batch.append((path, "java", any_text(k), seq - 1000))  # an older version that arrives too
                files[path] = any_text(k)
                batch.append((path, "java", files[path], seq))
        frame = spark.createDataFrame(batch, VERSIONS)
        for _ in range(2 if number == 1 else 1):
            I.apply(store, frame, number)
        nodes, edges = whole(spark, files)
        assert sorted(r.id for r in store.read("nodes", number).collect()) == nodes
        assert rows_of(store.read("edges", number)) == edges
        assert {(r.path, r.text) for r in store.read("files", number).collect()} == set(files.items())


def test_few_buckets_are_rewritten(spark, tmp_path):
    """One changed file rewrites its own buckets and those of its dependants, and an unchanged one nothing."""
    store = I.open_store(spark, str(tmp_path / "graph"), 64)
    rows = [(f"src/T{k}.java", "java", source(k, f"run{k}", [f"run{k + 1}"]), 0) for k in range(40)]
    first = I.apply(store, spark.createDataFrame(rows, VERSIONS), 0)
    assert len(first["edges"]) > 20
    assert I.apply(store, spark.createDataFrame([rows[7]], VERSIONS), 1) == {}
    changed = [("src/T7.java", "java", source(7, "walk7", ["run8"]), 5)]
    again = I.apply(store, spark.createDataFrame(changed, VERSIONS), 2)
    assert len(again["files"]) == len(again["nodes"]) == 1 and len(again["edges"]) == 2 and len(again["names"]) <= 2 and len(again["mentions"]) <= 2
    assert store.read("edges", 2).where("src = 'src/T6.java::run6'").count() == 0 and store.read("edges", 1).where("src = 'src/T6.java::run6'").count() == 1


def test_a_killed_run_leaves_the_last_version(spark, tmp_path):
    """Data without a commit doesn't count; the same number can be written again."""
    store = Store(spark, str(tmp_path / "s"), {"t": "k long, v string"}, {"k": "k", "t": "k"}, 4)
    frame = lambda rows: spark.createDataFrame(rows, "k long, v string")
    store.commit(0, {"t": (frame([(i, "a") for i in range(20)]), list(range(4)))}, None)

    class Killed(Exception):
        pass

    def die(*_):
        raise Killed

    broken = Store(spark, store.root, store.schemas, store.keys, 4)
    broken._tidy = die
    only = [store.touched(frame([(3, "")]), "k")[0]]
    held = lambda n: {(r.k, r.v) for r in store.read("t", n).collect()}
    next_rows = store.read("t", 0, only).withColumn("v", F.lit("b"))
    path = f"{store.root}/data/t/version=1"
    next_rows.withColumn("_bucket", store.bucket("k")).write.partitionBy("_bucket").parquet(path)  # killed between write and commit
    assert store.newest() == 0 and held(0) == {(i, "a") for i in range(20)}
    with pytest.raises(Killed):
        broken.commit(1, {"t": (next_rows, only)}, 0)
    assert store.newest() == 1 and {v for k, v in held(1) if k == 3} == {"b"} and len(held(1)) == 20
    store.commit(2, {"t": (frame([]), only)}, 1)
    assert store.newest() == 2 and 3 not in {k for k, _ in held(2)} and store._numbers(f"{store.root}/commits") == [1, 2]


def test_debounced_stream(spark, tmp_path):
    """Bursts with known gaps; changes off the watch list and those later than the watermark don't count."""
    from lorefold.streaming import sync

    at = lambda sec: f"2024-01-01 00:{sec // 60:02d}:{sec % 60:02d}"
    # A burst of three, one alone just beyond the quiet time, an unwatched change that joins nothing, another source.
    batches = [
        [("r", "a/X.java", 0), ("r", "a/Y.java", 1), ("r", "a/X.java", 2), ("r", "b/node_modules/z.js", 3), ("r", "a/X.md", 4), ("q", "q.py", 1)],
        [("r", "a/X.java", 5), ("r", None, 5), ("beat", "t.py", 60)],
        [("r", "late.java", 3), ("r", "a/Z.go", 61), ("beat", "t.py", 120)],
        [("beat", "t.py", 300)],
    ]
    out, base = str(tmp_path / "out"), str(tmp_path / "in")
    for rows in batches:
        frame = spark.createDataFrame([(s, p, at(t)) for s, p, t in rows], "source string, path string, time string")
        frame.select("source", "path", F.col("time").cast("timestamp").alias("time")).coalesce(1).write.mode("append").parquet(base)
        source = spark.readStream.schema("source string, path string, time timestamp").parquet(base)
        fired = sync.debounced(source, "2 seconds", "10 seconds")
        fired.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.source, str(r.begun)[14:], str(r.fires)[14:], r.changes, r.files) for r in spark.read.parquet(out).where("source <> 'beat'").collect())
    assert got == [("q", "00:01", "00:03", 1, 1), ("r", "00:00", "00:04", 3, 2), ("r", "00:05", "00:07", 1, 1), ("r", "01:01", "01:03", 1, 1)]


def test_module_tree_like_recursion(spark):
    """Places and leaves against a recursive version, with few parts, equal keys and paths without folders."""
    from pathlib import PurePosixPath

    from lorefold.operators import modules as M

    rng = random.Random(2)
    paths = ["", "x.py", "a/x.py", "a/b/c/d/e/F.java", "a/b/c/d/e/G.long.name.java", "a/b/c/d/H.java", "a/b/c/z/H.java", ".hidden", "b/x"] + [f"a/b/c/d/{k}.x" for k in range(3)]
    rows = [(i, rng.choice(paths), "file" if i % 17 == 0 else "class") for i in range(160)]
    frame = spark.createDataFrame(rows, "id long, file_path string, kind string")
    for by_package in (False, True):
        want, leaf_of = {}, {}

        def grow(place, members, depth, most=9):
            sub = {}
            if depth > 0 and len(members) > most:
                for i, p in members:
                    ps = [x for x in p.split("/") if x]
                    sub.setdefault("_".join(ps[:4]) if len(ps) >= 4 else ps[-1] if ps else "_", []).append((i, p))
                if len(sub) <= 1:
                    sub = {}
                    for i, p in members:
                        sub.setdefault(PurePosixPath(p).stem[:20], []).append((i, p))
            want[place] = (len(members), not sub)
            for name, part in sub.items():
                grow((*place, name), part, depth - 1)
            if not sub:
                leaf_of.update({i: place for i, _ in members})

        tops = {}
        for i, p, kind in rows:
            if kind != "file":
                ps = [x for x in p.split("/") if x]
                key = "root" if not ps else "/".join(ps[: min(4, max(1, len(ps) - 1))]) if by_package else ps[0]
                tops.setdefault(key, []).append((i, p))
        for name, members in tops.items():
            grow((name,), members, 2)
        tree, at = M.tree(frame, 3, 9, by_package)
        assert {tuple(r.place): (r.n, r.leaf) for r in tree.collect()} == want
        assert {r.id: tuple(r.place) for r in at.collect()} == leaf_of


def test_mentions_are_looked_for_once(spark, tmp_path, monkeypatch):
    """A batch looks for mentions in the files as they were and as they are, no third time."""
    asked, mentions = [], C.mentions
    monkeypatch.setattr(C, "mentions", lambda *given: asked.append(1) or mentions(*given))
    store = I.open_store(spark, str(tmp_path / "graph"), 2)
    I.apply(store, spark.createDataFrame([("src/T1.java", "java", source(1, "run1", ["run2"]), 0)], VERSIONS), 0)
    assert len(asked) == 2


def test_differing_rows(spark):
    """Rows that one side has more often differ too; nulls are equal."""
    rows = lambda *values: spark.createDataFrame([(v,) for v in values], "name string")
    got = I._differ(rows("a", "b", "b", None, "c"), rows("a", "b", None, "d")).collect()
    assert sorted(r["name"] for r in got) == ["b", "c", "d"]

"""Every registered query with SQL against DuckDB on the driver's smallest tables."""

import glob

import duckdb
import pytest

from lorefold.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {path.split('/')[-1][:-8]} AS SELECT * FROM '{path}'")
    return c


def rounded(rows):
    return sorted(tuple(f"{v:.8g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_like_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES[name]})").fetchall()
    assert rounded(got) == rounded(want)
    assert got or name in {"event_changed_keys", "bench_leakage_scan", "doc_near_dup_pairs"}


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("together", [2000, 7])
def test_overlap_and_alignment_like_loops(spark, monkeypatch, together):
    """Copies, sets too small to join anything, and a token that all share, dealt over tasks or not."""
    import random

    from lorefold.operators import atoms as A

    monkeypatch.setattr(A, "SETS_PER_TASK", together)
    rng = random.Random(3)
    rows = [(i, "ab"[i % 2], sorted({"all", *(f"t{rng.randrange(12)}" for _ in range(rng.randrange(7)))})) for i in range(80)]
    rows += [(80, "a", ["q"]), (81, "a", ["q"]), (82, "b", rows[1][2]), (83, "b", rows[1][2])]
    frame = spark.createDataFrame(rows, "k long, g string, ts array<string>")
    first = {}
    for k, g, ts in rows:
        first.setdefault((g, tuple(ts)), k)
    reps = [(k, g, set(ts)) for (g, ts), k in first.items()]
    pairs = {(a, b): len(x & y) for a, g, x in reps for b, h, y in reps if g == h and a < b and len(x & y) >= 3}
    assert {(r.a, r.b): r.shared for r in A.overlap_pairs(frame, "k", "g", "ts", 3).collect()} == pairs
    leaders, want = [], {}
    for k, g, ts in rows:
        fit = [n for n, h, other in leaders if h == g and len(other & set(ts)) >= 3]
        want[k] = min(fit) if fit else k
        if not fit:
            leaders.append((k, g, set(ts)))
    assert {r.key: r.leader for r in A.align_greedy(frame, "k", "g", "ts", 3).collect()} == want


def test_redact_leaves(spark):
    """Secrets in JSON strings go however they are escaped; names, numbers and other strings stay."""
    import json

    from lorefold.functions import text as T
    from pyspark.sql import functions as F

    value = {"a": 'api_key="abcdefgh12345678"', "b": ["Bearer abc.def", 7, None], "c": {"q\"": "é \\ \n x"}}
    got = json.loads(spark.createDataFrame([(json.dumps(value),)], "j string").select(T.redact_leaves(F.col("j"))).first()[0])
    assert "abcdefgh12345678" not in got["a"] and got["b"] == ["Bearer ***REDACTED***", 7, None] and got["c"] == value["c"]


def test_stream_equals_batch(spark):
    got = {tuple(r) for r in registry.QUERIES["stream_incremental"](spark, DATA).collect()}
    events = spark.read.parquet(f"{DATA}/events.parquet")
    last = events.groupBy("user_id").agg({"event_id": "max"}).toDF("user_id", "event_id").join(events, ["user_id", "event_id"]).select("user_id", "event_id", "event_type", "value")
    assert got == {tuple(r) for r in last.collect()}


@pytest.mark.parametrize("together,at_once", [(2000, 262_144), (7, 5)])
def test_all_items_that_share_enough_are_pairs(spark, monkeypatch, together, at_once):
    """Items with equal sets are pairs as well, whether or not any other set is like theirs; they may be many."""
    import random

    from lorefold.operators import atoms as A
    from lorefold.operators import overlaps as O

    monkeypatch.setattr(A, "SETS_PER_TASK", together)
    monkeypatch.setattr(O, "PAIRS", at_once)
    rng = random.Random(4)
    rows = [(i, "ab"[i % 2], sorted({"all", *(f"t{rng.randrange(12)}" for _ in range(rng.randrange(7)))})) for i in range(60)]
    rows += [(100 + i, "a", ["x", "z", "y"]) for i in range(25)] + [(200, "a", ["z", "y", "x", "x"]), (201, "a", ["x", "y"]), (202, "b", ["x", "y", "z"]), (203, None, ["x", "y", "z"]), (None, "a", ["x", "y", "z"]), (204, "a", None)]
    rows.append((100, "a", ["all", "t1", "t2", "t3", "x", "y", "z"]))  # an id that occurs twice
    frame = spark.createDataFrame(rows, "k long, g string, ts array<string>")
    sets = [(k, g, set(ts)) for k, g, ts in rows if k is not None and g and ts]
    want = sorted((a, b, len(x & y)) for a, g, x in sets for b, h, y in sets if g == h and a < b and len(x & y) >= 3)
    assert sorted(tuple(r) for r in A.item_pairs(frame, "k", "g", "ts", 3).collect()) == want


def test_copies_of_documents_are_pairs(spark, tmp_path):
    """Copies with nothing else like them were left out, and of others only the first stood for all."""
    import duckdb

    from lorefold.plans import registry

    words = [f"longwords{c}" for c in "abcdefghijkl"]
    texts = [(1, "en", words[:9]), (2, "en", words[:9]), (3, "en", words[8::-1]), (4, "en", words[1:]), (5, "en", words[6:]), (6, "de", words), (7, "de", words), (8, None, words), (9, "en", None), (10, "en", words[:7])]
    spark.createDataFrame([(k, " ".join(ts) if ts else None, lang) for k, lang, ts in texts], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in registry.QUERIES["doc_near_dup_pairs"](spark, str(tmp_path)).collect())
    assert got == [(1, 2, 9), (1, 3, 9), (1, 4, 8), (2, 3, 9), (2, 4, 8), (3, 4, 8), (6, 7, 12)]
    duckdb.sql(f"CREATE OR REPLACE TABLE documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(duckdb.sql(registry.ORACLES["doc_near_dup_pairs"]).fetchall()) == got
    duckdb.sql("DROP TABLE documents")


def test_work_of_overlaps_grows_with_tokens_met():
    """Sets that meet nobody cost nothing: there was a counter for each two sets before."""
    import numpy as np
    import pyarrow as pa

    from lorefold.operators import overlaps as O

    n = 20_000
    names = [[f"own{i}", f"two{i // 2}", f"of{i // 2}", f"a{i // 2}", "all", f"some{i % 40}"] for i in range(n)]
    sets = pa.array(names, pa.list_(pa.large_string()))
    parts = list(O.sharing(sets, sets, 4))
    found = {(int(a), int(b)): int(c) for i, j, shared in parts for a, b, c in zip(i, j, shared) if a < b}
    assert found == {(i, i + 1): 4 for i in range(0, n, 2)}
    assert len(parts) < 20
    assert all((np.diff(i) >= 0).all() for i, _, _ in parts)


@pytest.mark.parametrize("common,at_once,keys", [(512, 300_000, 1024), (512, 50, 2)])
def test_rare_and_common_tokens_count_alike(spark, monkeypatch, common, at_once, keys):
    """More tokens than are held as bits; keys of equal sets go in parts."""
    import random

    from lorefold.operators import atoms as A
    from lorefold.operators import overlaps as O

    monkeypatch.setattr(O, "COMMON", common, raising=False)
    monkeypatch.setattr(O, "MEETINGS", at_once, raising=False)
    monkeypatch.setattr(O, "KEYS", keys, raising=False)
    monkeypatch.setattr(A, "SETS_PER_TASK", 90)
    rng = random.Random(8)
    pools = [rng.sample(range(1500), 30) for _ in range(25)]
    rows = [(i, "ab"[i % 5 == 0], [f"t{c}" for c in {*rng.sample(pools[i % 25], rng.randrange(1, 20)), *(rng.randrange(3000) for _ in range(5)), *(rng.randrange(8) for _ in range(rng.randrange(6)))}]) for i in range(300)]
    rows += [(1000 + i, "a", rows[1][2][::-1]) for i in range(9)]
    sets = [(k, g, set(ts)) for k, g, ts in rows]
    want = sorted((a, b, len(x & y)) for a, g, x in sets for b, h, y in sets if g == h and a < b and len(x & y) >= 6)
    got = A.item_pairs(spark.createDataFrame(rows, "k long, g string, ts array<string>"), "k", "g", "ts", 6)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 300


def test_long_words_end_where_others_do(spark, tmp_path):
    """Letters, digits and _ of any script belong to a word; it counts if it is nine letters a to z or more."""
    import duckdb

    from lorefold.plans import registry

    base = [f"longwords{c}" for c in "abcdefg"]
    ends = ["lastwordhere", "LASTWORDHERE", "lastwordhere_", "\u00e9lastwordhere", "lastwordhere9", "9lastwordhere", "\U0001d49clastwordhere", "lastwordhere\U0001d49c", "lastwordhere\n", "-lastwordhere-"]
    ends += ["lastwordher\u00e9", "\u4e2dlastwordhere", "lastwor dhere", "\u201clastwordhere\u201d", "lastwordhere\U0001f600", "\U0001f600lastwordhere", "lastwordhere\u0301"]
    spark.createDataFrame([(i, "en", f"{'; '.join(base)} {end}") for i, end in enumerate(ends)], "doc_id long, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in registry.QUERIES["doc_near_dup_pairs"](spark, str(tmp_path)).collect())
    kept = [0, 1, 8, 9, 13, 14, 15, 16]
    assert got == [(a, b, 8) for a in kept for b in kept if a < b]
    duckdb.sql(f"CREATE OR REPLACE TABLE documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(duckdb.sql(registry.ORACLES["doc_near_dup_pairs"]).fetchall()) == got
    duckdb.sql("DROP TABLE documents")

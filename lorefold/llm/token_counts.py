"""Token counts of whole texts, with huge documents encoded in overlapping chunks.

Contract
* n_tokens is what the library gives for the whole text: no begin, end or added special tokens, no
  truncation or padding; special strings inside texts are handled as the library does by default.
* Null texts count as empty: 0 bytes, 0 tokens. Rows that repeat an id are counted each; extra columns
  pass. An empty table gives no rows.

The tokenizer lower-cases, splits at white space, drops it, and merges within words only. So

* in a text of up to HUGE characters, each distinct word of a batch is encoded once and counts are summed;
* a longer one is cut into chunks of CHUNK characters, each continued by an overlap into the next, which
  are dealt over the cluster and encoded with offsets. Two neighbours are spliced at the first place in
  the overlap that is proven stable (the character before it is white space) and where both have a token
  that starts right there; tokens before it count on the left, the others on the right. Where no such
  place is found, the document is encoded again with twice the overlap, until it aligns or one chunk
  holds it all.
"""

from __future__ import annotations

import os

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, pieces, split_words, sum_by_row, table

HUGE, CHUNK, OVERLAP = 12288, 8192, 256
#: Bytes of chunks that a task encodes, and tasks at most (beyond that they grow).
TASK_BYTES, MOST_TASKS = 4 << 20, 20_000
#: Places kept of an overlap.
PLACES = 16
#: Words that a Python worker remembers at most.
REMEMBERED = 300_000
SAME_BYTES = bytes(range(256))
WHITE = frozenset(" \n\t\r")
_loaded: dict = {}


def tokenizer(path: str):
    """The tokenizer and the counts of words met so far, once per process."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path] = (Tokenizer.from_file(path), {})
    return _loaded[path]


def word_counts(path: str, words: list[str]) -> np.ndarray:
    """Number of tokens of each of these distinct words."""
    encoder, known = tokenizer(path)
    out = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
    at = np.flatnonzero(out < 0)
    new = [words[i] for i in at]
    for a in range(0, len(new), 20_000):
        out[at[a : a + 20_000]] = [len(e.ids) for e in encoder.encode_batch_fast(new[a : a + 20_000], add_special_tokens=False)]
    for w, n in zip(new[: max(0, REMEMBERED - len(known))], out[at]):
        known[w] = int(n)
    return out


def count_texts(path: str, texts: pa.Array) -> np.ndarray:
    words, per_text = split_words(texts, SAME_BYTES)
    coded = words.dictionary_encode()
    n = word_counts(path, coded.dictionary.to_pylist())
    return sum_by_row(n[np.asarray(coded.indices)] if len(words) else np.zeros(0, np.int64), per_text)


def _plain(path: str, huge: int):
    def count(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in pieces(batches):
            texts = pc.fill_null(batch.column(1), "")
            large = np.asarray(pc.greater(pc.utf8_length(texts), huge))
            n = np.zeros(batch.num_rows, np.int64)
            n[~large] = count_texts(path, texts.filter(pa.array(~large)))
            uid = row + np.arange(batch.num_rows)
            row += batch.num_rows
            whole = pa.array([texts[i].as_py() if x else None for i, x in enumerate(large)], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(uid), batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n, mask=large), whole], ["uid", "doc_id", "n_bytes", "n_tokens", "huge"])

    return count


def chunk_places(path: str, text: str, start: int, size: int, overlap: int, last: bool) -> tuple[int, list, list]:
    """All tokens of a chunk, and (place, tokens before it) in the overlaps at its head and tail."""
    encoding = tokenizer(path)[0].encode(text, add_special_tokens=False)

    def before(p: int) -> int | None:
        """Tokens before the first that starts at p; null if none does."""
        t = encoding.char_to_token(p)
        if t is None or encoding.token_to_chars(t)[0] != p:
            return None
        while t and encoding.token_to_chars(t - 1)[0] == p:
            t -= 1
        return t

    def places(a: int, b: int) -> list:
        tried = ((p, before(p)) for p in range(max(a, 1), min(b, len(text))) if text[p - 1] in WHITE)
        found = ((start + p, n) for p, n in tried if n is not None)
        return [x for x, _ in zip(found, range(PLACES))]

    return len(encoding), places(0, overlap) if start else [], [] if last else places(size, size + overlap)


def _chunks(size: int, overlap: int):
    def chunks(batches):
        for batch in batches:
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for start in range(0, len(text), size):
                    last = start + size + overlap >= len(text)
                    yield pa.RecordBatch.from_pylist([{"uid": uid, "start": start, "last": last, "chunk": text[start : start + size + overlap]}])
                    if last:
                        break

    return chunks


PLACES_TYPE = pa.list_(pa.struct([("p", pa.int64()), ("n", pa.int64())]))


def _encode(path: str, size: int, overlap: int):
    def encode(batches):
        for batch in batches:
            rows = [chunk_places(path, x["chunk"], x["start"], size, overlap, x["last"]) for x in batch.to_pylist()]
            head, tail = (pa.array([[{"p": p, "n": n} for p, n in r[i]] for r in rows], PLACES_TYPE) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array([r[0] for r in rows], pa.int64()), head, tail], ["uid", "start", "last", "total", "head", "tail"])

    return encode


def splice(texts: DataFrame, path: str, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(uid, n_tokens) of (uid, text) rows by overlapping chunks; n_tokens is null where neighbours don't align."""
    places = "array<struct<p:bigint,n:bigint>>"
    n_bytes = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = texts.mapInArrow(_chunks(size, overlap), "uid bigint, start bigint, last boolean, chunk string").repartition(max(1, min(MOST_TASKS, -(-n_bytes // TASK_BYTES))), "uid", "start")
    encoded = chunks.mapInArrow(_encode(path, size, overlap), f"uid bigint, start bigint, last boolean, total bigint, head {places}, tail {places}")
    linked = encoded.withColumn("left", F.lag("tail").over(Window.partitionBy("uid").orderBy("start")))
    at = F.get(F.filter("head", lambda h: F.exists("left", lambda t: t["p"] == h["p"])), F.lit(0))
    linked = linked.withColumn("at", at)
    on_left = F.get(F.filter("left", lambda t: t["p"] == F.col("at.p")), F.lit(0))["n"]
    part = F.when(F.col("start") == 0, F.lit(0)).otherwise(on_left - F.col("at.n")) + F.when(F.col("last"), F.col("total")).otherwise(F.lit(0))
    return linked.groupBy("uid").agg(F.when(F.count(part) == F.count("*"), F.sum(part)).alias("spliced"))


def count_tokens(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", huge: int = HUGE, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row."""
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = cut(rows.mapInArrow(_plain(path, huge), f"uid bigint, doc_id {kind}, n_bytes bigint, n_tokens bigint, huge string"))
    left, done = rows.where("huge is not null").select("uid", F.col("huge").alias("text")), None
    while not left.isEmpty():
        tried = cut(splice(left, path, size, overlap))
        good = tried.where("spliced is not null")
        done = good if done is None else done.unionByName(good)
        left, overlap = left.join(tried.where("spliced is null"), "uid", "left_semi"), overlap * 2
    if done is None:
        return rows.select("doc_id", "n_bytes", "n_tokens")
    return rows.drop("huge").join(done, "uid", "left").select("doc_id", "n_bytes", F.coalesce("n_tokens", "spliced").alias("n_tokens"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)

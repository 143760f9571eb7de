"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words (digits, letters and everything beyond ASCII) once A-Z is lower-cased.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: bytes.translate table: A-Z to a-z, other ASCII kept.
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: bytes.translate table: also every ASCII byte that is no digit or letter becomes a space.
WORD_BYTES = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Text that Python tasks work on at once; a single longer text is still taken whole.
PIECE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="lorefold-")  # one machine, such as tests: driver and executors are one process
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there and a lost executor costs one file read."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(id_col: str, text_col: str = "text"):
    """Joins go by this and a null-safe id, so rows that repeat an id under another text stay apart."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of df has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def match_rows(df: DataFrame, found: DataFrame, how: str, id_col: str = "doc_id", text_col: str = "text", broadcast: bool = False) -> tuple[DataFrame, list[str]]:
    """df joined with found by row: found starts with id and row key; its columns get names that df doesn't have."""
    names = free_names(df, *[f"_found_{c}" for c in found.columns])
    right = found.toDF(*names)
    right = F.broadcast(right) if broadcast else right
    return df.join(right, (row_key(id_col, text_col) == F.col(names[1])) & F.col(id_col).eqNullSafe(F.col(names[0])), how), names


def lower_ascii(col):
    """A-Z to a-z and nothing else; lower() does that by itself for ASCII texts, at a fraction of the cost."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def let(value, use):
    """use(value) with value computed once per row; written into a lambda as it is, it would be computed at every step."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def named(**fields):
    """A struct with these field names; inside lambdas, alias() doesn't reach struct()."""
    return F.named_struct(*[x for k, v in fields.items() for x in (F.lit(k), v)])


def words(col):
    """Array of lower-cased words; empty for null."""
    return F.filter(F.split(lower_ascii(F.coalesce(col, F.lit(""))), NOT_WORD), lambda w: w != "")


def pieces(batches, column: str = "text", limit: int = PIECE_BYTES):
    """Record batches cut at rows so that each holds about limit bytes of the column."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // limit
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def settle() -> None:
    """Hand memory that nothing holds any more back to the system: workers stay for later tasks, and so would their heaps."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # other C libraries do without
        trim(0)


def raw_text(array: pa.Array) -> tuple[bytes, np.ndarray]:
    """The UTF-8 bytes of a string array without gaps, and where each row starts; null counts as empty."""
    array = pc.fill_null(array, "").cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if data is not None and len(array) else b""
    return data, offsets - offsets[0]


def string_array(data: bytes, offsets: np.ndarray, kind=pa.large_string()) -> pa.Array:
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def split_words(array: pa.Array, byte_map: bytes = WORD_BYTES) -> tuple[pa.Array, np.ndarray]:
    """Words of each text after byte_map, split at ASCII white space: all words in a row, and each text's number of them."""
    data, offsets = raw_text(array)
    parts = pc.ascii_split_whitespace(string_array(data.translate(byte_map), offsets))
    flat = parts.flatten()
    filled = np.asarray(pc.binary_length(flat)) > 0
    row = np.repeat(np.arange(len(array)), np.asarray(pc.list_value_length(parts)))
    return flat.filter(pa.array(filled)), np.bincount(row[filled], minlength=len(array))


def starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def sum_by_row(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive values, counts[i] of them for row i."""
    total = np.concatenate([[0], np.cumsum(values)])
    edge = starts(counts)
    return total[edge[1:]] - total[edge[:-1]]


def ragged(first: np.ndarray, counts: np.ndarray, kind=np.int64) -> np.ndarray:
    """Concatenated ranges first[i] .. first[i] + counts[i] - 1."""
    out = np.ones(int(counts.sum()), kind)
    some = counts > 0
    first, counts = first[some], counts[some]
    if not len(first):
        return out
    out[0] = first[0]
    edge = np.cumsum(counts)[:-1]
    out[edge] = first[1:] - (first[:-1] + counts[:-1] - 1)
    return np.cumsum(out, dtype=kind, out=out)

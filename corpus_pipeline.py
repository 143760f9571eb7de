"""The training-data pipeline: STAGES in order, each on all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. Rows without text pass every stage: they are not toxic, duplicates, contaminated or secret.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorefold.llm.common import cut
from lorefold.llm.decontaminate import clean_documents
from lorefold.llm.near_duplicates import keep_one
from lorefold.llm.secrets import redact
from lorefold.llm.sentencepiece_dropout import encode
from lorefold.llm.toxicity import drop_toxic

DROPOUT, SEED = 0.1, 7


def drop_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores below 0.5; it learns from the labelled ones among them."""
    return drop_toxic(docs, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the smallest id."""
    return keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by their kind; n_chars follows."""
    return redact(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and whether they decode to the text."""
    encoded = encode(docs, public_tokenizers.path("piece_bpe_32k.model"), DROPOUT, SEED)
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "lossless")


STAGES = [
    ("toxicity", drop_toxic_documents),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("SentencePiece encoding", encode_pieces),
]

#: The learnt toxicity model can't be put in SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; between stages rows are written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs

"""The subpackage's queries and their SQL, by name."""

from __future__ import annotations

from . import centroids, decontaminate, merkle, near_duplicates, secrets, topk, warc
from .context_mixing import op2_context_mixing
from .decontaminate import op10_benchmark_decontamination
from .secrets import op9_secret_scans
from .near_duplicates import op3_ngram_jaccard_join
from .sentencepiece_dropout import op5_sentencepiece_dropout
from .sharding import op4_sharding
from .simhash import op13_simhash_near_dedup
from .token_counts import op8_token_counts
from .toxicity import op7_toxicity
from .warc import op1_warc_segment_reassembly

QUERIES = {
    "op1_warc_segment_reassembly": op1_warc_segment_reassembly,
    "op2_context_mixing": op2_context_mixing,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_sharding": op4_sharding,
    "op5_sentencepiece_dropout": op5_sentencepiece_dropout,
    "op6_exact_top_k": topk.op6_exact_top_k,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_secret_scans": op9_secret_scans,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_centroid_clustering": centroids.op12_centroid_clustering,
    "op13_simhash_near_dedup": op13_simhash_near_dedup,
}

ORACLES: dict[str, str] = {
    "op1_warc_segment_reassembly": warc.ORACLE,
    "op3_ngram_jaccard_join": near_duplicates.ORACLE,
    "op6_exact_top_k": topk.ORACLE,
    "op9_secret_scans": secrets.ORACLE,
    "op10_benchmark_decontamination": decontaminate.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_centroid_clustering": centroids.ORACLE,
}

"""Registered queries and their SQL."""

from __future__ import annotations

from . import code_queries, detail_queries, document_queries, epoch_queries, fact_queries, index_queries, relational_queries, report_queries, run_queries, source_queries, sync_queries, text_queries

QUERIES = document_queries.QUERIES | relational_queries.QUERIES | code_queries.QUERIES | run_queries.QUERIES | text_queries.QUERIES | fact_queries.QUERIES | index_queries.QUERIES | epoch_queries.QUERIES | detail_queries.QUERIES | report_queries.QUERIES | source_queries.QUERIES | sync_queries.QUERIES
ORACLES = document_queries.ORACLES | relational_queries.ORACLES | code_queries.ORACLES | run_queries.ORACLES | text_queries.ORACLES | fact_queries.ORACLES | index_queries.ORACLES | epoch_queries.ORACLES | detail_queries.ORACLES | report_queries.ORACLES | source_queries.ORACLES | sync_queries.ORACLES

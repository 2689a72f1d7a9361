"""Registered queries (Spark builders + DuckDB oracles) and the end-to-end job."""
from .registry import ORACLES, QUERIES  # noqa: F401
from . import text_queries, corpus_queries, detect_queries, split_queries, eval_queries, ml_queries, io_queries  # noqa: F401  (registers)

"""Registered queries over the test tables and their DuckDB twins."""

from . import oracle, queries  # noqa: F401  (trace family)
from . import catalog_queries, dist_queries, doc_queries, file_queries, io_queries, store_queries, stream_queries  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401

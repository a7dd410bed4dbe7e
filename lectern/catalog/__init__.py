"""One registered query per operator."""

from lectern.catalog import (  # noqa: F401
    corpus_queries,
    dense_queries,
    flow_queries,
    metric_queries,
    reader_queries,
    sparse_queries,
    text_queries,
)
from lectern.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""All registered queries."""

from . import (  # noqa: F401
    change_queries,
    chunk_queries,
    citation_queries,
    format_queries,
    keyed_queries,
    name_queries,
    page_queries,
    report_queries,
    text_queries,
)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

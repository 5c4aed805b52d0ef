"""Every registered query with its DuckDB counterpart."""

from . import history, matching, quality, rates, semantic, sla, streams
from .base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "history", "matching", "quality", "rates", "semantic", "sla", "streams"]

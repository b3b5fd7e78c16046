"""eventframe: columnar event files as Spark DataFrames."""

from .plans import oracle_sql, queries
from .sources.api import count_events, open_events, read_events, register

__all__ = ["count_events", "open_events", "oracle_sql", "queries", "read_events", "register"]

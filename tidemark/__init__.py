"""Change history from full-table snapshots, on Spark."""

from tidemark.session import configure

__all__ = ["configure"]

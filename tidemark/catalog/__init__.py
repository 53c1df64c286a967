"""Every operator as a named query over the supplied tables, with the same result in plain SQL."""

from tidemark.catalog import features, joins, models, monitoring, stored  # noqa: F401
from tidemark.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

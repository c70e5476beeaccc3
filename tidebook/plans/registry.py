"""All queries of the market engine and their SQL."""

from tidebook.plans import oracles, queries, stored, stored_sql

QUERIES = queries.QUERIES | stored.QUERIES
ORACLES = oracles.ORACLES | stored_sql.ORACLES

__all__ = ["ORACLES", "QUERIES"]

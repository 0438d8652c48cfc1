"""Registered queries and their SQL counterparts."""

from lexloom.plans import loading, quality, retrieval

_GROUPS = (loading.R, quality.R, retrieval.R)
QUERIES = {k: v for r in _GROUPS for k, v in r.queries.items()}
SQL = {k: v for r in _GROUPS for k, v in r.sql.items()}

"""Named queries over the driver's tables, with the SQL that must agree with each."""

from __future__ import annotations

from sedimenta.plans import forum_queries  # noqa: F401  (adds its queries to the same lists)
from sedimenta.plans.queries import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

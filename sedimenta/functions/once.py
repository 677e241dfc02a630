"""What is costly is evaluated once for each row, whatever reads it.

Catalyst puts an expression in the place of each reference to it when it pushes filters down, and in lambda functions for each element.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """rows with columns, made below a generator that no filter is pushed through. Columns that are not read later are made too."""
    kept = [c for c in rows.columns if c not in columns]
    return rows.select(*kept, F.inline_outer(F.array(F.struct(*(v.alias(k) for k, v in columns.items())))))

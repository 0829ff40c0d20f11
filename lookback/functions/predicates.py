"""Boolean expressions for filters and rules."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def satisfied(constraint: str) -> Column:
    """SQL predicate where NULL counts as not satisfied."""
    return F.coalesce(F.expr(f"({constraint})"), F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def all_satisfied(constraints: Iterable[str]) -> Column:
    return all_of(satisfied(c) for c in constraints)


def not_null(columns: Iterable[str]) -> Column:
    return all_of(F.col(c).isNotNull() for c in columns)


def sql_text(value: str | None) -> str:
    """A string or NULL as a SQL literal."""
    if value is None:
        return "null"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_set(column: str, values: Iterable[str]) -> str:
    """SQL text of a membership test."""
    return f"{column} IN ({', '.join(map(sql_text, values))})"


def days_between(column: str, lo: dt.date | None, hi: dt.date | None) -> Column:
    """Inclusive day range with literal ends, the form partition pruning can use."""
    ends = []
    if lo is not None:
        ends.append(F.col(column) >= F.lit(lo))
    if hi is not None:
        ends.append(F.col(column) <= F.lit(hi))
    return all_of(ends)

"""Column expressions shared by the operators; all stay inside code generation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_day(c: Column | str) -> Column:
    """String or timestamp to DATE; text that is no date gives NULL, also in ANSI mode."""
    return F.try_to_date(col(c))


def to_type(c: Column | str, sql_type: str) -> Column:
    """Cast of untrusted data: NULL where the value does not fit the type."""
    return col(c).try_cast(sql_type)


def zero_if_null(c: Column | str, zero: int | float = 0) -> Column:
    return F.coalesce(col(c), F.lit(zero))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double, 0.0 where the denominator is not positive."""
    num, den = col(num), col(den)
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def to_units(c: Column | str, scale: int) -> Column:
    """Amount as whole units of 10**-scale, so that sums do not depend on row order.

    Finer amounts are rounded. NaN and what exceeds 64 bits give NULL, so that a rule
    meets them and not a failed cast.
    """
    return F.round(col(c) * F.lit(float(10**scale))).try_cast("long")


def from_units(c: Column | str, scale: int) -> Column:
    return col(c).cast("double") / F.lit(float(10**scale))


def now(clock: dt.datetime | None = None) -> Column:
    return F.current_timestamp() if clock is None else F.lit(clock)


def stable_bucket(key: list[str], buckets: int, seed: int = 42) -> Column:
    """Bucket of a row's key: same on every run, layout and engine that has md5."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in key]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(buckets)

"""Raw rows to typed, keyed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.functions.predicates import not_null
from lookback.functions.scalar import to_day, to_type


def flatten_events(df: DataFrame) -> DataFrame:
    """Landing impressions or clicks: lift the nested fields, parse the day."""
    return df.select(
        to_day("day").alias("day"),
        to_type("user_id", "bigint").alias("user_id"),
        F.col("event_data.value_prop").alias("value_prop"),
        to_type("event_data.position", "int").alias("position"),
    )


def flatten_payments(df: DataFrame) -> DataFrame:
    return df.select(
        to_day("pay_date").alias("day"),
        to_type("user_id", "bigint").alias("user_id"),
        "value_prop",
        to_type("total", "double").alias("total"),
    )


def require_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(not_null(columns))


def distinct_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Set semantics on a key that covers every kept column.

    Grouping on all columns makes the result independent of row order, and copies
    collapse on the map side before the shuffle.
    """
    return df.select(*keys).distinct()

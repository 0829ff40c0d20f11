"""Left lookups that keep the left side's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.functions.scalar import zero_if_null


def flag_if_present(df: DataFrame, other: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """1 where ``other`` has the row's key, else 0; NULL never matches.

    The lookup is distinct, so the join adds no rows. No broadcast hint: the lookup
    grows with the data, and AQE broadcasts it only when its measured size allows.
    The keys are made distinct as one struct, whose partitioning the join cannot take
    over: both its sides then sit on a shuffle, where AQE can split a hot key of ``df``.
    """
    keys = other.select(F.struct(*on).alias("_key")).distinct()
    flags = keys.select("_key.*").withColumn(name, F.lit(1))
    return (
        df.join(flags, on=list(on), how="left")
        .withColumn(name, zero_if_null(name))
        .select(*df.columns, name)
    )


def lookup_features(
    spine: DataFrame, features: DataFrame, key: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """Spine rows with the named features of their key, NULL where there is none.

    ``features`` must be unique on ``key``; see ``key_duplicates``.
    """
    return spine.join(features.select(*key, *names), on=list(key), how="left").select(
        *spine.columns, *names
    )

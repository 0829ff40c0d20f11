"""Join of intervals with points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def band_join(
    left: DataFrame,
    right: DataFrame,
    lo: str,
    hi: str,
    point: str,
    keys: Sequence[str] = (),
    bin_width: int | None = None,
) -> DataFrame:
    """Inner join on ``keys`` and ``lo <= point <= hi`` over integer columns.

    With ``bin_width`` the line is cut into bins: a point lies in one bin, an interval
    is repeated for each bin it touches, and the bin joins as one more equality key.
    A pair meets only in its point's bin, so it comes out once. This is what makes a
    join without keys a hash join, and it spreads the points of a hot key over many
    partitions. Without keys the bins are required: Spark would otherwise compare
    every row with every other.
    """
    if not keys and bin_width is None:
        raise ValueError("a band join without keys needs bins")
    if bin_width is not None and bin_width < 1:
        raise ValueError("bin_width must be at least 1")
    on = list(keys)
    if bin_width is not None:
        first, last = (F.floor(F.col(c) / bin_width).cast("long") for c in (lo, hi))
        # An empty interval touches no bin; sequence() would count downwards.
        bins = F.when(F.col(lo) <= F.col(hi), F.sequence(first, last))
        left = left.withColumn("_bin", F.explode(bins))
        right = right.withColumn("_bin", F.floor(F.col(point) / bin_width).cast("long"))
        on.append("_bin")
    within = F.col(point).between(F.col(lo), F.col(hi))
    return left.join(right, on=on, how="inner").where(within).drop("_bin")

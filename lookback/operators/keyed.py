"""Lookups of few keys in large tables: Parquet Bloom filters and filters that reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookback.operators.lookup import lookup_features
from lookback.operators.publish import clustered, rebalanced

#: Values of a key column that become literals of a filter; each is a test per row group.
FEW = 200


def write_keyed(
    df: DataFrame,
    folder: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    distinct: int = 100_000,
    row_group_bytes: int = 32 << 20,
    mode: str = "overwrite",
) -> None:
    """Write Parquet files whose row groups each carry a Bloom filter of every key column.

    ``distinct`` is how many different values of a key a row group may hold; it sizes the
    filters (some 10 bits a value). Row groups are what a reader skips, so they are smaller
    than usual. Texts and whole numbers can be keys; booleans cannot, and need not.
    """
    if cluster_by:
        df = clustered(df, [*partition_by, *cluster_by])
    elif partition_by:
        df = rebalanced(df, partition_by)
    writer = df.write.mode(mode).option("parquet.block.size", row_group_bytes)
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", distinct)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)


def any_of(column: str, values: Sequence) -> Column:
    """Equality with any value, as a balanced chain of ORs.

    ``isin`` with more than a handful of values reaches Parquet as a range only, which no
    Bloom filter can answer; equalities do.
    """
    tests = [F.col(column) == F.lit(v) for v in values]
    while len(tests) > 1:
        tests = [reduce(lambda a, b: a | b, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0] if tests else F.lit(False)


def lookup_few(
    spine: DataFrame, features: DataFrame, key: Sequence[str], names: Sequence[str], few: int = FEW
) -> DataFrame:
    """``lookup_features`` that reads little of ``features`` when the spine has few keys.

    The different values of each key column of the spine are counted up to ``few``; a column
    with no more than that filters the features by these literals, so that partitions, row
    group statistics and Bloom filters skip what cannot match. Columns with more values do
    not filter. The rows are those of ``lookup_features`` in any case.

    One job per key column reads the spine, which should be a table or staged.
    """
    for column in key:
        values = [r[0] for r in spine.select(column).where(F.col(column).isNotNull()).distinct().limit(few + 1).collect()]
        if len(values) <= few:
            features = features.where(any_of(column, sorted(values)))
    return lookup_features(spine, features, key, names)

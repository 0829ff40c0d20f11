"""Changes between snapshots, applied to a partitioned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.operators.publish import drop_partitions, replace_partitions, staged

CHANGE = "_change_type"
BEFORE, AFTER = ("delete", "update_pre"), ("insert", "update_post")


class ChangeConflict(Exception):
    """The table is not in the state the changes start from; nothing was written."""


def _partitions(df: DataFrame, column: str) -> list:
    # One value per partition, so this is as short as the partition list.
    return [r[0] for r in df.select(column).distinct().collect()]


def _within(df: DataFrame, column: str, values: list) -> DataFrame:
    known = [v for v in values if v is not None]
    keep = F.col(column).isin(known) if known else F.lit(False)
    return df.where(keep | F.col(column).isNull() if None in values else keep)


def merge_changes(current: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows after the changes, with ``_conflict`` where a row is not as they expect it.

    A delete or update must find its pre-image, equal in every column; an insert must find
    no row; a key has at most one change. Both sides are grouped by key before they meet.
    """
    columns = current.columns
    row = F.struct(*columns)
    sides = changes.select(
        F.struct(*key).alias("k"),
        F.when(F.col(CHANGE).isin(*BEFORE), row).alias("pre"),
        F.when(F.col(CHANGE).isin(*AFTER), row).alias("post"),
        (~F.col(CHANGE).isin(*BEFORE, *AFTER) | F.col(CHANGE).isNull()).alias("odd"),
    )
    by_key = sides.groupBy("k").agg(
        F.any_value("pre", True).alias("pre"),
        F.any_value("post", True).alias("post"),
        ((F.count("pre") > 1) | (F.count("post") > 1) | F.bool_or("odd")).alias("odd"),
    )
    held = current.select(F.struct(*key).alias("k"), row.alias("now"))
    met = held.alias("a").join(by_key.alias("b"), F.col("a.k") == F.col("b.k"), "full")
    changed = F.col("b.k").isNotNull()
    expected = F.col("pre").eqNullSafe(F.col("now"))
    after = F.when(changed, F.col("post")).otherwise(F.col("now"))
    return met.select(
        after.alias("after"), (changed & (F.col("odd") | ~expected)).alias("_conflict")
    )


def apply_changes(changes: DataFrame, table: str, key: Sequence[str], partition_by: str, cluster_by: Sequence[str] = ()) -> int:
    """Apply the rows of ``snapshot_diff`` to a catalog table; returns how many partitions.

    Only partitions that the changes name are read and rewritten; one that ends empty goes.
    A row may move between partitions: its pre-image names the old one. If any change does
    not meet its pre-image (or an insert meets a row of its key in a named partition),
    ``ChangeConflict`` is raised and nothing is written; so changes cannot be applied twice.
    """
    spark = changes.sparkSession
    changes = staged(changes, f"{table}_changes")
    try:
        values = _partitions(changes, partition_by)
        if not values:
            return 0
        current = _within(spark.table(table), partition_by, values)
        merged = staged(merge_changes(current, changes.select(CHANGE, *current.columns), key), f"{table}_merged")
        conflicts = merged.where("_conflict").count()
        if conflicts:
            raise ChangeConflict(f"{conflicts} changes do not fit {table}")
        after = merged.where("after IS NOT NULL").select("after.*")
        left = _partitions(after, partition_by)
        if left:
            replace_partitions(after, table, [partition_by], cluster_by)
        gone = [None if v is None else str(v) for v in values if v not in left]
        drop_partitions(spark, table, partition_by, gone)
        return len(values)
    finally:
        for name in ("changes", "merged"):
            spark.sql(f"DROP TABLE IF EXISTS {table}_{name}")

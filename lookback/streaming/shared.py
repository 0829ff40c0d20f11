"""A raw table that batches and streams fill side by side.

Rows lie in a partition per batch, which a batch that runs again replaces. A plain file
sink keeps a log of its own files instead, which other writers would be invisible beside.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback.operators.publish import rebalanced
from lookback.session import setting
from lookback.sources.files import path_exists

BATCH = "_batch"


def _folder(target: str, name: str) -> str:
    # A letter first: names that look like numbers or days would be read back as such.
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9._-]*", name):
        raise ValueError(f"{name!r} cannot name a batch: a letter, then letters, digits, '.', '_', '-'")
    return f"{target}/{BATCH}={name}"


def put_batch(df: DataFrame, target: str, name: str) -> None:
    """Make ``df`` the rows of batch ``name`` in the folder ``target``.

    Running it again with the same name replaces that batch and nothing else; new files
    are swapped in when the job commits. No rows leave no batch.
    """
    spark = df.sparkSession
    folder = _folder(target, name)
    rows = df.withColumn(BATCH, F.lit(name))
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rebalanced(rows, [BATCH]).write.mode("overwrite").partitionBy(BATCH).parquet(target)
    if path_exists(spark, folder) and df.isEmpty():
        drop_batch(spark, target, name)


def drop_batch(spark: SparkSession, target: str, name: str) -> None:
    """Take a batch's rows away; nothing happens if there are none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(_folder(target, name))
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def put_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    put_rows: Callable[[DataFrame, str], None] | None = None,
) -> None:
    """Take all that is new in ``stream``, one batch of ``target`` per micro-batch, and stop.

    A batch is named by the query's id, which its checkpoint keeps, and the batch's number:
    one that was written but not yet committed to the checkpoint is replaced by itself, and
    a stream with a fresh checkpoint cannot meet another's batches. ``put_rows`` takes the
    place of ``put_batch`` for callers that do more with a batch (rows, name).
    """

    def put(rows: DataFrame, number: int) -> None:
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        name = f"stream-{query}-{number}"
        # Rows may be read more than once: they come from files, which do not change.
        put_rows(rows, name) if put_rows else put_batch(rows, target, name)

    query = (
        stream.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_batches(spark: SparkSession, target: str, names: list[str] | None = None) -> DataFrame:
    """All rows, or those of some batches, which then are the only folders read.

    Columns that later batches gained are NULL in earlier ones.
    """
    df = spark.read.option("mergeSchema", True).parquet(target)
    return df if names is None else df.where(F.col(BATCH).isin(names))

"""Tables that are replaced as a whole in one step, under running readers."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lookback.operators.publish import write_table

#: Property of the view that names the folder of the version it shows.
VERSION = "lookback.version"


def current_version(spark: SparkSession, name: str) -> str | None:
    """Folder of the version that readers see now."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in rows}.get(VERSION)


def write_version(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    schema: StructType | None = None,
) -> str:
    """Write a whole version beside the others; nobody reads it yet. Returns its folder."""
    # By time, so that the names sort; a unique end, so that two writers never meet.
    folder = f"{root.rstrip('/')}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write_table(df, folder, partition_by, cluster_by=cluster_by, schema=schema)
    return folder


def switch(spark: SparkSession, name: str, folder: str) -> None:
    """Show a version under ``name``: one change of the catalog.

    The name is a view that reads the folder. A query that was planned before goes on
    reading the old version's files, one planned after reads the new ones; none sees both.
    """
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{folder}')"
        f" AS SELECT * FROM parquet.`{folder}`"
    )


def versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of all versions, oldest first; one without its success mark is no version."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/v*/_SUCCESS")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    return sorted((s.getPath().getParent().toString() for s in found), key=lambda p: p.rsplit("/", 1)[1])


def replace_version(
    df: DataFrame,
    name: str,
    root: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    schema: StructType | None = None,
    keep: int = 2,
) -> str:
    """Replace the whole table: write a version, switch to it, remove versions beyond ``keep``.

    A job that dies at any point leaves the table at one whole version. ``keep`` counts the
    new one; it must cover what running queries may still read.
    """
    if keep < 1:
        raise ValueError("the version that readers see must be kept")
    spark = df.sparkSession
    folder = write_version(df, root, partition_by, cluster_by, schema)
    switch(spark, name, folder)
    clean(spark, name, root, keep)
    return folder


def clean(spark: SparkSession, name: str, root: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` whole versions, never the one readers see."""
    shown = (current_version(spark, name) or "").rsplit("/", 1)[-1]
    for folder in versions(spark, root)[:-keep]:
        if folder.rsplit("/", 1)[1] != shown:
            at = spark._jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

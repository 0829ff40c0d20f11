"""Table writes: typed, clustered, repeatable."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import StructType

from lookback.functions.predicates import sql_text
from lookback.operators.expectations import TableConstraints, constraint_audit, stop_if_blocked
from lookback.session import setting
from lookback.sources.files import is_path, load


def to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of a declared table, in its order and types; a missing one raises."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lay rows out by ranges of ``columns``, so that file statistics can skip reads.

    Equal keys would all fall into one range, so the map partition is the last range
    column: a hot key, or any number of copies, is cut at map partition borders.
    """
    spread = "_spread"
    return (
        df.withColumn(spread, F.spark_partition_id())
        .repartitionByRange(*columns, spread)
        .drop(spread)
        .sortWithinPartitions(*columns)
    )


def rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Even out file sizes: AQE merges small partitions and splits large ones."""
    return df.hint("rebalance", *columns)


def write_table(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    cluster_by: Sequence[str] = (),
    schema: StructType | None = None,
) -> None:
    """Create or replace ``target`` (table name or folder), or append to it.

    ``cluster_by`` sorts the rows by the partition columns and then by these;
    without it the partition columns alone balance the file sizes. Overwriting a catalog
    table takes the old one away first; ``replace_table`` does not.
    """
    if schema is not None:
        df = to_schema(df, schema)
    if cluster_by:
        df = clustered(df, [*partition_by, *cluster_by])
    elif partition_by:
        df = rebalanced(df, partition_by)
    if mode == "append" and not is_path(target) and df.sparkSession.catalog.tableExists(target):
        df = _widened(df, target)
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target) if is_path(target) else writer.saveAsTable(target)


def _widened(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the columns of an existing table, which first gains those it lacks.

    Older rows read NULL there, and so do new rows in columns that ``df`` lacks. A column
    of another type is cast to the table's.
    """
    spark = df.sparkSession
    known = {f.name.lower() for f in spark.table(table).schema.fields}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    have = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema.fields
        ]
    )


def _checked(df: DataFrame, constraints: TableConstraints | None, table: str) -> None:
    if constraints:
        rows = constraint_audit(df, constraints, "write", table, "write").collect()
        stop_if_blocked(rows, table)


def replace_partitions(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    constraints: TableConstraints | None = None,
) -> None:
    """Replace only the partitions that ``df`` has rows for. Running it again with the
    same rows leaves the table as it is, and other days stay untouched.

    Rows that violate ``constraints`` publish nothing. They are read for that first, so
    ``df`` should be staged then.
    """
    _checked(df, constraints, target)
    layout = [*partition_by, *cluster_by]
    df = clustered(df, layout) if cluster_by else rebalanced(df, partition_by)
    # insertInto takes the mode from the session only.
    with setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        if is_path(target):
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
        else:
            existing = df.sparkSession.table(target).schema
            to_schema(df, existing).write.insertInto(target, overwrite=True)


def replace_table(
    df: DataFrame,
    table: str,
    partition_by: str,
    cluster_by: Sequence[str] = (),
    schema: StructType | None = None,
    constraints: TableConstraints | None = None,
) -> None:
    """Replace a partitioned table's content without ever taking the table away.

    New partitions are written aside and swapped in when the job commits; partitions
    that ``df`` no longer has are dropped after that, in one statement. A job that dies
    leaves the old rows; between the two steps a reader may see days that are gone beside
    the new ones. A changed schema, or a first run, creates the table instead.

    Rows that violate ``constraints`` publish nothing (see ``replace_partitions``).
    """
    _checked(df, constraints, table)
    spark = df.sparkSession
    if schema is not None:
        df = to_schema(df, schema)

    def shape(fields) -> set:
        return {(f.name, f.dataType) for f in fields}

    if not spark.catalog.tableExists(table) or shape(spark.table(table).schema) != shape(df.schema):
        write_table(df, table, [partition_by], cluster_by=cluster_by)
        return
    value = F.col(partition_by).cast("string")
    # One value per partition, so this is as short as the partition list.
    fresh = {r[0] for r in df.select(value).distinct().collect()}
    replace_partitions(df, table, [partition_by], cluster_by)
    drop_partitions(spark, table, partition_by, partition_values(spark, table) - fresh)


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Replace all rows of an existing table; its declared schema stays."""
    existing = df.sparkSession.table(table).schema
    to_schema(df, existing).write.insertInto(table, overwrite=True)


def append(df: DataFrame, target: str) -> None:
    write_table(df, target, mode="append")


def append_rows(spark: SparkSession, rows: Sequence, schema: StructType, target: str) -> None:
    """Append a few driver-side rows, such as audit results, under a fixed schema."""
    append(spark.createDataFrame(list(rows), schema).coalesce(1), target)


def load_merged(spark: SparkSession, path: str) -> DataFrame:
    """Folder whose files gained columns over time: older rows read NULL there."""
    return spark.read.option("mergeSchema", True).parquet(path)


def staged(df: DataFrame, target: str) -> DataFrame:
    """Write once and read back: later passes start from files, not from the plan, and
    lost executors cost a read instead of a recomputation."""
    write_table(df, target)
    return load(df.sparkSession, target)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, but the columns and types: what a table is declared from."""
    return df.limit(0)


def register(
    spark: SparkSession,
    table: str,
    folder: str,
    partition_by: Sequence[str] = (),
    optional: Sequence[str] = (),
) -> bool:
    """Make a table of an existing Parquet folder known to this session's catalog.

    Catalogs that live in the process forget tables whose files stay. ``optional`` columns
    are partitions where the folder has them. Returns whether there is anything in it.
    """
    if spark.catalog.tableExists(table):
        return True
    try:
        df = spark.read.option("mergeSchema", True).parquet(folder)
    except AnalysisException:
        return False
    partition_by = [*partition_by, *(c for c in optional if c in df.columns)]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{parts} LOCATION '{folder}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return True


def partition_values(spark: SparkSession, table: str) -> set[str | None]:
    """Values of a table's only partition column, from the catalog; no data are read."""
    names = [unquote(r[0].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return {None if n == "__HIVE_DEFAULT_PARTITION__" else n for n in names}


def drop_partitions(spark: SparkSession, table: str, column: str, values) -> None:
    """Take partitions away, in one statement."""
    gone = ", ".join(f"PARTITION ({column} = {sql_text(v)})" for v in values)
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {gone}")


def create_table(
    spark: SparkSession, table: str, schema: StructType, partition_by: Sequence[str] = ()
) -> None:
    """Declare an empty table if it does not exist yet."""
    if not spark.catalog.tableExists(table):
        write_table(spark.createDataFrame([], schema), table, partition_by)


def analyze(spark: SparkSession, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Changes between two snapshots of a table that is unique on ``key``.

    One row per inserted or deleted key and two per changed one, marked in
    ``_change_type`` as insert, delete, update_pre and update_post.
    """
    values = [c for c in new.columns if c not in key]
    a = old.select(F.struct(*key).alias("k"), F.struct(*values).alias("pre"))
    b = new.select(F.struct(*key).alias("k"), F.struct(*values).alias("post"))
    joined = a.alias("a").join(b.alias("b"), F.col("a.k") == F.col("b.k"), "full")

    def change(name: str, side: str, row: str):
        return F.struct(
            F.lit(name).alias("_change_type"),
            *[F.col(f"{side}.k.{c}").alias(c) for c in key],
            *[F.col(f"{row}.{c}").alias(c) for c in values],
        )

    changes = (
        F.when(F.col("a.k").isNull(), F.array(change("insert", "b", "post")))
        .when(F.col("b.k").isNull(), F.array(change("delete", "a", "pre")))
        .when(
            ~F.col("pre").eqNullSafe(F.col("post")),
            F.array(change("update_pre", "a", "pre"), change("update_post", "b", "post")),
        )
    )
    return joined.select(F.inline(changes))

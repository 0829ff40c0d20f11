"""Typed readers for landing files and tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lookback.functions.scalar import now, to_type


def read_jsonl(
    spark: SparkSession, path: str, schema: StructType, malformed: str | None = None
) -> DataFrame:
    """One JSON object per line. A malformed line becomes a row of NULLs; ``malformed``
    names a further column that keeps its text."""
    kept, options = with_malformed(schema, malformed)
    return spark.read.schema(kept).options(**options).json(path)


def with_malformed(schema: StructType, malformed: str | None) -> tuple[StructType, dict[str, str]]:
    """Schema and options of a reader that keeps the text of broken lines in a column."""
    if not malformed:
        return schema, {}
    kept = StructType([*schema.fields, StructField(malformed, StringType())])
    return kept, {"columnNameOfCorruptRecord": malformed}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    by_name: bool = False,
    malformed: str | None = None,
) -> DataFrame:
    """CSV with a header. ``malformed`` names a further column that keeps the text of lines
    with a value that does not fit, or with too many or too few of them.

    By default the header must match the schema; reordered columns raise instead of
    being bound by position. ``by_name`` takes the columns from the header wherever
    they stand, at the price of one small job that reads it.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if not by_name:
        kept, options = with_malformed(schema, malformed)
        return reader.schema(kept).options(**options).csv(path)
    text = reader.option("inferSchema", False).csv(path)
    return text.select(
        *[to_type(f.name, f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    )


def with_lineage(df: DataFrame, clock: dt.datetime | None = None) -> DataFrame:
    """Add load time and source file; works on batch and streaming file scans."""
    return df.withColumns(
        {"_ingested_at": now(clock), "_source_file": F.col("_metadata.file_path")}
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system its path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def is_path(target: str) -> bool:
    return "/" in target


def load(spark: SparkSession, target: str) -> DataFrame:
    """A table by name, or a Parquet folder by path."""
    return spark.read.parquet(target) if is_path(target) else spark.table(target)

"""File layout: a space-filling order over several columns, and compaction of small files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from lookback.session import setting

#: Bytes of a text that order it here; what follows them does not.
PREFIX = 6
#: Error of the ranges' borders, as a share of all rows: one in so many.
ACCURACY = 20_000


def _ordinal(df: DataFrame, column: str) -> Column:
    """A double that is in the order of the column; NULL stays."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, NumericType):
        return value.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        # UTF-8 keeps the order of the characters.
        head = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, PREFIX)), 2 * PREFIX, "0")
        return F.conv(head, 16, 10).cast("double")
    raise ValueError(f"cannot lay {column} out by its {kind.simpleString()} values")


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """One number with the bits of all ranks in turn, the first column's highest first."""
    n = len(ranks)
    total = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            one = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            total = total.bitwiseOR(F.shiftleft(one, bit * n + n - 1 - place))
    return total


def z_ordered(df: DataFrame, columns: Sequence[str], files: int | None = None, bits: int = 8) -> DataFrame:
    """Lay rows out along a space-filling curve over ``columns``.

    Sorting by several columns lets file statistics skip reads for a filter on the first
    only. Here every column is cut into 2^bits ranges of like size, and rows are ranged by
    the interleaved bits of their range numbers, so a file spans a small box and a filter
    on any of the columns skips most files. The borders are approximate quantiles of all
    rows, found in one aggregation; they only shape the files. Ties and hot values are cut
    at map partition borders, as in ``clustered``. Texts are ranged by their first bytes.
    """
    if not columns or bits * len(columns) > 62:
        raise ValueError("needs columns, and at most 62 bits over all of them")
    shares = [n / (1 << bits) for n in range(1, 1 << bits)]
    names = [f"_o{i}" for i in range(len(columns))]
    keyed = df.withColumns({n: F.coalesce(_ordinal(df, c), F.lit(float("-inf"))) for n, c in zip(names, columns, strict=True)})
    found = keyed.agg(*[F.percentile_approx(F.when(F.col(n) > float("-inf"), F.col(n)), shares, ACCURACY).alias(n) for n in names]).first()
    ranks = []
    for name in names:
        borders = sorted({b for b in found[name] or [] if b == b and abs(b) != float("inf")})
        if borders:
            splits = [float("-inf"), *borders, float("inf")]
            keyed = Bucketizer(splits=splits, inputCol=name, outputCol=f"{name}r", handleInvalid="keep").transform(keyed)
            ranks.append(F.least(F.col(f"{name}r"), F.lit((1 << bits) - 1)))
        else:
            ranks.append(F.lit(0))
    keyed = keyed.withColumns({"_z": interleaved(ranks, bits), "_spread": F.spark_partition_id()})
    ranged = keyed.repartitionByRange(files, "_z", "_spread") if files else keyed.repartitionByRange("_z", "_spread")
    return ranged.sortWithinPartitions("_z").select(*df.columns)


def data_files(spark: SparkSession, folder: str) -> DataFrame:
    """Data files below a folder: (``path``, ``length``, ``part``: their folder). Listed by
    Spark; their content is not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    return listed.select("path", "length", F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("part"))


def packed(files: DataFrame, target_bytes: int, max_small: int) -> DataFrame:
    """Bins of about ``target_bytes`` for the files of each part that needs compaction.

    A part does when more than ``max_small`` of its files are below half the target. Files
    are taken by falling size and fill bins one after the other; (``path``, ``part``, ``bin``).
    """
    size = Window.partitionBy("part")
    small = F.sum((F.col("length") < target_bytes / 2).cast("int")).over(size)
    before = F.sum("length").over(size.orderBy(F.desc("length"), "path").rowsBetween(Window.unboundedPreceding, -1))
    crowded = files.withColumns({"_small": small, "_before": F.coalesce(before, F.lit(0))}).where(F.col("_small") > max_small)
    return crowded.select("path", "part", F.floor(F.col("_before") / target_bytes).cast("int").alias("bin"))


def compact(spark: SparkSession, folder: str, partition_by: str, target_bytes: int = 128 << 20, max_small: int = 8) -> int:
    """Merge the small files of a partitioned Parquet folder; returns how many partitions.

    Only partitions with more than ``max_small`` files below half of ``target_bytes`` are
    read and rewritten; the others keep their files. Rows of a bin of files go to one task,
    and each partition's new files are swapped in when the job commits. Rows and columns
    stay as they are; files that gained columns over time are merged.
    """
    crowded = packed(data_files(spark, folder), target_bytes, max_small)
    parts = [r["part"] for r in crowded.select("part").distinct().collect()]
    if not parts:
        return 0
    rows = spark.read.option("basePath", folder).option("mergeSchema", True).parquet(*parts)
    columns = rows.columns
    binned = rows.withColumn("_path", F.col("_metadata.file_path")).join(
        crowded.select(F.col("path").alias("_path"), "bin"), "_path"
    )
    # A bin may hold files without rows only; it then leaves no file, which is right.
    merged = binned.repartition(F.col(partition_by), F.col("bin")).select(*columns)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"), setting(
        spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"
    ):
        merged.write.mode("overwrite").partitionBy(partition_by).parquet(folder)
    return len(parts)

"""Incremental file ingest: every new file is taken exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lookback.sources.files import is_path, with_lineage, with_malformed


#: A hundred years.
NEVER = "36500d"


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    fmt: str = "json",
    max_files: int | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Stream of a landing folder's files with lineage; the schema is never inferred.
    ``malformed`` names a further column that keeps the text of broken lines, as in batches.

    The file source by itself forgets, and for good skips, files older than a week before
    the newest one. Here no file is too old: a late one is taken too. The price is that
    the checkpoint keeps the names of all files ever seen, some hundred bytes each, so
    landing files that are done with should be moved away at times.
    """
    kept, options = with_malformed(schema, malformed)
    reader = spark.readStream.schema(kept).options(**options).option("maxFileAge", NEVER)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(folder).transform(with_lineage)


def ingest_new_files(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append all files not seen before to ``target``, then stop.

    The checkpoint remembers the files and must outlive the job, on shared storage.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    query = writer.start(target) if is_path(target) else writer.toTable(target)
    query.awaitTermination()

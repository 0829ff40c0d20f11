"""JSON lines whose fields are hinted, not fixed: what does not fit is kept, not lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StructField, StructType

from lookback.sources.files import with_lineage
from lookback.streaming.ingest import NEVER

RESCUED, MALFORMED = "_rescued", "_malformed"
_ENTRY = "struct<key:string,value:string>"


def _path(parts: tuple[str, ...]) -> str:
    return "$" + "".join(f"['{p}']" for p in parts)


def _typed(raw: Column, parts: tuple[str, ...], kind: DataType) -> Column:
    """A field in its hinted type, NULL where it does not fit; whole numbers are not cut."""
    if isinstance(kind, IntegralType):
        exact = F.try_variant_get(raw, _path(parts), "decimal(38,10)")
        return F.when(exact == F.floor(exact), exact).try_cast(kind)
    return F.try_variant_get(raw, _path(parts), kind.simpleString())


def _column(raw: Column, field: StructField, parts: tuple[str, ...]) -> Column:
    if isinstance(field.dataType, StructType):
        inner = [_column(raw, f, (*parts, f.name)).alias(f.name) for f in field.dataType.fields]
        is_object = F.try_variant_get(raw, _path(parts), "map<string,variant>").isNotNull()
        return F.when(is_object, F.struct(*inner))
    return _typed(raw, parts, field.dataType)


def _left_over(raw: Column, schema: StructType, parts: tuple[str, ...]) -> list[Column]:
    """Arrays of (path, JSON) of what ``_column`` does not take, per level of the schema."""
    held = F.try_variant_get(raw, _path(parts), "map<string,variant>")
    names = [f.name for f in schema.fields]
    name = lambda e: F.concat_ws(".", *[F.lit(p) for p in parts], e["key"])
    unknown = F.filter(F.map_entries(held), lambda e: ~e["key"].isin(names))
    found = [F.transform(unknown, lambda e: F.struct(name(e).alias("key"), F.to_json(e["value"]).alias("value")))]
    for f in schema.fields:
        own = (*parts, f.name)
        value = F.try_variant_get(raw, _path(own), "variant")
        given = value.isNotNull() & ~F.is_variant_null(value)
        if isinstance(f.dataType, StructType):
            found += _left_over(raw, f.dataType, own)
            lost = F.try_variant_get(raw, _path(own), "map<string,variant>").isNull()
        else:
            lost = _typed(raw, own, f.dataType).isNull()
        entry = F.struct(F.lit(".".join(own)).alias("key"), F.to_json(value).alias("value"))
        found.append(F.when(given & lost, F.array(entry)))
    return found


def rescue(lines: DataFrame, schema: StructType, text: str = "value") -> DataFrame:
    """The hinted columns of JSON objects, one per row of ``text``, and what is left.

    ``schema`` hints types: a field that fits is a typed column, one that is missing, JSON
    null, or of a type that cannot be cast without loss is NULL. ``_rescued`` maps the
    dotted path of every other field, at any depth of the schema, to its JSON text: fields
    that the schema does not name, and named ones that did not fit. It is NULL if there are
    none. A line that is no JSON object (or repeats a key) gives NULLs and its text in
    ``_malformed``. So no line loses anything. Works on batches and streams; other
    columns of ``lines`` stay.
    """
    raw, bare = F.col("_raw"), [c for c in lines.columns if c != text]
    parsed = lines.withColumn("_raw", F.try_parse_json(text))
    parsed = parsed.withColumn("_object", F.try_variant_get(raw, "$", "map<string,variant>").isNotNull())
    none = F.array().cast(f"array<{_ENTRY}>")
    left = F.concat(*[F.coalesce(part.cast(f"array<{_ENTRY}>"), none) for part in _left_over(raw, schema, ())])
    return parsed.withColumn("_left", left).select(
        *[F.when(F.col("_object"), _column(raw, f, (f.name,))).alias(f.name) for f in schema.fields],
        F.when(F.size("_left") > 0, F.map_from_entries("_left")).alias(RESCUED),
        F.when(~F.col("_object"), F.col(text)).alias(MALFORMED),
        *bare,
    )


def _with_text(lines: DataFrame) -> DataFrame:
    # Blank lines are no records, as in the JSON reader.
    return lines.where(F.trim("value") != "").transform(with_lineage)


def read_rescued(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``rescue`` over the lines of files, with lineage."""
    return rescue(_with_text(spark.read.text(path)), schema)


def stream_rescued(spark: SparkSession, folder: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """The same as a stream of the folder's new files."""
    reader = spark.readStream.option("maxFileAge", NEVER)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return rescue(_with_text(reader.text(folder)), schema)


def rescued_fields(df: DataFrame) -> DataFrame:
    """What the schema misses: rows, and the type inferred from all values, per path.

    The answer to "what should be hinted next"; (``path``, ``n_rows``, ``inferred``).
    """
    fields = df.select(F.explode(RESCUED).alias("path", "json"))
    return fields.groupBy("path").agg(
        F.count("*").alias("n_rows"), F.schema_of_variant_agg(F.try_parse_json("json")).alias("inferred")
    )

"""The test tables read as impressions, clicks and payments.

``events`` supplies all three by its event type. The category and the position come
from the number in its JSON payload.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback import schemas
from lookback.operators.conform import distinct_on
from lookback.plans.rules import CATEGORIES

VIEW, CLICK, PURCHASE = "view", "click", "purchase"

# Clock of the rules on the test tables: two days before their last event.
AS_OF = dt.date(2024, 1, 28)


# Declared, so that no job reads file footers to find them out.
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,"
    " o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
}

_CATEGORY = "element_at(array({}), k % {} + 1)".format(
    ", ".join(f"'{c}'" for c in CATEGORIES), len(CATEGORIES)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def typed(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    """Events of one type with the day, entity, position and amount (a bag)."""
    return (
        table(spark, sf_dir, "events")
        .where(f"event_type = '{event_type}'")
        .selectExpr(
            "to_date(ts) AS day", "user_id", "value", "from_json(props, 'k INT').k AS k"
        )
        .selectExpr(
            "day",
            "user_id",
            f"{_CATEGORY} AS value_prop",
            "k % 4 AS position",
            "value AS total",
            "k",
        )
    )


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_on(typed(spark, sf_dir, VIEW), schemas.EVENT_KEY)


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_on(typed(spark, sf_dir, CLICK), schemas.EVENT_KEY)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(spark, sf_dir, PURCHASE).select(*schemas.PAYMENTS.names)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions, clicks and payments in one scan; payments have no position."""
    names = {VIEW: "print", CLICK: "tap", PURCHASE: "pay"}
    pairs = ", ".join(f"'{a}', '{b}'" for a, b in names.items())
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin(list(names)))
        .selectExpr(
            "to_date(ts) AS ev_day",
            f"element_at(map({pairs}), event_type) AS etype",
            "user_id",
            "value",
            "from_json(props, 'k INT').k AS k",
        )
        .selectExpr(
            "ev_day",
            "etype",
            "user_id",
            f"{_CATEGORY} AS value_prop",
            "CASE WHEN etype <> 'pay' THEN k % 4 END AS position",
            "CASE WHEN etype = 'pay' THEN value END AS amount",
        )
    )


def messy(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    """All events of a type, with faults for the rules to find: missing and unknown
    categories, positions past the range, negative amounts."""
    return typed(spark, sf_dir, event_type).selectExpr(
        "day",
        "user_id",
        "CASE WHEN k >= 95 THEN NULL WHEN k >= 90 THEN 'other' ELSE value_prop END AS value_prop",
        "k % 13 AS position",
        "total - 5 AS total",
        "k",
    )


def land_events(
    df: DataFrame, folder: str, broken: bool = False, mode: str = "overwrite"
) -> None:
    """Write rows as JSON lines; ``broken`` cuts some lines short and spoils some days."""
    k, day = F.col("k"), F.col("day").cast("string")
    if broken:
        day = F.when(k.between(95, 98), F.lit("not-a-day")).otherwise(day)
    line = F.to_json(
        F.struct(
            day.alias("day"),
            F.struct("position", "value_prop").alias("event_data"),
            "user_id",
        )
    )
    if broken:
        line = F.when(k == 99, F.substring(line, 1, 15)).otherwise(line)
    df.select(line.alias("value")).write.mode(mode).text(folder)


def land_odd_events(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """JSON lines with fields beyond the schema (k 80 to 84, and nested 90 to 94), values of
    the wrong type (85 to 89, 95 to 97), a line that is no object (98) and a cut one (99)."""
    k, day, user = F.col("k"), F.col("day").cast("string").alias("day"), F.col("user_id")
    event = F.struct("position", "value_prop").alias("event_data")

    def line(*fields) -> Column:
        return F.to_json(F.struct(*fields))

    slot = F.concat(F.lit("s"), (k % 3).cast("string")).alias("slot")
    text = (
        F.when(k.between(80, 84), line(day, event, user, F.struct(k.alias("id")).alias("campaign")))
        .when(k.between(85, 89), line(day, event, F.concat(F.lit("u"), user.cast("string")).alias("user_id")))
        .when(k.between(90, 94), line(day, F.struct("position", "value_prop", slot).alias("event_data"), user))
        .when(k.between(95, 96), line(day, F.struct((F.col("position") + 0.5).alias("position"), "value_prop").alias("event_data"), user))
        .when(k == 97, line(day, F.lit("none").alias("event_data"), user))
        .when(k == 98, F.lit("[1]"))
        .when(k == 99, F.substring(line(day, event, user), 1, 15))
        .otherwise(line(day, event, user))
    )
    df.select(text.alias("value")).write.mode(mode).text(folder)


def move_aged(spark: SparkSession, source: str, target: str, days: int) -> None:
    """Move files into a folder as if they had been written ``days`` before now."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(source)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    old = jvm.java.lang.System.currentTimeMillis() - days * 86_400_000
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if name.startswith("part-"):
            moved = jvm.org.apache.hadoop.fs.Path(f"{target}/{name}")
            fs.rename(status.getPath(), moved)
            fs.setTimes(moved, old, -1)


def land_payments(
    df: DataFrame, folder: str, broken: bool = False, mode: str = "overwrite"
) -> None:
    """Write rows as CSV with a header; ``broken`` spoils some amounts."""
    total = F.col("total").cast("string")
    if broken:
        total = F.when(F.col("k") >= 95, F.lit("n/a")).otherwise(total)
    df.select(
        F.col("day").cast("string").alias("pay_date"),
        total.alias("total"),
        "user_id",
        "value_prop",
    ).write.mode(mode).option("header", True).csv(folder)

"""Explicit schemas: landing files, conformed tables, features and the audit log."""

from __future__ import annotations

from pyspark.sql import types as T

# The names and types of all columns below.
ENTITY = ["user_id", "value_prop"]
EVENT_KEY = ["day", "user_id", "value_prop", "position"]

EVENT_LANDING = T.StructType(
    [
        T.StructField("day", T.StringType()),
        T.StructField(
            "event_data",
            T.StructType(
                [
                    T.StructField("position", T.IntegerType()),
                    T.StructField("value_prop", T.StringType()),
                ]
            ),
        ),
        T.StructField("user_id", T.LongType()),
    ]
)

PAYMENT_LANDING = T.StructType(
    [
        T.StructField("pay_date", T.StringType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value_prop", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value_prop", T.StringType()),
        T.StructField("position", T.IntegerType()),
    ]
)

PAYMENTS = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value_prop", T.StringType()),
        T.StructField("total", T.DoubleType()),
    ]
)

FEATURES = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value_prop", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("clicked", T.IntegerType()),
        T.StructField("views_3w", T.LongType()),
        T.StructField("taps_3w", T.LongType()),
        T.StructField("pays_3w", T.LongType()),
        T.StructField("amount_3w", T.DoubleType()),
        T.StructField("ctr_3w", T.DoubleType()),
        T.StructField("avg_ticket_3w", T.DoubleType()),
        T.StructField("_computed_at", T.TimestampType()),
    ]
)

FEATURE_NAMES = ["views_3w", "taps_3w", "pays_3w", "amount_3w", "ctr_3w", "avg_ticket_3w"]

AUDIT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("expectation", T.StringType()),
        T.StructField("constraint", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("failed_rows", T.LongType()),
        T.StructField("failure_rate", T.DoubleType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("checked_at", T.TimestampType()),
    ]
)

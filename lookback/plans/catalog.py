"""Registered queries: every operator, run over the whole test tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lookback import schemas
from lookback.config import AUDIT_TABLE, PipelineConfig
from lookback.functions.predicates import days_between
from lookback.functions.scalar import from_units, safe_ratio, to_day, to_type, to_units
from lookback.operators import audit, conform, publish, training
from lookback.operators.bandjoin import band_join
from lookback.operators.expectations import (
    Expectation,
    audit_frame,
    constraint_audit,
    expect,
    expect_all_or_drop,
    expect_or_fail,
    keep_valid,
    key_duplicates,
    quarantined,
)
from lookback.operators.lookup import flag_if_present
from lookback.operators.pit import (
    EventSource,
    Metric,
    daily_rollup,
    last_day_of,
    pit_features,
    serving_days,
    typed_events,
)
from lookback.plans import bindings as b
from lookback.operators.changes import apply_changes
from lookback.operators.keyed import lookup_few, write_keyed
from lookback.operators.layout import compact, z_ordered
from lookback.operators.versions import replace_version
from lookback.plans import incremental, layers, rules
from lookback.plans.features import (
    compute_features,
    compute_features_sql,
    event_stream,
    feature_metrics,
    features_from_log,
)
from lookback.plans.replay import replay
from lookback.session import scratch_dir
from lookback.sources.files import load, read_csv, read_jsonl, with_lineage
from lookback.sources.rescue import MALFORMED, RESCUED, read_rescued, rescued_fields, stream_rescued
from lookback.streaming.ingest import ingest_new_files, stream_files
from lookback.streaming.shared import load_batches, put_batch, put_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The amounts of the test tables have two decimals.
SCALE = 2


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- sources


@query
def ingest_jsonl_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "prints.json")
    b.land_events(b.typed(spark, sf_dir, b.VIEW), folder, broken=True)
    return read_jsonl(spark, folder, schemas.EVENT_LANDING).select(
        "day", "event_data.position", "event_data.value_prop", "user_id"
    )


@query
def ingest_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "pays.csv")
    b.land_payments(b.typed(spark, sf_dir, b.PURCHASE), folder, broken=True)
    return read_csv(spark, folder, schemas.PAYMENT_LANDING)


@query
def ingest_csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared columns stand in another order in the file."""
    folder = scratch_dir(spark, "pays.csv")
    b.land_payments(b.typed(spark, sf_dir, b.PURCHASE), folder, broken=True)
    turned = StructType(schemas.PAYMENT_LANDING.fields[::-1])
    return read_csv(spark, folder, turned, by_name=True)


@query
def ingest_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per landing file kind, JSON and CSV, from the lineage columns."""
    root = scratch_dir(spark, "landing")
    for event_type, name in ((b.VIEW, "prints.json"), (b.CLICK, "taps.json")):
        b.land_events(b.typed(spark, sf_dir, event_type), f"{root}/{name}")
    b.land_payments(b.typed(spark, sf_dir, b.PURCHASE), f"{root}/pays.csv")
    events = read_jsonl(spark, f"{root}/*.json", schemas.EVENT_LANDING)
    pays = read_csv(spark, f"{root}/pays.csv", schemas.PAYMENT_LANDING)
    stamps = ["_ingested_at", "_source_file"]
    raw = with_lineage(events).select(stamps).unionByName(with_lineage(pays).select(stamps))
    folder = F.regexp_extract("_source_file", "([^/]+)/[^/]+$", 1)
    return raw.groupBy(folder.alias("source")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("_ingested_at").alias("stamped"),
    )


@query
def ingest_stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files land twice; each of the three runs takes only what is new."""
    root = scratch_dir(spark, "stream")
    rows = b.typed(spark, sf_dir, b.VIEW)
    half = F.lit(dt.date(2024, 1, 16))

    def take() -> None:
        stream = stream_files(spark, f"{root}/in", schemas.EVENT_LANDING)
        ingest_new_files(stream, f"{root}/raw", f"{root}/checkpoint")

    b.land_events(rows.where(F.col("day") < half), f"{root}/in")
    take()
    b.land_events(rows.where(F.col("day") >= half), f"{root}/in", mode="append")
    take()
    take()
    return conform.flatten_events(load(spark, f"{root}/raw"))


@query
def ingest_stream_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive ten days older than the newest one seen are taken all the same."""
    root = scratch_dir(spark, "stream")
    rows = b.typed(spark, sf_dir, b.VIEW)
    half = F.lit(dt.date(2024, 1, 16))

    def take() -> None:
        stream = stream_files(spark, f"{root}/in", schemas.EVENT_LANDING)
        ingest_new_files(stream, f"{root}/raw", f"{root}/checkpoint")

    b.land_events(rows.where(F.col("day") >= half), f"{root}/in")
    take()
    b.land_events(rows.where(F.col("day") < half), f"{root}/late")
    b.move_aged(spark, f"{root}/late", f"{root}/in", days=10)
    take()
    return conform.flatten_events(load(spark, f"{root}/raw"))


@query
def ingest_stream_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream")
    b.land_payments(b.typed(spark, sf_dir, b.PURCHASE), f"{root}/in")
    stream = stream_files(spark, f"{root}/in", schemas.PAYMENT_LANDING, "csv")
    ingest_new_files(stream, f"{root}/raw", f"{root}/checkpoint")
    return conform.flatten_payments(load(spark, f"{root}/raw"))


def _rescued(raw: DataFrame) -> DataFrame:
    """Where each part of an odd line went."""
    left = F.col(RESCUED)
    return raw.select(
        "day",
        "event_data.position",
        "event_data.value_prop",
        "user_id",
        left["campaign"].alias("campaign"),
        left["event_data.slot"].alias("slot"),
        left["user_id"].alias("odd_user"),
        left["event_data.position"].alias("odd_position"),
        left["event_data"].alias("odd_event"),
        F.coalesce(F.size(left), F.lit(0)).alias("n_rescued"),
        F.col(MALFORMED).alias("malformed"),
    )


@query
def ingest_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown fields, wrong types and broken lines, each kept in its place."""
    folder = scratch_dir(spark, "prints.json")
    b.land_odd_events(b.typed(spark, sf_dir, b.VIEW), folder)
    return _rescued(read_rescued(spark, folder, schemas.EVENT_LANDING))


@query
def ingest_rescued_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stream, in two runs."""
    root = scratch_dir(spark, "stream")
    rows = b.typed(spark, sf_dir, b.VIEW)
    for part in (F.col("user_id") % 2 == 0, F.col("user_id") % 2 != 0):
        b.land_odd_events(rows.where(part), f"{root}/in", mode="append")
        stream = stream_rescued(spark, f"{root}/in", schemas.EVENT_LANDING)
        ingest_new_files(stream, f"{root}/raw", f"{root}/checkpoint")
    return _rescued(load(spark, f"{root}/raw"))


@query
def ingest_rescued_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the hinted schema misses, with the types inferred from the values."""
    folder = scratch_dir(spark, "prints.json")
    b.land_odd_events(b.typed(spark, sf_dir, b.VIEW), folder)
    return rescued_fields(read_rescued(spark, folder, schemas.EVENT_LANDING))


@query
def ingest_shared_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw table filled by a stream, a batch, the stream again, and the batch again,
    whose first run had only half of its rows."""
    root = scratch_dir(spark, "shared")
    rows = b.typed(spark, sf_dir, b.VIEW)
    day = F.col("day")
    first, second = F.lit(dt.date(2024, 1, 10)), F.lit(dt.date(2024, 1, 20))

    def batch(some: DataFrame, name: str) -> None:
        b.land_events(some, f"{root}/{name}")
        put_batch(read_rescued(spark, f"{root}/{name}", schemas.EVENT_LANDING), f"{root}/raw", "backfill")

    def stream(some: DataFrame) -> None:
        b.land_events(some, f"{root}/in", mode="append")
        put_stream(
            stream_rescued(spark, f"{root}/in", schemas.EVENT_LANDING), f"{root}/raw", f"{root}/checkpoint"
        )

    middle = rows.where((day >= first) & (day < second))
    stream(rows.where(day < first))
    batch(middle.where("k < 50"), "half")
    stream(rows.where(day >= second))
    for _ in range(2):
        batch(middle, "whole")
    return conform.flatten_events(load_batches(spark, f"{root}/raw"))


# ---------------------------------------------------------------- conform


@query
def conform_flatten_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken lines and days turn to NULL and the key filter drops them."""
    folder = scratch_dir(spark, "prints.json")
    b.land_events(b.typed(spark, sf_dir, b.VIEW), folder, broken=True)
    raw = read_jsonl(spark, folder, schemas.EVENT_LANDING)
    return conform.require_keys(
        conform.flatten_events(raw), ["day", "user_id", "value_prop"]
    )


@query
def conform_dedup_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.impressions(spark, sf_dir)


@query
def conform_payments_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.payments(spark, sf_dir)


@query
def scalar_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Safe parsing, guarded ratios, conditionals, rounding, day arithmetic, text."""
    k = F.col("k")
    day_text = F.when(k < 90, F.col("day").cast("string")).otherwise(F.lit("n/a"))
    number_text = F.when(k < 95, k.cast("string")).otherwise(F.lit("x"))
    return b.typed(spark, sf_dir, b.PURCHASE).select(
        "user_id",
        to_day(day_text).alias("parsed_day"),
        to_type(number_text, "int").alias("parsed_k"),
        safe_ratio("total", k % 5).alias("ratio"),
        F.when(F.col("total") > 50, "high").otherwise("low").alias("band"),
        F.round(F.col("total") * 10, 0).alias("tenths"),
        F.date_sub("day", 21).alias("window_start"),
        F.concat(F.lit("k="), k.cast("string")).alias("tag"),
        from_units(to_units("total", SCALE), SCALE).alias("exact_total"),
    )


# ---------------------------------------------------------------- point in time


@query
def bounds_serving_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = b.impressions(spark, sf_dir)
    return prints.where(days_between("day", *serving_days(last_day_of(prints), 7)))


@query
def event_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_stream(
        b.impressions(spark, sf_dir), b.clicks(spark, sf_dir), b.payments(spark, sf_dir)
    )


@query
def event_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional counts and sums, one row per entity and day."""
    daily = daily_rollup(
        event_union(spark, sf_dir), schemas.ENTITY, feature_metrics(SCALE)
    )
    return daily.withColumn("amount_3w", from_units("amount_3w", SCALE))


@query
def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_if_present(
        b.impressions(spark, sf_dir),
        b.clicks(spark, sf_dir),
        ["day", "user_id", "value_prop"],
        "clicked",
    )


def _features(
    spark: SparkSession, sf_dir: str, form: str = "window", last_day: dt.date | None = None
) -> DataFrame:
    last = last_day or _last_view_day(spark, sf_dir)
    if form == "window":
        log = b.event_log(spark, sf_dir)
        return features_from_log(log, last or dt.date(1970, 1, 1), amount_scale=SCALE).drop("_computed_at")
    return compute_features(
        b.impressions(spark, sf_dir),
        b.clicks(spark, sf_dir),
        b.payments(spark, sf_dir),
        last_day=last,
        amount_scale=SCALE,
        form=form,
    ).drop("_computed_at")


def _last_view_day(spark: SparkSession, sf_dir: str) -> dt.date | None:
    # Without the deduplication: it cannot change a maximum.
    return last_day_of(b.typed(spark, sf_dir, b.VIEW))


@query
def click_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


@query
def click_features_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, "join")


@query
def click_features_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, "binned")


@query
def click_features_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature query written in SQL."""
    return compute_features_sql(
        b.impressions(spark, sf_dir),
        b.clicks(spark, sf_dir),
        b.payments(spark, sf_dir),
        _last_view_day(spark, sf_dir),
        amount_scale=SCALE,
    ).drop("_computed_at")


def _orders_90d(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    orders = b.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.to_date("o_orderdate").alias("day"),
        "o_totalprice",
    )
    return pit_features(
        orders.drop("o_totalprice"),
        typed_events([EventSource(orders, "order", amount="o_totalprice")], ["o_custkey"]),
        keys=["o_custkey"],
        metrics=[
            Metric("orders_90d", "order"),
            Metric("spent_90d", "order", total=True, scale=SCALE),
        ],
        lookback=90,
        spine_in_events=True,
        form=form,
    )


@query
def pit_orders_90d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another entity, day and window: a customer's orders of the 90 days before."""
    return _orders_90d(spark, sf_dir, "window")


@query
def pit_orders_90d_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_90d(spark, sf_dir, "binned")


@query
def pit_foreign_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spine that is not part of the history: clicks over the payments before them."""
    return pit_features(
        b.clicks(spark, sf_dir),
        typed_events(
            [EventSource(b.payments(spark, sf_dir), "pay", amount="total")], schemas.ENTITY
        ),
        keys=schemas.ENTITY,
        metrics=[
            Metric("pays_7d", "pay"),
            Metric("amount_7d", "pay", total=True, scale=SCALE),
        ],
        lookback=7,
    )


@query
def pit_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log of all event types, read once for the history: each purchase with what
    its user did in the week before."""
    log = b.table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "to_date(ts) AS ev_day", "event_type AS etype", "value AS amount"
    )
    return pit_features(
        log.where(F.col("etype") == b.PURCHASE).select(
            "event_id", "user_id", F.col("ev_day").alias("day")
        ),
        log.drop("event_id"),
        keys=["user_id"],
        metrics=[
            *[Metric(f"{t}s_7d", t) for t in (b.VIEW, b.CLICK, b.PURCHASE, "error", "signup")],
            Metric("spent_7d", b.PURCHASE, total=True, scale=SCALE),
        ],
        lookback=7,
        spine_in_events=True,
    )


@query
def band_join_keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval join without equality keys: each day with the days before it."""
    daily = daily_rollup(
        event_union(spark, sf_dir), [], [Metric("views", "print"), Metric("taps", "tap")]
    ).withColumn("ev", F.unix_date("ev_day"))
    days = daily.select(
        F.col("ev_day").alias("day"),
        (F.col("ev") - 21).alias("lo"),
        (F.col("ev") - 1).alias("hi"),
    )
    pairs = band_join(days, daily.drop("ev_day"), "lo", "hi", "ev", bin_width=30)
    return pairs.groupBy("day").agg(
        F.count(F.lit(1)).alias("days_before"),
        F.sum("views").alias("views"),
        F.sum("taps").alias("taps"),
    )


@query
def topk_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _features(spark, sf_dir)
        .orderBy(F.desc("views_3w"), *schemas.EVENT_KEY)
        .limit(10)
    )


@query
def preview_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.impressions(spark, sf_dir).orderBy(*schemas.EVENT_KEY).limit(5)


# ---------------------------------------------------------------- data quality

STAMPS = ["run_id", "checked_at"]


def _audit(df: DataFrame, expectations: list[Expectation], layer: str, name: str) -> DataFrame:
    return audit_frame(df, expectations, layer, name, "run").drop(*STAMPS, "constraint")


@query
def dq_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(b.messy(spark, sf_dir, b.VIEW), rules.event_rules(b.AS_OF), "silver", "prints")


@query
def dq_events_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule set that drops unknown categories and positions."""
    return _audit(
        b.messy(spark, sf_dir, b.CLICK), rules.event_rules(b.AS_OF, strict=True), "silver", "taps"
    )


@query
def dq_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(
        b.messy(spark, sf_dir, b.PURCHASE), rules.payment_rules(), "silver", "pays"
    )


@query
def dq_payments_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts that are no number are violations, not the largest amounts."""
    messy = b.messy(spark, sf_dir, b.PURCHASE)
    total = F.when(F.col("k") % 10 == 3, F.lit(float("nan"))).otherwise(F.col("total"))
    return _audit(messy.withColumn("total", total), rules.payment_rules(), "silver", "pays")


@query
def dq_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(_features(spark, sf_dir), rules.feature_rules(), "gold", "click_features")


@query
def dq_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules given as mappings of one action each."""
    declared = [
        *expect_or_fail("user_id_not_null", "user_id IS NOT NULL"),
        *expect_all_or_drop(
            {"total_non_negative": "total >= 0", "total_moderate": "total < 100"}
        ),
        *expect("value_prop_known", rules.KNOWN_CATEGORY),
    ]
    return _audit(b.messy(spark, sf_dir, b.PURCHASE), declared, "silver", "pays")


@query
def dq_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(b.messy(spark, sf_dir, b.PURCHASE), rules.payment_rules()).drop("k")


@query
def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = quarantined(b.messy(spark, sf_dir, b.PURCHASE), rules.payment_rules())
    return rejected.drop("k", "_quarantined_at")


@query
def dq_pk_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness over raw impressions, NULL parts included."""
    return key_duplicates(
        b.messy(spark, sf_dir, b.VIEW), schemas.EVENT_KEY, "silver", "prints", "run"
    ).drop(*STAMPS, "constraint")


@query
def dq_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT NULL, CHECK and the primary key, its uniqueness included."""
    features = publish.staged(_features(spark, sf_dir), scratch_dir(spark, "features"))
    rows = constraint_audit(features, rules.FEATURE_CONSTRAINTS, "gold", "click_features", "run")
    return rows.drop(*STAMPS, "constraint")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit log with one run per event day."""
    day = F.col("day")
    return audit_frame(
        b.messy(spark, sf_dir, b.VIEW),
        rules.event_rules(b.AS_OF),
        "silver",
        "prints",
        run_id=day.cast("string"),
        checked_at=day.cast("timestamp"),
        by="day",
    )


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("checked_on", F.to_date("checked_at")).drop("checked_at")


@query
def dq_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(_history(spark, sf_dir)).drop("constraint", "run_id")


@query
def dq_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(audit.dq_latest(_history(spark, sf_dir)))


@query
def dq_latest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persistent view over a logged history, asked in SQL."""
    schema = f"mon_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{scratch_dir(spark, 'monitoring')}'")
    publish.append(_history(spark, sf_dir), f"{schema}.dq_results")
    audit.create_latest_view(spark, f"{schema}.dq_results", f"{schema}.dq_latest")
    return spark.sql(f"""
        SELECT table_name, expectation, action, failed_rows, failure_pct
        FROM {schema}.dq_latest WHERE NOT passed OR action = 'fail'
    """)


@query
def dq_latest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(audit.latest_report(_history(spark, sf_dir))).drop("constraint")


@query
def dq_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(audit.dq_trend(_history(spark, sf_dir)))


@query
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.dq_gate(_history(spark, sf_dir))


@query
def dq_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Red critical rules of the latest state, with the range rule made critical."""
    strict = [
        dataclasses.replace(r, action="fail") for r in rules.event_rules(b.AS_OF)
    ]
    log = audit_frame(b.messy(spark, sf_dir, b.VIEW), strict, "silver", "prints", "run")
    return audit.breaches(audit.dq_latest(log)).drop("checked_at")


@query
def dq_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.dq_alerts(audit.dq_latest(_history(spark, sf_dir)))


# ---------------------------------------------------------------- publishing


@query
def publish_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish all days, then the last day again with other values, twice."""
    folder = scratch_dir(spark, "features")
    last = _last_view_day(spark, sf_dir)
    publish.write_table(_features(spark, sf_dir), folder, ["day"])
    # Staged: a job must not read the folder whose partitions it replaces.
    rerun = publish.staged(
        load(spark, folder)
        .where(F.col("day") == F.lit(last))
        .withColumn("views_3w", F.col("views_3w") + 100),
        scratch_dir(spark, "rerun"),
    )
    for _ in range(2):
        publish.replace_partitions(rerun, folder, ["day"], schemas.ENTITY)
    return load(spark, folder)


@query
def publish_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "pays")
    publish.write_table(
        b.payments(spark, sf_dir),
        folder,
        ["day"],
        cluster_by=schemas.ENTITY,
        schema=schemas.PAYMENTS,
    )
    return load(spark, folder)


@query
def publish_append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append rows that have one column more than the table so far."""
    folder = scratch_dir(spark, "log")
    pays = b.payments(spark, sf_dir)
    half = F.lit(dt.date(2024, 1, 16))
    publish.append(pays.where(F.col("day") < half), folder)
    publish.append(
        pays.where(F.col("day") >= half).withColumn("currency", F.lit("EUR")), folder
    )
    return publish.load_merged(spark, folder)


@query
def publish_table_append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table gains a column from an append; older rows read NULL there."""
    schema = f"pub_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{scratch_dir(spark, 'warehouse')}'")
    pays = b.payments(spark, sf_dir)
    half = F.lit(dt.date(2024, 1, 16))
    publish.append(pays.where(F.col("day") < half), f"{schema}.log")
    publish.append(
        pays.where(F.col("day") >= half).withColumn("currency", F.lit("EUR")), f"{schema}.log"
    )
    return spark.table(f"{schema}.log")


@query
def publish_table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared table, filled, overwritten in full, analyzed."""
    root = scratch_dir(spark, "warehouse")
    schema = f"pub_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{root}'")
    table = f"{schema}.prints"
    publish.create_table(spark, table, schemas.EVENTS)
    publish.insert_overwrite(b.clicks(spark, sf_dir), table)
    publish.insert_overwrite(b.impressions(spark, sf_dir), table)
    publish.analyze(spark, table)
    return spark.table(table)


@query
def publish_z_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments laid out by user and category at once."""
    folder = scratch_dir(spark, "pays")
    z_ordered(b.payments(spark, sf_dir), ["user_id", "value_prop"], files=16).write.parquet(folder)
    return load(spark, folder)


@query
def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced twice as a whole, and what a reader that began before still sees."""
    root = scratch_dir(spark, "versions")
    schema = f"pub_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{scratch_dir(spark, 'warehouse')}'")
    table = f"{schema}.pays"
    pays = b.payments(spark, sf_dir)
    replace_version(pays.where("total > 50"), table, root, ["day"], schemas.ENTITY)
    early = spark.table(table).select("day", "total").withColumn("seen", F.lit("before"))
    replace_version(pays, table, root, ["day"], schemas.ENTITY)
    now = spark.table(table).select("day", "total").withColumn("seen", F.lit("after"))
    return early.unionByName(now)


@query
def publish_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder that many small appends filled, packed into few files a day."""
    folder = scratch_dir(spark, "pays")
    pays = b.payments(spark, sf_dir)
    for part in range(3):
        some = pays.where(F.pmod(F.xxhash64("user_id"), F.lit(3)) == part).repartition(4)
        some.write.mode("append").partitionBy("day").parquet(folder)
    compact(spark, folder, "day", max_small=3)
    return load(spark, folder)


@query
def audit_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of two tables appended to one log and read back."""
    log = scratch_dir(spark, "dq_results")
    for event_type, name in ((b.VIEW, "prints"), (b.CLICK, "taps")):
        rows = audit_frame(
            b.messy(spark, sf_dir, event_type),
            rules.event_rules(b.AS_OF),
            "silver",
            name,
            "run",
        ).collect()
        publish.append_rows(spark, rows, schemas.AUDIT, log)
    return load(spark, log).drop(*STAMPS, "constraint")


@query
def feature_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes from yesterday's table, which had not seen large payments yet."""
    last = _last_view_day(spark, sf_dir)
    old = compute_features(
        b.impressions(spark, sf_dir),
        b.clicks(spark, sf_dir),
        b.payments(spark, sf_dir).where("total <= 50"),
        last_day=last - dt.timedelta(days=1),
        amount_scale=SCALE,
    ).drop("_computed_at")
    new = _features(spark, sf_dir, last_day=last)
    old, new = (publish.staged(x, scratch_dir(spark, "snapshot")) for x in (old, new))
    return publish.snapshot_diff(old, new, schemas.EVENT_KEY)


@query
def feature_changes_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's table made today's by the changes between them alone."""
    schema = f"serve_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{scratch_dir(spark, 'serving')}'")
    last = _last_view_day(spark, sf_dir)
    old = compute_features(
        b.impressions(spark, sf_dir),
        b.clicks(spark, sf_dir),
        b.payments(spark, sf_dir).where("total <= 50"),
        last_day=last - dt.timedelta(days=1),
        amount_scale=SCALE,
    ).drop("_computed_at")
    publish.write_table(old, f"{schema}.features", ["day"])
    new = publish.staged(_features(spark, sf_dir, last_day=last), scratch_dir(spark, "snapshot"))
    changes = publish.snapshot_diff(spark.table(f"{schema}.features"), new, schemas.EVENT_KEY)
    apply_changes(changes, f"{schema}.features", schemas.EVENT_KEY, "day", schemas.ENTITY)
    return spark.table(f"{schema}.features")


@query
def changes_between_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month, of which some are gone, some new, some dearer and some a month later."""
    schema = f"serve_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{scratch_dir(spark, 'serving')}'")
    orders = b.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "trunc(o_orderdate, 'MM') AS month"
    )
    key = F.col("o_orderkey")
    publish.write_table(orders.where(key % 7 != 0), f"{schema}.orders", ["month"])
    new = orders.where(key % 11 != 0).withColumns(
        {
            "o_totalprice": F.when(key % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
            "month": F.when(key % 13 == 0, F.add_months("month", 1)).otherwise(F.col("month")),
        }
    )
    changes = publish.snapshot_diff(spark.table(f"{schema}.orders"), new, ["o_orderkey"])
    apply_changes(changes, f"{schema}.orders", ["o_orderkey"], "month")
    return spark.table(f"{schema}.orders")


# ---------------------------------------------------------------- training


@query
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All labelled impressions; those older than the features find none."""
    features = publish.staged(_features(spark, sf_dir), scratch_dir(spark, "features"))
    return training.training_set(label_lookup(spark, sf_dir), features)


@query
def lookup_few_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the impressions of a few users, from files with Bloom filters."""
    folder = scratch_dir(spark, "features")
    write_keyed(_features(spark, sf_dir), folder, ["user_id", "value_prop"], ["day"], schemas.ENTITY)
    spine = b.impressions(spark, sf_dir).where("user_id % 97 = 3")
    return lookup_few(spine, load(spark, folder), schemas.EVENT_KEY, schemas.FEATURE_NAMES)


@query
def train_test_split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = training.hash_split(label_lookup(spark, sf_dir), schemas.EVENT_KEY)
    return (
        train.withColumn("side", F.lit("train"))
        .unionByName(test.withColumn("side", F.lit("test")))
        .groupBy("side", "day")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("clicked").alias("clicked"))
    )


@query
def feature_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well past click rate alone ranks the clicked impressions."""
    features = _features(spark, sf_dir)
    auc = training.area_under_roc(features, score="ctr_3w")
    return spark.createDataFrame([(round(auc, 6),)], "auc double")


def _model(spark: SparkSession, sf_dir: str):
    """The click model fitted on all training rows, the held-out rows and the features."""
    features = publish.staged(_features(spark, sf_dir), scratch_dir(spark, "features"))
    rows = training.training_set(features.select(*schemas.EVENT_KEY, "clicked"), features)
    train, test = training.hash_split(rows, schemas.EVENT_KEY)
    return training.click_model().fit(train), test, features


@query
def click_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored held-out keys, with what must hold for the scores of any model."""
    model, test, features = _model(spark, sf_dir)
    scored = training.score_batch(model, test.drop("clicked"), features)
    p = F.col("probability")
    return scored.select(
        *schemas.EVENT_KEY,
        p.between(0, 1).alias("is_probability"),
        ((p > 0.5) == (F.col("prediction") == 1.0)).alias("is_consistent"),
    )


@query
def click_model_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out AUC by Spark ML beside the rank-sum AUC of the same staged scores."""
    model, test, _ = _model(spark, sf_dir)
    score = vector_to_array("rawPrediction")[1]
    scored = model.transform(test).select("clicked", score.alias("score"))
    scored = publish.staged(scored, scratch_dir(spark, "scores"))
    auc = training.area_under_roc(scored, score="score")
    ranks = scored.groupBy("score").agg(
        F.sum("clicked").alias("p"), F.sum(1 - F.col("clicked")).alias("n")
    )
    # Ranks in two steps: over ranges of scores, then within each, so no task sorts all.
    ranks = ranks.withColumn("range", F.floor(F.col("score") * 1000))
    ranges = ranks.groupBy("range").agg(F.sum("n").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("range").orderBy("score")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    ranks = ranks.join(ranges, "range").withColumn(
        "below", F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    )
    won = F.try_divide(
        F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)), F.sum("p") * F.sum("n")
    )
    return ranks.agg(
        F.sum(F.col("p") + F.col("n")).alias("rows"),
        F.sum("p").alias("clicked"),
        # With one class only there is nothing to rank.
        F.coalesce(F.abs(won - auc) < 1e-9, F.lit(True)).alias("is_rank_sum"),
    )


@query
def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories by falling frequency (equal ones by name), assembled with the position."""
    rows = label_lookup(spark, sf_dir)
    index, assemble, _ = training.click_model(numeric=["position"]).getStages()
    assembled = assemble.transform(index.fit(rows).transform(rows))
    return assembled.select(
        *schemas.EVENT_KEY,
        F.col("value_prop_idx").cast("long").alias("category"),
        vector_to_array("features").cast("array<bigint>").alias("vector"),
    )


# ---------------------------------------------------------------- whole job


def _job_config(spark: SparkSession) -> PipelineConfig:
    root = scratch_dir(spark, "job")
    run = uuid.uuid4().hex
    return PipelineConfig(
        bronze_schema=f"bronze_{run}",
        silver_schema=f"silver_{run}",
        gold_schema=f"gold_{run}",
        monitoring_schema=f"monitoring_{run}",
        warehouse=f"{root}/warehouse",
        landing=f"{root}/landing",
        as_of=b.AS_OF,
        amount_scale=SCALE,
    )


def _landed_job(spark: SparkSession, sf_dir: str) -> PipelineConfig:
    """Land the messy events as files and run all layers over them."""
    cfg = _job_config(spark)
    b.land_events(b.messy(spark, sf_dir, b.VIEW), cfg.source("prints"))
    b.land_events(b.messy(spark, sf_dir, b.CLICK), cfg.source("taps"))
    b.land_payments(b.messy(spark, sf_dir, b.PURCHASE), cfg.source("pays"))
    layers.run(spark, cfg, quarantine=True)
    return cfg


@query
def layered_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _landed_job(spark, sf_dir)
    return spark.table(cfg.table("gold", cfg.feature_table)).drop("_computed_at")


@query
def layered_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _landed_job(spark, sf_dir)
    return spark.table(cfg.table("monitoring", AUDIT_TABLE)).drop(*STAMPS, "constraint")


@query
def layered_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each table set aside; a step that runs again leaves one copy per run."""
    cfg = _landed_job(spark, sf_dir)
    layers.run_conform(spark, cfg, quarantine=True)
    found = None
    for name in ("prints", "taps", "pays"):
        rows = spark.table(cfg.table("monitoring", f"{name}_quarantine"))
        rows = rows.select(F.lit(name).alias("source"), "run_id", "day", "user_id", "value_prop")
        found = rows if found is None else found.unionByName(rows)
    runs = found.groupBy("source", "day", "user_id", "value_prop").agg(
        F.count("*").alias("n"), F.count_distinct("run_id").alias("runs")
    )
    return runs.withColumn("n", F.col("n") / F.col("runs"))


@query
def layered_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.run_quality(spark, _landed_job(spark, sf_dir))


@query
def incremental_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job in four steps, the third of which brings late events, the last a backfill."""
    cfg = _job_config(spark)
    day, k = F.col("day"), F.col("k")
    late, turn = k % 10 == 3, F.lit(dt.date(2024, 1, 27))
    older = k % 10 == 7
    steps = [
        (~late & ~older & (day < turn), None),
        (~late & ~older & (day >= turn), None),
        (late, None),
        (older, "backfill"),
    ]
    for n, (some, batch) in enumerate(steps):
        step = dataclasses.replace(cfg, landing=f"{cfg.landing}/{n}") if batch else cfg
        for event_type, name in ((b.VIEW, "prints"), (b.CLICK, "taps")):
            b.land_events(b.messy(spark, sf_dir, event_type).where(some), step.source(name), mode="append")
        b.land_payments(b.messy(spark, sf_dir, b.PURCHASE).where(some), step.source("pays"), mode="append")
        checkpoints = None if batch else f"{cfg.warehouse}/_checkpoints"
        incremental.run_ingest_shared(spark, step, checkpoints, batch)
        incremental.run_incremental(spark, step)
    return spark.table(cfg.table("gold", cfg.feature_table)).drop("_computed_at")


@query
def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments after a rule was eased and the quarantine replayed, twice."""
    cfg = _landed_job(spark, sf_dir)
    eased = [
        dataclasses.replace(r, constraint="total >= -2") if r.name == "total_non_negative" else r
        for r in rules.payment_rules()
    ]
    for _ in range(2):
        replay(spark, cfg, "pays", eased)
    kept = spark.table(cfg.table("monitoring", "pays_quarantine"))
    state = F.when(F.col(layers.RESOLVED_AT).isNull(), "held").otherwise("released")
    columns = schemas.PAYMENTS.names
    silver = spark.table(cfg.table("silver", "pays")).select(*columns, F.lit("silver").alias("place"))
    return silver.unionByName(kept.select(*columns, state.alias("place")))

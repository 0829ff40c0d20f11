"""What the physical plans must and must not contain."""

import datetime as dt
import re
from contextlib import ExitStack

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from lookback import compute_features, schemas
from lookback.operators.conform import distinct_on
from lookback.operators.lookup import flag_if_present, lookup_features
from lookback.operators.pit import FORMS, Metric, pit_features
from lookback.plans.features import event_stream
from lookback.session import setting

SF_DIR = "/root/testdata/sf0.001"
QUERIES = contract.queries()
FEATURE_QUERIES = [n for n in QUERIES if n.startswith(("click_features", "pit_"))]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", [*FEATURE_QUERIES, "band_join_keyless", "label_lookup", "training_set"])
def test_no_pairwise_joins_and_no_python(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search("CartesianProduct|NestedLoop|Python|BroadcastHashJoin", plan)


def final_plan_of(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def test_features_read_the_log_once_and_drop_copies_once(spark, no_broadcast):
    plan = final_plan_of(QUERIES["click_features"](spark, SF_DIR))
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1
    (pushed,) = re.findall(r"PushedFilters: \[([^\n]*)", plan)
    assert "In(event_type" in pushed and "GreaterThanOrEqual(ts" in pushed
    assert "2024-01-03" in plan and "2024-01-24" in plan


def test_feature_scan_reads_only_needed_columns(spark, no_broadcast):
    plan = final_plan_of(QUERIES["click_features"](spark, SF_DIR))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "event_id" not in schema and schema.count(":") == 5


def test_history_is_aggregated_before_it_is_shuffled(spark, no_broadcast):
    plan = plan_of(QUERIES["click_features"](spark, SF_DIR))
    assert "partial_count" in plan
    window = plan.index("Window [")
    assert plan.index("HashAggregate", window) > window


def test_join_sides_sit_on_shuffles_so_that_skew_can_be_split(spark, no_broadcast):
    lines = plan_of(QUERIES["click_features"](spark, SF_DIR)).splitlines()
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = lines[at].index("SortMergeJoin")
    sides = [
        i for i, line in enumerate(lines[at + 1 :], at + 1)
        if re.match(r"[ :+\-*()\d]*Sort \[", line) and line.index("Sort") <= depth + 3
    ]
    assert len(sides) == 2
    assert all("Exchange hashpartitioning" in lines[i + 1] for i in sides)


@pytest.fixture
def hot(spark):
    """One entity and day with thousands of positions holds most of the impressions."""
    return spark.range(0, 60000, 1, 8).selectExpr(
        "if(id % 3 > 0 OR id % 2 = 0, date'2024-01-30', date'2024-01-29') AS day",
        "if(id % 3 > 0, 1, id + 2) AS user_id",
        "if(id % 3 > 0 OR id % 4 < 2, 'point', 'prepaid') AS value_prop",
        "CAST(id AS INT) AS position",
    )


@pytest.fixture
def small_skew(spark):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        # Thousands of rows would merge into one map task, which has nothing to split.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with ExitStack() as stack:
        for key, value in small.items():
            stack.enter_context(setting(spark, key, value))
        yield


@pytest.mark.parametrize("form", FORMS)
def test_hot_spine_day_is_split(spark, no_broadcast, small_skew, hot, form):
    pays = hot.withColumn("total", F.lit(1.0)).drop("position")
    df = compute_features(hot, hot.limit(0), pays, form=form)
    assert len(df.collect()) == 60000
    assert "SortMergeJoin(skew=true)" in plan_of(df)


def test_hot_key_of_a_flag_lookup_is_split(spark, no_broadcast, small_skew, hot):
    df = flag_if_present(hot, hot.where("user_id = 1"), ["day", "user_id", "value_prop"], "seen")
    assert sum(r.seen for r in df.collect()) == 40000
    assert "SortMergeJoin(skew=true)" in plan_of(df)


def test_hot_key_of_a_feature_lookup_is_split(spark, no_broadcast, small_skew, hot):
    key = ["day", "user_id", "value_prop"]
    features = hot.select(*key).distinct().withColumn("views_3w", F.lit(2))
    df = lookup_features(hot, features.repartition(8), key, ["views_3w"])
    assert len(df.collect()) == 60000
    assert "SortMergeJoin(skew=true)" in plan_of(df)


def test_event_types_without_a_metric_are_not_read(spark):
    prints, taps, pays = (spark.range(5).selectExpr(
        "date'2024-01-01' AS day", "id AS user_id", "'p' AS value_prop", "id % 3 AS total"
    ) for _ in range(3))
    df = pit_features(
        prints.drop("total"),
        event_stream(prints, taps, pays),
        schemas.ENTITY,
        [Metric("pays", "pay")],
    )
    assert plan_of(df).count("Range (") == 3  # spine twice, payments once


def test_distinct_prints_saves_a_shuffle(spark, no_broadcast):
    d = spark.createDataFrame([], schemas.EVENTS)
    pays = spark.createDataFrame([], schemas.PAYMENTS)
    last = dt.date(2024, 1, 30)
    counts = [
        plan_of(compute_features(d, d, pays, last_day=last, distinct_prints=x)).count("Exchange")
        for x in (False, True)
    ]
    assert counts == [5, 4]


def test_days_of_a_set_need_no_deduplication(spark):
    rows = spark.createDataFrame([], schemas.EVENTS)
    days = distinct_on(rows, schemas.EVENT_KEY).select("day").distinct()
    assert plan_of(days).count("Exchange") == 1


def test_snapshot_diff_is_an_equality_join(spark, no_broadcast):
    plan = plan_of(QUERIES["feature_snapshot_diff"](spark, SF_DIR))
    assert "FullOuter" in plan and not re.search("NestedLoop|Cartesian", plan)


def test_audit_is_one_scan(spark):
    plan = plan_of(QUERIES["dq_events"](spark, SF_DIR))
    assert plan.count("FileScan parquet") == 1


def test_latest_state_needs_no_window(spark):
    assert "Window" not in plan_of(QUERIES["dq_latest"](spark, SF_DIR))


def test_top_k_keeps_only_k_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["topk_features"](spark, SF_DIR))

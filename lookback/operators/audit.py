"""Questions to the audit log: latest state, trend, gate and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback.operators.expectations import DataQualityError

RULE_KEY = ["layer", "table_name", "expectation"]


def latest_rows(audit: DataFrame) -> DataFrame:
    """The newest audit row of each rule.

    An aggregate in place of a ranking: each task keeps one row per rule, and nothing
    is sorted. Runs with the same time are told apart by their id.
    """
    rest = [c for c in audit.columns if c not in RULE_KEY]
    newest = F.max_by(F.struct(*rest), F.struct("checked_at", "run_id"))
    return (
        audit.groupBy(*RULE_KEY)
        .agg(newest.alias("_row"))
        .select(*[F.col(c) if c in RULE_KEY else F.col(f"_row.{c}") for c in audit.columns])
    )


def dq_latest(audit: DataFrame) -> DataFrame:
    return latest_rows(audit).select(
        *RULE_KEY,
        "action",
        "total_rows",
        "failed_rows",
        F.round(F.col("failure_rate") * 100, 2).alias("failure_pct"),
        "passed",
        "checked_at",
    )


def create_latest_view(spark: SparkSession, audit_table: str, view: str) -> None:
    """``dq_latest`` as a persistent view, for dashboards and alerts that speak SQL."""
    spark.sql(f"""
        CREATE OR REPLACE VIEW {view} AS
        SELECT layer, table_name, expectation, r.action, r.total_rows, r.failed_rows,
          round(r.failure_rate * 100, 2) AS failure_pct, r.passed, r.checked_at
        FROM (
          SELECT layer, table_name, expectation,
            max_by(
              struct(action, total_rows, failed_rows, failure_rate, passed, checked_at),
              struct(checked_at, run_id)
            ) AS r
          FROM {audit_table}
          GROUP BY layer, table_name, expectation
        )
    """)


def latest_report(audit: DataFrame) -> DataFrame:
    return latest_rows(audit).orderBy(*RULE_KEY)


def dq_trend(audit: DataFrame) -> DataFrame:
    """Mean failure rate per run and table, in time order; runs of one time stay apart."""
    return (
        audit.groupBy("checked_at", "run_id", "layer", "table_name")
        .agg(F.round(F.avg("failure_rate") * 100, 3).alias("avg_failure_pct"))
        .orderBy("checked_at", "run_id", "layer", "table_name")
    )


def latest_run(audit: DataFrame) -> DataFrame:
    """Audit rows of the newest run.

    The run's id is one scalar, so it joins the filter as a scalar subquery.
    """
    newest = audit.agg(F.max_by("run_id", F.struct("checked_at", "run_id")))
    return audit.where(F.col("run_id") == newest.scalar())


#: Fixed value: what an open gate answers.
GATE_OPEN = "DQ OK"


def is_breach() -> Column:
    """An audit row of a critical rule that some row violated."""
    return (F.col("action") == "fail") & (F.col("failed_rows") > 0)


def dq_gate(audit: DataFrame) -> DataFrame:
    """One row for the newest run, or an error that lists its breached rules when evaluated."""
    name = F.concat_ws(".", "table_name", "expectation")
    names = F.sort_array(F.collect_set(F.when(is_breach(), name)))
    state = latest_run(audit).agg(names.alias("names"))
    closed = F.raise_error(F.concat(F.lit("gate closed by "), F.array_join("names", " and ")))
    return state.select(F.when(F.size("names") == 0, GATE_OPEN).otherwise(closed).alias("dq_gate"))


def breaches(latest: DataFrame) -> DataFrame:
    return latest.where(is_breach())


def require_no_breach(audit: DataFrame) -> None:
    """Raise when the latest state of any critical rule is red."""
    red = breaches(latest_rows(audit)).select("table_name", "expectation", "failed_rows").collect()
    if red:
        raise DataQualityError(
            "latest state", {f"{r['table_name']}.{r['expectation']}": r["failed_rows"] for r in red}
        )


def dq_alerts(latest: DataFrame, max_failure_pct: float = 1.0) -> DataFrame:
    """Alert conditions over ``dq_latest``: one row each, with value and threshold."""
    critical = F.count_if(is_breach())
    values = latest.agg(
        critical.cast("double").alias("critical"), F.max("failure_pct").alias("worst")
    )
    alerts = F.inline(
        F.array(
            F.struct(
                F.lit("dq_critical_failures").alias("alert"),
                F.col("critical").alias("value"),
                F.lit(0.0).alias("threshold"),
            ),
            F.struct(
                F.lit("dq_failure_rate").alias("alert"),
                F.col("worst").alias("value"),
                F.lit(float(max_failure_pct)).alias("threshold"),
            ),
        )
    )
    over = F.coalesce(F.col("value") > F.col("threshold"), F.lit(False))
    return values.select(alerts).withColumn("triggered", over)

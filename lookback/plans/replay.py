"""Quarantined rows judged anew: what passes the present rules goes back to its table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback import schemas
from lookback.config import PipelineConfig
from lookback.functions.predicates import all_satisfied
from lookback.operators.conform import distinct_on
from lookback.operators.expectations import Expectation
from lookback.operators.publish import create_table, replace_partitions, write_table
from lookback.plans.layers import RESOLVED_AT, RESOLVED_BY, Run, open_tables
from lookback.sources.files import path_exists


def _silver_schema(name: str):
    return schemas.PAYMENTS if name == "pays" else schemas.EVENTS


def newest_run(held: DataFrame) -> str | None:
    """The run that set rows aside last. It saw all that earlier ones did: their rows are
    superseded, and a row that several runs set aside must not return several times."""
    return held.agg(F.max_by("run_id", "_quarantined_at")).first()[0]


def releasable(expectations: Sequence[Expectation]) -> Column:
    """Not yet resolved, and meets all rules that block or drop."""
    strict = [r.constraint for r in expectations if r.action in ("drop", "fail")]
    return F.col(RESOLVED_AT).isNull() & all_satisfied(strict)


def replay(
    spark: SparkSession,
    cfg: PipelineConfig,
    name: str,
    expectations: Sequence[Expectation],
    run: Run | None = None,
) -> int:
    """Release the rows of ``prints``, ``taps`` or ``pays`` that pass now; returns how many.

    Released rows join their days in the conformed table (impressions and clicks as a set)
    and are marked in the quarantine with time and run. Only the newest run's quarantine
    counts. Nothing happens for rows that were released before, so running it again is
    safe, also after a failure: what the days will hold is staged first, then the rows are
    marked, then the days are replaced. A run that finds a plan whose rows are marked
    finishes it; one whose rows are not marked yet is made anew.
    """
    open_tables(spark, cfg)
    run = run or Run.new()
    silver, kept = cfg.table("silver", name), cfg.table("monitoring", f"{name}_quarantine")
    if not spark.catalog.tableExists(kept):
        return 0
    create_table(spark, silver, _silver_schema(name), ["day"])
    newest = newest_run(spark.table(kept))
    if newest is None:
        return 0
    plan = _plan_folder(cfg, name, newest)
    held = spark.table(kept).where(F.col("run_id") == F.lit(newest))
    if _marked(spark, held, plan):
        _finish(spark, silver, plan)
    passing = held.where(releasable(expectations))
    days = [r["day"] for r in passing.select("day").distinct().collect()]
    if not days:
        return 0
    columns = _silver_schema(name).names
    back = spark.table(silver).where(F.col("day").isin(days)).select(*columns)
    after = back.unionByName(passing.select(*columns))
    after = after if name == "pays" else distinct_on(after, schemas.EVENT_KEY)
    # The run's id is the plan's mark: rows that carry it were released by this plan.
    write_table(after.withColumn(RESOLVED_BY, F.lit(run.run_id)), plan)
    n = _mark(spark, held, releasable(expectations), kept, run)
    _finish(spark, silver, plan)
    return n


def _plan_folder(cfg: PipelineConfig, name: str, run_id: str) -> str:
    return f"{cfg.warehouse}/{cfg.monitoring_schema}/_replay_{name}_{run_id}"


def _marked(spark: SparkSession, held: DataFrame, plan: str) -> bool:
    """Whether a plan is there, whole, and its rows are marked already."""
    if not path_exists(spark, f"{plan}/_SUCCESS"):
        return False
    first = spark.read.parquet(plan).select(RESOLVED_BY).first()
    return first is not None and not held.where(F.col(RESOLVED_BY) == first[0]).isEmpty()


def _mark(spark: SparkSession, held: DataFrame, passes: Column, kept: str, run: Run) -> int:
    marked = held.withColumns(
        {
            RESOLVED_AT: F.when(passes, F.lit(run.checked_at)).otherwise(F.col(RESOLVED_AT)),
            RESOLVED_BY: F.when(passes, F.lit(run.run_id)).otherwise(F.col(RESOLVED_BY)),
        }
    )
    # The run's partition is replaced when the job commits, after all its rows are read.
    replace_partitions(marked, kept, ["run_id"])
    return spark.table(kept).where(F.col(RESOLVED_BY) == F.lit(run.run_id)).count()


def _finish(spark: SparkSession, silver: str, plan: str) -> None:
    replace_partitions(spark.read.parquet(plan).drop(RESOLVED_BY), silver, ["day"], schemas.ENTITY)
    at = spark._jvm.org.apache.hadoop.fs.Path(plan)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

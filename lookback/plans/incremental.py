"""The layered job for what arrived since: shared raw tables, touched days, changed features.

A late event changes the features of its own day and of the days whose window it lies in.
Ingest notes which days its batches touch; the incremental step rebuilds those days of the
conformed tables, derives the serving days they reach, and recomputes these alone. A rerun
after a failure starts from the same notes, so it ends in the same tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback import schemas
from lookback.config import AUDIT_TABLE, PipelineConfig
from lookback.operators.conform import distinct_on, flatten_events, flatten_payments
from lookback.operators.expectations import apply_expectations, quarantined
from lookback.operators.pit import serving_days
from lookback.operators.publish import (
    create_table,
    drop_partitions,
    partition_values,
    register,
    replace_partitions,
)
from lookback.plans import rules
from lookback.plans.features import compute_features
from lookback.plans.layers import INGEST, Run, _claim, _raw, open_tables, set_aside, staging
from lookback.sources.files import path_exists, read_csv, with_lineage
from lookback.sources.rescue import MALFORMED, read_rescued, stream_rescued
from lookback.streaming.ingest import stream_files
from lookback.streaming.shared import BATCH, drop_batch, load_batches, put_batch, put_stream

SOURCES = ("prints", "taps", "pays")


def _typed(name: str, raw: DataFrame) -> DataFrame:
    return flatten_payments(raw) if name == "pays" else flatten_events(raw)


def _pending(cfg: PipelineConfig, name: str) -> str:
    return f"{cfg.warehouse}/{cfg.monitoring_schema}/{name}_touched_days"


def _note_days(spark: SparkSession, cfg: PipelineConfig, name: str, batch: str, rows: DataFrame | None) -> None:
    """Add days to those a batch touches: of the rows it holds now, and of ``rows``."""
    table, folder = _raw(cfg, name)
    noted = _pending(cfg, name)
    known = []
    if path_exists(spark, f"{folder}/{BATCH}={batch}"):
        known.append(_typed(name, load_batches(spark, folder, [batch])).select("day"))
    if path_exists(spark, f"{noted}/{BATCH}={batch}"):
        known.append(load_batches(spark, noted, [batch]).select("day"))
    if rows is not None:
        known.append(_typed(name, rows).select("day"))
    if known:
        # As short as the calendar; collected, because its own folder is replaced.
        days = reduce(DataFrame.unionByName, known).distinct().collect()
        put_batch(spark.createDataFrame(days, "day date").coalesce(1), noted, batch)


def _put(spark: SparkSession, cfg: PipelineConfig, name: str, rows: DataFrame, batch: str) -> None:
    # Noted before the rows change, so that a failure between cannot lose a day.
    _note_days(spark, cfg, name, batch, rows)
    put_batch(rows, _raw(cfg, name)[1], batch)


def run_ingest_shared(
    spark: SparkSession,
    cfg: PipelineConfig,
    checkpoints: str | None = None,
    batch: str | None = None,
) -> None:
    """Add landing files to raw tables that batches and streams fill side by side.

    With ``checkpoints`` all files that earlier runs have not seen are taken; with ``batch``
    the landing files become the batch of that name, in the place of its earlier rows.
    Events keep fields that the schema does not know (``read_rescued``).
    """
    if not cfg.warehouse or (checkpoints is None) == (batch is None):
        raise ValueError("needs a warehouse folder and either checkpoints or a batch name")
    open_tables(spark, cfg)
    for name in SOURCES:
        table, folder = _raw(cfg, name)
        _claim(spark, table, "shared", folder)
        at = cfg.source(name)
        if batch:
            rows = (
                read_csv(spark, at, schemas.PAYMENT_LANDING, malformed=MALFORMED).transform(with_lineage)
                if name == "pays"
                else read_rescued(spark, at, schemas.EVENT_LANDING)
            )
            _put(spark, cfg, name, rows, batch)
        else:
            rows = (
                stream_files(spark, at, schemas.PAYMENT_LANDING, "csv", malformed=MALFORMED)
                if name == "pays"
                else stream_rescued(spark, at, schemas.EVENT_LANDING)
            )
            put_stream(rows, folder, f"{checkpoints}/{name}_raw", lambda df, b, n=name: _put(df.sparkSession, cfg, n, df, b))
        _declare(spark, table, folder, rows)


def _declare(spark: SparkSession, table: str, folder: str, rows: DataFrame) -> None:
    """Make new batches known to the catalog, and the table if it is new or still empty."""
    if not register(spark, table, folder, optional=[BATCH]):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(
            f"CREATE TABLE {table} ({columns}, {BATCH} STRING) USING parquet"
            f" PARTITIONED BY ({BATCH}) LOCATION '{folder}'"
        )
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{INGEST}' = 'shared')")


def on_days(df: DataFrame, days: Iterable[dt.date | None]) -> DataFrame:
    """Rows of some days, as literals that prune partitions; None stands for no day."""
    known = sorted(d for d in days if d is not None)
    keep = F.col("day").isin(known) if known else F.lit(False)
    return df.where(keep | F.col("day").isNull() if None in days else keep)


def touched_serving_days(
    touched: Iterable[dt.date | None], lookback: int, served: tuple[dt.date, dt.date]
) -> set[dt.date]:
    """Serving days whose features events of the ``touched`` days can change.

    An event counts on its own day (as impression or label) and in the windows of the
    ``lookback`` days after it; on no day before it.
    """
    first, last = served
    reached = (d + dt.timedelta(days=n) for d in touched if d is not None for n in range(lookback + 1))
    return {d for d in reached if first <= d <= last}


def runs_of(days: Iterable[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Days as unbroken runs, each with its first and last day."""
    runs: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        if runs and day - runs[-1][1] == dt.timedelta(days=1):
            runs[-1] = runs[-1][0], day
        else:
            runs.append((day, day))
    return runs


def _replace_days(df: DataFrame, table: str, days: Iterable[dt.date]) -> None:
    """Make ``df`` the rows of these days; a day without rows is no partition any more."""
    replace_partitions(df, table, ["day"], schemas.ENTITY)
    left = {r["day"] for r in df.select("day").distinct().collect()}
    drop_partitions(df.sparkSession, table, "day", [str(d) for d in days if d not in left and d is not None])


def _conform_days(
    spark: SparkSession, cfg: PipelineConfig, run: Run, name: str, days: set[dt.date | None], quarantine: bool
) -> None:
    """Rebuild some days of a conformed table from all batches of its raw table."""
    target = cfg.table("silver", name)
    expectations = rules.payment_rules(cfg.null_user) if name == "pays" else rules.event_rules(cfg.as_of, False, cfg.null_user)
    rows = on_days(_typed(name, spark.table(cfg.table("bronze", f"{name}_raw"))), days)
    with staging(spark, rows, target, run) as typed:
        valid = apply_expectations(
            spark, typed, expectations, "silver", name, cfg.table("monitoring", AUDIT_TABLE), run.run_id, run.checked_at
        )
        if quarantine:
            set_aside(quarantined(typed, expectations, run.checked_at), cfg.table("monitoring", f"{name}_quarantine"), run)
        if name != "pays":
            valid = distinct_on(valid, schemas.EVENT_KEY)
        with staging(spark, valid, f"{target}_valid", run) as valid:
            create_table(spark, target, schemas.PAYMENTS if name == "pays" else schemas.EVENTS, ["day"])
            _replace_days(valid, target, days)


def run_incremental(spark: SparkSession, cfg: PipelineConfig, run: Run | None = None, quarantine: bool = False) -> list[dt.date]:
    """Bring conformed tables and features up to date with what ingest added; returns the
    serving days that were recomputed.

    The result is that of a full run over all raw rows. Rules see the touched days only.
    """
    open_tables(spark, cfg)
    run = run or Run.new()
    touched: set[dt.date | None] = set()
    noted: list[tuple[str, str]] = []
    for name in SOURCES:
        folder = _pending(cfg, name)
        rows = load_batches(spark, folder).distinct().collect() if path_exists(spark, folder) and _any(spark, folder) else []
        days = {r["day"] for r in rows}
        noted += [(folder, b) for b in {r[BATCH] for r in rows}]
        if days:
            _conform_days(spark, cfg, run, name, days, quarantine)
        else:
            create_table(spark, cfg.table("silver", name), schemas.PAYMENTS if name == "pays" else schemas.EVENTS, ["day"])
        touched |= days
    fresh = _refresh_features(spark, cfg, run, touched)
    for folder, batch in noted:
        drop_batch(spark, folder, batch)
    return fresh


def _any(spark: SparkSession, folder: str) -> bool:
    """Whether a folder of batches holds any."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{BATCH}=*")
    return bool(len(at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)))


def _refresh_features(spark: SparkSession, cfg: PipelineConfig, run: Run, touched: set[dt.date | None]) -> list[dt.date]:
    target = cfg.table("gold", cfg.feature_table)
    create_table(spark, target, schemas.FEATURES, ["day"])
    held = {dt.date.fromisoformat(d) for d in partition_values(spark, target) if d}
    seen = {dt.date.fromisoformat(d) for d in partition_values(spark, cfg.table("silver", "prints")) if d}
    served = serving_days(max(seen, default=dt.date(1970, 1, 1)), cfg.serving_window_days)
    # A day without impressions has no features.
    every = {d for d in seen if d >= served[0]}
    todo = touched_serving_days(touched, cfg.feature_window_days, served) & every | (every - held)
    if todo:
        features = reduce(DataFrame.unionByName, (features_of_days(spark, cfg, a, b) for a, b in runs_of(todo)))
        with staging(spark, features, target, run) as rows:
            valid = apply_expectations(
                spark, rows, rules.feature_rules(), "gold", cfg.feature_table,
                cfg.table("monitoring", AUDIT_TABLE), run.run_id, run.checked_at, primary_key=schemas.EVENT_KEY,
            )
            _replace_days(valid, target, todo)
    drop_partitions(spark, target, "day", [str(d) for d in held - every])
    return sorted(todo)


def features_of_days(spark: SparkSession, cfg: PipelineConfig, first: dt.date, last: dt.date) -> DataFrame:
    """Features of the impressions of an unbroken run of days; reads no day before its windows."""
    return compute_features(
        *(spark.table(cfg.table("silver", name)) for name in SOURCES),
        cfg.feature_window_days,
        (last - first).days + 1,
        last_day=last,
        amount_scale=cfg.amount_scale,
        distinct_prints=True,
    )

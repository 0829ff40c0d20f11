"""The layered job: landing files -> raw -> conformed -> features, with gates.

Every layer ends in tables, which cut the lineage between layers.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback import schemas
from lookback.config import AUDIT_TABLE, PipelineConfig
from lookback.operators.audit import (
    create_latest_view,
    dq_alerts,
    dq_latest,
    dq_trend,
    latest_rows,
)
from lookback.operators.conform import distinct_on, flatten_events, flatten_payments
from lookback.operators.expectations import (
    Expectation,
    apply_expectations,
    quarantined,
    report,
)
from lookback.operators.publish import (
    analyze,
    create_table,
    empty_like,
    register,
    replace_partitions,
    replace_table,
    staged,
    write_table,
)
from lookback.operators.training import (
    area_under_roc,
    click_model,
    hash_split,
    score_batch,
    training_set,
)
from lookback.plans import rules
from lookback.plans.features import compute_features
from lookback.sources.files import path_exists, read_csv, read_jsonl, with_lineage
from lookback.sources.rescue import MALFORMED
from lookback.streaming.ingest import ingest_new_files, stream_files
from lookback.streaming.shared import BATCH


@dataclass(frozen=True)
class Run:
    """Identity of one run: all its audit rows carry the same id and time."""

    run_id: str
    checked_at: dt.datetime

    @staticmethod
    def new() -> Run:
        return Run(str(uuid.uuid4()), dt.datetime.now(dt.timezone.utc))


def create_schemas(spark: SparkSession, cfg: PipelineConfig) -> None:
    for schema in (
        cfg.bronze_schema,
        cfg.silver_schema,
        cfg.gold_schema,
        cfg.monitoring_schema,
    ):
        name = f"{cfg.catalog}.{schema}" if cfg.catalog else schema
        at = f" LOCATION '{cfg.warehouse}/{schema}'" if cfg.warehouse else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{at}")


#: Tables of a job by layer field, with their partition column.
TABLES = (
    *(("bronze", f"{t}_raw", ()) for t in ("prints", "taps", "pays")),
    *(("silver", t, ("day",)) for t in ("prints", "taps", "pays")),
    *(("monitoring", f"{t}_quarantine", ("run_id",)) for t in ("prints", "taps", "pays")),
    ("monitoring", AUDIT_TABLE, ()),
)

#: Columns of the quarantine that say when a row was released, and by which replay.
RESOLVED_AT, RESOLVED_BY = "_resolved_at", "_resolved_by"

#: Table property that says how a raw table is filled.
INGEST = "lookback.ingest"


def open_tables(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Create the schemas and make tables that earlier steps left in the warehouse known.

    A step may run in a process of its own, whose catalog may know nothing yet.
    """
    create_schemas(spark, cfg)
    if cfg.warehouse:
        for layer, name, parts in (*TABLES, ("gold", cfg.feature_table, ("day",))):
            folder = f"{cfg.warehouse}/{getattr(cfg, layer + '_schema')}/{name}"
            register(spark, cfg.table(layer, name), folder, parts, optional=[BATCH])


def _claim(spark: SparkSession, table: str, mode: str, folder: str | None) -> None:
    """Refuse to fill a raw table in another way than before.

    A stream keeps a log of its files in the table's folder. Batch writes would be
    invisible beside it, or destroy it.
    """
    if not spark.catalog.tableExists(table):
        return
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    held = kept.get(INGEST)
    if not held and BATCH in spark.table(table).columns:
        held = "shared"
    if not held:
        held = "stream" if folder and path_exists(spark, f"{folder}/_spark_metadata") else "batch"
    if held != mode:
        raise ValueError(f"{table} is filled by {held} ingest; it cannot be filled by {mode} as well")


def _raw(cfg: PipelineConfig, name: str) -> tuple[str, str | None]:
    folder = f"{cfg.warehouse}/{cfg.bronze_schema}/{name}_raw" if cfg.warehouse else None
    return cfg.table("bronze", f"{name}_raw"), folder


def read_landing(spark: SparkSession, cfg: PipelineConfig, name: str) -> DataFrame:
    """Landing files of one source as they are, with lineage. ``_malformed`` keeps the text
    of broken lines, so that there is something to look at when a rule stops the run."""
    if name == "pays":
        rows = read_csv(spark, cfg.source(name), schemas.PAYMENT_LANDING, malformed=MALFORMED)
    else:
        rows = read_jsonl(spark, cfg.source(name), schemas.EVENT_LANDING, MALFORMED)
    return rows.transform(with_lineage)


def run_ingest(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Load the landing files as they are, replacing the raw tables.

    Overwriting takes a raw table away first; after a failed write the step runs again
    from the landing files.
    """
    open_tables(spark, cfg)
    for name in ("prints", "taps", "pays"):
        table, folder = _raw(cfg, name)
        _claim(spark, table, "batch", folder)
        write_table(read_landing(spark, cfg, name), table)
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{INGEST}' = 'batch')")


def run_ingest_stream(spark: SparkSession, cfg: PipelineConfig, checkpoints: str) -> None:
    """Append the landing files that earlier runs have not seen. Each source path is a
    folder here; ``checkpoints`` lies on shared storage and stays between runs."""
    open_tables(spark, cfg)
    for name in ("prints", "taps", "pays"):
        table, folder = _raw(cfg, name)
        _claim(spark, table, "stream", folder)
        schema, fmt = (
            (schemas.PAYMENT_LANDING, "csv") if name == "pays" else (schemas.EVENT_LANDING, "json")
        )
        stream = stream_files(spark, cfg.source(name), schema, fmt, malformed=MALFORMED)
        ingest_new_files(stream, table, f"{checkpoints}/{name}_raw")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{INGEST}' = 'stream')")


@contextmanager
def staging(spark: SparkSession, df: DataFrame, table: str, run: Run) -> Iterator[DataFrame]:
    """``df`` in a table of the run's own for the length of a block."""
    name = f"{table}_staging_{run.run_id.replace('-', '')}"
    try:
        yield staged(df, name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def set_aside(rejected: DataFrame, table: str, run: Run) -> None:
    """Put a run's rejected rows into ``table``, in the place of any it put there before.

    Each has room for when, and by which replay, it was released.
    """
    rows = rejected.withColumns(
        {
            RESOLVED_AT: F.lit(None).cast("timestamp"),
            RESOLVED_BY: F.lit(None).cast("string"),
            "run_id": F.lit(run.run_id),
        }
    )
    create_table(rows.sparkSession, table, empty_like(rows).schema, ["run_id"])
    # Few rows out of many tasks: merged, or each task would leave a tiny file.
    replace_partitions(rows, table, ["run_id"])


def _conform(
    spark: SparkSession,
    cfg: PipelineConfig,
    run: Run,
    table: str,
    flatten: Callable[[DataFrame], DataFrame],
    expectations: Sequence[Expectation],
    key: Sequence[str] | None,
    quarantine: bool,
) -> None:
    """One read of the raw table: rules, quarantine and silver all read the typed rows."""
    typed = flatten(spark.table(cfg.table("bronze", f"{table}_raw")))
    with staging(spark, typed, cfg.table("silver", table), run) as rows:
        valid = apply_expectations(
            spark,
            rows,
            expectations,
            "silver",
            table,
            cfg.table("monitoring", AUDIT_TABLE),
            run.run_id,
            run.checked_at,
        )
        if quarantine:
            rejected = quarantined(rows, expectations, run.checked_at)
            set_aside(rejected, cfg.table("monitoring", f"{table}_quarantine"), run)
        if not key:
            replace_table(valid, cfg.table("silver", table), "day", schemas.ENTITY)
            return
        # Written once: the list of days, the range sample and the write read files then,
        # and the shuffle that drops copies runs once.
        with staging(spark, distinct_on(valid, key), f"{cfg.table('silver', table)}_set", run) as valid:
            replace_table(valid, cfg.table("silver", table), "day", schemas.ENTITY)


def run_conform(
    spark: SparkSession,
    cfg: PipelineConfig,
    run: Run | None = None,
    strict: bool = False,
    quarantine: bool = False,
) -> None:
    """Type, check, deduplicate and publish the three event tables by day.

    The rules see the rows before deduplication. Payments stay a bag.
    """
    open_tables(spark, cfg)
    run = run or Run.new()
    events = rules.event_rules(cfg.as_of, strict, cfg.null_user)
    for table in ("prints", "taps"):
        _conform(
            spark, cfg, run, table, flatten_events, events, schemas.EVENT_KEY, quarantine
        )
    pays = rules.payment_rules(cfg.null_user)
    _conform(spark, cfg, run, "pays", flatten_payments, pays, None, quarantine)


def build_features(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    return compute_features(
        spark.table(cfg.table("silver", "prints")),
        spark.table(cfg.table("silver", "taps")),
        spark.table(cfg.table("silver", "pays")),
        cfg.feature_window_days,
        cfg.serving_window_days,
        amount_scale=cfg.amount_scale,
        distinct_prints=True,
    )


def run_features(
    spark: SparkSession,
    cfg: PipelineConfig,
    run: Run | None = None,
    keep_older_days: bool = False,
) -> None:
    """Compute, check and publish the feature table.

    The features are written once to a staging table. The rules and the range sample of
    the clustered write then read that table, and nothing is published when a rule
    fails. ``keep_older_days`` replaces only the days computed now.
    """
    open_tables(spark, cfg)
    run = run or Run.new()
    target = cfg.table("gold", cfg.feature_table)
    with staging(spark, build_features(spark, cfg), target, run) as features:
        valid = apply_expectations(
            spark,
            features,
            rules.feature_rules(),
            "gold",
            cfg.feature_table,
            cfg.table("monitoring", AUDIT_TABLE),
            run.run_id,
            run.checked_at,
            primary_key=schemas.EVENT_KEY,
        )
        if keep_older_days:
            create_table(spark, target, schemas.FEATURES, ["day"])
            replace_partitions(valid, target, ["day"], schemas.ENTITY)
        else:
            replace_table(valid, target, "day", schemas.ENTITY, schemas.FEATURES)


def run_maintenance(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Column statistics for the optimizer, and the monitoring view."""
    open_tables(spark, cfg)
    for table in (cfg.table("silver", "prints"), cfg.table("silver", "taps"), cfg.table("silver", "pays"), cfg.table("gold", cfg.feature_table)):
        analyze(spark, table)
    create_latest_view(spark, cfg.table("monitoring", AUDIT_TABLE), cfg.table("monitoring", "dq_latest"))


def run(
    spark: SparkSession,
    cfg: PipelineConfig,
    strict: bool = False,
    quarantine: bool = False,
    checkpoints: str | None = None,
) -> Run:
    """Ingest, conform, compute features, publish; returns the run's identity.

    With ``checkpoints`` the ingest is incremental and takes only new landing files.
    """
    this = Run.new()
    if checkpoints:
        run_ingest_stream(spark, cfg, checkpoints)
    else:
        run_ingest(spark, cfg)
    run_conform(spark, cfg, this, strict, quarantine)
    run_features(spark, cfg, this)
    return this


def run_quality(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Write the whole report, trend and alerts of the audit log; returns the alerts.

    Tables ``dq_report``, ``dq_trend`` and ``dq_alerts`` beside the log.
    """
    open_tables(spark, cfg)
    log = spark.table(cfg.table("monitoring", AUDIT_TABLE))
    alerts = cfg.table("monitoring", "dq_alerts")
    write_table(report(latest_rows(log)), cfg.table("monitoring", "dq_report"))
    write_table(dq_trend(log), cfg.table("monitoring", "dq_trend"))
    write_table(dq_alerts(dq_latest(log)), alerts)
    return spark.table(alerts)


def model_folder(cfg: PipelineConfig) -> str:
    return f"{cfg.warehouse or 'models'}/_models/{cfg.feature_table}"


def run_train(spark: SparkSession, cfg: PipelineConfig) -> float | None:
    """Fit the click model on all training rows of the feature table and save it.

    Returns the area under the curve on the held-out rows; None if they are of one class
    or the training rows are, and then no model is saved.
    """
    open_tables(spark, cfg)
    features = spark.table(cfg.table("gold", cfg.feature_table))
    spine = features.select(*schemas.EVENT_KEY, "clicked")
    train, test = hash_split(training_set(spine, features), schemas.EVENT_KEY)
    if train.select("clicked").distinct().count() < 2:
        return None
    model = click_model().fit(train)
    model.write().overwrite().save(model_folder(cfg))
    if test.select("clicked").distinct().count() < 2:
        return None
    return area_under_roc(model.transform(test))


def run_score(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Score all keys of the feature table into ``click_scores``, if there is a model."""
    open_tables(spark, cfg)
    if not path_exists(spark, model_folder(cfg)):
        return
    model = PipelineModel.load(model_folder(cfg))
    features = spark.table(cfg.table("gold", cfg.feature_table))
    scored = score_batch(model, features.select(*schemas.EVENT_KEY), features)
    replace_table(scored, cfg.table("gold", "click_scores"), "day", schemas.ENTITY)

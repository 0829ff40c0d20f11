"""Job entry: ``python -m lookback <step> --set landing=... --set warehouse=...``."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lookback import schemas
from lookback.config import AUDIT_TABLE, PipelineConfig
from lookback.operators.audit import require_no_breach
from lookback.plans import layers
from lookback.plans.incremental import run_incremental, run_ingest_shared
from lookback.session import build_session

STEPS = ("ingest", "conform", "features", "train", "score", "quality", "maintenance", "all")
#: A step of its own: shared ingest, then what the new rows change.
INCREMENTAL = "incremental"
INTEGERS = ("feature_window_days", "serving_window_days", "amount_scale")


def setting_value(text: str) -> tuple[str, object]:
    name, _, value = text.partition("=")
    if name in INTEGERS and value:
        return name, int(value)
    if name == "as_of" and value:
        return name, dt.date.fromisoformat(value)
    return name, value


def report_quality(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Write report, trend and alerts, preview them, and raise when a critical rule is red."""
    alerts = layers.run_quality(spark, cfg)
    print("alerts:", [r["alert"] for r in alerts.where("triggered").collect()])
    print("report (first rows; all in the monitoring schema):")
    spark.table(cfg.table("monitoring", "dq_report")).show(truncate=False)
    require_no_breach(spark.table(cfg.table("monitoring", AUDIT_TABLE)))


def report_features(spark: SparkSession, cfg: PipelineConfig) -> None:
    features = spark.table(cfg.table("gold", cfg.feature_table))
    print("rows:", features.count())
    features.orderBy(F.desc("views_3w"), *schemas.EVENT_KEY).limit(10).show(truncate=False)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lookback", description=__doc__)
    parser.add_argument("step", choices=[*STEPS, INCREMENTAL])
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--strict", action="store_true")
    parser.add_argument("--quarantine", action="store_true")
    parser.add_argument("--keep-older-days", action="store_true")
    parser.add_argument("--checkpoints", help="ingest only new files; shared folder")
    parser.add_argument("--batch", help="name of the batch that the landing files are (step incremental)")
    args = parser.parse_args(argv)
    cfg = PipelineConfig().with_overrides(dict(map(setting_value, args.set)))
    spark = build_session()
    this = layers.Run.new()
    if args.step == INCREMENTAL:
        run_ingest_shared(spark, cfg, None if args.batch else args.checkpoints, args.batch)
        print("recomputed:", [str(d) for d in run_incremental(spark, cfg, this, args.quarantine)])
        return
    todo = STEPS[:-1] if args.step == "all" else (args.step,)
    if "ingest" in todo:
        if args.checkpoints:
            layers.run_ingest_stream(spark, cfg, args.checkpoints)
        else:
            layers.run_ingest(spark, cfg)
    if "conform" in todo:
        layers.run_conform(spark, cfg, this, args.strict, args.quarantine)
    if "features" in todo:
        layers.run_features(spark, cfg, this, args.keep_older_days)
        report_features(spark, cfg)
    if "train" in todo:
        print("held-out AUC:", layers.run_train(spark, cfg))
    if "score" in todo:
        layers.run_score(spark, cfg)
    if "maintenance" in todo:
        layers.run_maintenance(spark, cfg)
    if "quality" in todo:
        report_quality(spark, cfg)


if __name__ == "__main__":
    main()

"""The whole job over landing files: publish, gate, audit, incremental ingest."""

import datetime as dt
import json
import os
import shutil
import time

import pytest

from lookback.__main__ import main
from lookback import DataQualityError, PipelineConfig, run, schemas
from lookback.config import AUDIT_TABLE
from lookback.operators.audit import dq_latest
from lookback.operators.publish import replace_table
from lookback.plans import rules
from lookback.plans.layers import (
    TABLES,
    Run,
    run_conform,
    run_features,
    run_ingest,
    run_ingest_stream,
    run_maintenance,
)

D = dt.date(2020, 11, 30)


def land(cfg, prints, taps, pays, part="a"):
    for path, rows in ((cfg.source("prints"), prints), (cfg.source("taps"), taps)):
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{part}.json", "w") as f:
            for day, user, prop, pos in rows:
                event = {"position": pos, "value_prop": prop}
                f.write(json.dumps({"day": str(day), "event_data": event, "user_id": user}) + "\n")
    os.makedirs(cfg.source("pays"), exist_ok=True)
    with open(f"{cfg.source("pays")}/{part}.csv", "w") as f:
        f.write("pay_date,total,user_id,value_prop\n")
        for day, user, prop, total in pays:
            f.write(f"{day},{total},{user},{prop}\n")


def before(n):
    return D - dt.timedelta(days=n)


PRINTS = [(D, 1, "point", 0), (D, 1, "point", 0), (before(2), 1, "point", 0), (D, 2, None, 0)]
TAPS = [(D, 1, "point", 3)]
PAYS = [(before(2), 1, "point", 10.0), (before(2), 1, "point", 10.0), (before(2), 1, "point", -1.0)]


@pytest.fixture
def cfg(folder, request):
    tag = request.node.name.replace("[", "_").replace("]", "")[:60]
    return PipelineConfig(
        bronze_schema=f"b_{tag}",
        silver_schema=f"s_{tag}",
        gold_schema=f"g_{tag}",
        monitoring_schema=f"m_{tag}",
        warehouse=f"{folder}/warehouse",
        landing=f"{folder}/landing",
    )


def feature_rows(spark, cfg):
    return {
        (r.day, r.user_id): (r.clicked, r.views_3w, r.pays_3w, r.amount_3w)
        for r in spark.table(cfg.table("gold", cfg.feature_table)).collect()
    }


def test_files_to_features(spark, cfg):
    land(cfg, PRINTS, TAPS, PAYS)
    this = run(spark, cfg, quarantine=True)
    assert feature_rows(spark, cfg) == {
        (D, 1): (1, 1, 2, 20.0),
        (before(2), 1): (0, 0, 0, 0.0),
    }
    assert spark.table(cfg.table("silver", "prints")).count() == 2
    assert spark.table(cfg.table("monitoring", "pays_quarantine")).first().total == -1.0
    assert spark.table(cfg.table("monitoring", "prints_quarantine")).first().user_id == 2

    audit = spark.table(cfg.table("monitoring", AUDIT_TABLE))
    assert audit.schema.names == schemas.AUDIT.names
    rows = audit.collect()
    assert {r.run_id for r in rows} == {this.run_id} and len({r.checked_at for r in rows}) == 1
    failed = {(r.table_name, r.expectation): r.failed_rows for r in rows if not r.passed}
    assert failed == {
        ("prints", "value_prop_not_null"): 1,
        ("prints", "value_prop_known"): 1,
        ("pays", "total_non_negative"): 1,
    }
    gold = {t.name for t in spark.catalog.listTables(cfg.gold_schema)}
    assert gold == {cfg.feature_table}

    run_maintenance(spark, cfg)
    view = spark.table(cfg.table("monitoring", "dq_latest"))
    assert sorted(view.collect()) == sorted(dq_latest(audit).collect())
    assert view.count() == len(rows)


def test_rerun_gives_the_same_tables(spark, cfg):
    land(cfg, PRINTS, TAPS, PAYS)
    run(spark, cfg)
    first = feature_rows(spark, cfg)
    run(spark, cfg)
    assert feature_rows(spark, cfg) == first
    assert spark.table(cfg.table("silver", "pays")).count() == 2
    assert spark.table(cfg.table("monitoring", AUDIT_TABLE)).select("run_id").distinct().count() == 2


def test_broken_date_stops_before_publishing(spark, cfg):
    land(cfg, [("someday", 1, "point", 0)], TAPS, PAYS)
    run_ingest(spark, cfg)
    with pytest.raises(DataQualityError, match="day_not_null on 1 rows"):
        run_conform(spark, cfg)
    assert not spark.catalog.tableExists(cfg.table("silver", "prints"))
    assert spark.table(cfg.table("monitoring", AUDIT_TABLE)).where("NOT passed").count() > 0


def test_failed_gate_leaves_the_published_features(spark, cfg, monkeypatch):
    land(cfg, PRINTS, TAPS, PAYS)
    run(spark, cfg)
    first = feature_rows(spark, cfg)
    from lookback import Expectation
    from lookback.plans import rules

    monkeypatch.setattr(rules, "feature_rules", lambda: [Expectation("none", "false", "fail")])
    with pytest.raises(DataQualityError):
        run_features(spark, cfg, Run.new())
    assert feature_rows(spark, cfg) == first


def test_strict_rules_drop_what_the_others_report(spark, cfg):
    land(cfg, [*PRINTS, (D, 5, "point", 99), (D, 6, "other", 0)], TAPS, PAYS)
    run(spark, cfg)
    assert {(D, 5), (D, 6)} <= set(feature_rows(spark, cfg))
    run(spark, cfg, strict=True)
    assert set(feature_rows(spark, cfg)) == {(D, 1), (before(2), 1)}


def test_incremental_ingest_adds_only_new_files(spark, cfg, folder):
    land(cfg, PRINTS, TAPS, PAYS)
    checkpoints = f"{folder}/checkpoints"
    run(spark, cfg, checkpoints=checkpoints)
    assert spark.table(cfg.table("bronze", "prints_raw")).count() == 4
    land(cfg, [(D, 3, "point", 0)], [], [], part="b")
    run(spark, cfg, checkpoints=checkpoints)
    assert spark.table(cfg.table("bronze", "prints_raw")).count() == 5
    assert set(feature_rows(spark, cfg)) == {(D, 1), (before(2), 1), (D, 3)}
    with pytest.raises(ValueError, match="stream ingest"):
        run_ingest(spark, cfg)
    assert spark.table(cfg.table("bronze", "prints_raw")).count() == 5


def test_batch_tables_refuse_a_stream(spark, cfg, folder):
    land(cfg, PRINTS, TAPS, PAYS)
    run_ingest(spark, cfg)
    with pytest.raises(ValueError, match="batch ingest"):
        run_ingest_stream(spark, cfg, f"{folder}/checkpoints")


def test_late_files_are_taken(spark, cfg, folder):
    checkpoints = f"{folder}/checkpoints"
    land(cfg, [(D, 1, "point", 0)], TAPS, PAYS)
    run_ingest_stream(spark, cfg, checkpoints)
    land(cfg, [(D, 2, "point", 0)], [], [(D, 2, "point", 1.0)], part="late")
    for name, end in (("prints", "json"), ("pays", "csv")):
        old = time.time() - 10 * 86_400
        os.utime(f"{cfg.source(name)}/late.{end}", (old, old))
    run_ingest_stream(spark, cfg, checkpoints)
    land(cfg, [(D, 3, "point", 0)], [], [], part="c")
    run_ingest_stream(spark, cfg, checkpoints)
    assert spark.table(cfg.table("bronze", "prints_raw")).count() == 3
    assert spark.table(cfg.table("bronze", "pays_raw")).count() == 4


def test_quarantine_keeps_one_copy_per_run(spark, cfg):
    land(cfg, PRINTS, TAPS, PAYS)
    run_ingest(spark, cfg)
    first = Run.new()
    for this in (first, first, Run.new()):
        run_conform(spark, cfg, this, quarantine=True)
    rows = spark.table(cfg.table("monitoring", "pays_quarantine"))
    assert sorted(r["count"] for r in rows.groupBy("run_id").count().collect()) == [1, 1]


def test_tables_of_another_process_are_found(spark, cfg):
    land(cfg, PRINTS, TAPS, PAYS)
    run(spark, cfg, quarantine=True)
    first = feature_rows(spark, cfg)
    # What a new process starts from: the files are there, the catalog knows nothing.
    forgotten = [
        *((layer, name) for layer, name, _ in TABLES),
        ("gold", cfg.feature_table),
    ]
    folders = f"{cfg.warehouse}-kept"
    shutil.copytree(cfg.warehouse, folders)
    for layer, name in forgotten:
        spark.sql(f"DROP TABLE IF EXISTS {cfg.table(layer, name)}")
    shutil.copytree(folders, cfg.warehouse, dirs_exist_ok=True)
    run_conform(spark, cfg)
    run_features(spark, cfg)
    assert feature_rows(spark, cfg) == first
    assert spark.table(cfg.table("monitoring", AUDIT_TABLE)).select("run_id").distinct().count() == 3


def test_violated_constraints_publish_nothing(spark, cfg):
    land(cfg, PRINTS, TAPS, PAYS)
    run(spark, cfg)
    first = feature_rows(spark, cfg)
    target = cfg.table("gold", cfg.feature_table)
    rows = spark.table(target)
    twice = spark.createDataFrame(rows.unionByName(rows).collect(), rows.schema)
    with pytest.raises(DataQualityError, match="pk_unique"):
        replace_table(twice, target, "day", constraints=rules.FEATURE_CONSTRAINTS)
    assert feature_rows(spark, cfg) == first


def test_older_days_can_stay(spark, cfg):
    land(cfg, PRINTS, TAPS, PAYS)
    run_ingest(spark, cfg)
    run_conform(spark, cfg)
    for _ in range(2):
        run_features(spark, cfg, keep_older_days=True)
    land(cfg, [(D + dt.timedelta(days=8), 1, "point", 0)], [], [], part="b")
    run_ingest(spark, cfg)
    run_conform(spark, cfg)
    run_features(spark, cfg, keep_older_days=True)
    assert {d for d, _ in feature_rows(spark, cfg)} == {before(2), D, D + dt.timedelta(days=8)}


def test_settings(cfg):
    assert cfg.with_overrides({"landing": "/x", "catalog": ""}).source("prints") == "/x/prints.json"
    assert PipelineConfig(catalog="c").table("bronze", "t") == "c.bronze.t"
    assert PipelineConfig().table("monitoring", AUDIT_TABLE) == "monitoring.dq_results"
    with pytest.raises(ValueError):
        cfg.with_overrides({"landings": "/x"})
    with pytest.raises(ValueError):
        PipelineConfig(serving_window_days=0)


def test_command_line_runs_all_steps(spark, cfg, capsys):
    land(cfg, PRINTS, TAPS, PAYS)
    names = ("bronze_schema", "silver_schema", "gold_schema", "monitoring_schema")
    options = [f"--set={n}={getattr(cfg, n)}" for n in (*names, "warehouse", "landing")]
    main(["all", "--set=as_of=2020-12-01", "--set=amount_scale=2", "--quarantine", *options])
    assert "rows: 2" in capsys.readouterr().out
    assert feature_rows(spark, cfg)[(D, 1)] == (1, 1, 2, 20.0)
    assert spark.table(cfg.table("monitoring", "dq_latest")).where("expectation = 'day_not_future'").count() == 2
    with pytest.raises(SystemExit):
        main(["deploy"])

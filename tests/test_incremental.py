"""Shared raw tables, incremental features, quarantine replay."""

import dataclasses
import datetime as dt
import random

import pytest

from lookback import PipelineConfig, schemas
from lookback.operators.expectations import Expectation
from lookback.plans import incremental, layers, replay, rules
from lookback.plans.incremental import (
    features_of_days,
    run_incremental,
    run_ingest_shared,
    runs_of,
    touched_serving_days,
)
from lookback.plans.layers import Run, run_conform, run_features, run_ingest, run_ingest_stream
from lookback.sources.rescue import read_rescued
from lookback.streaming.shared import drop_batch, load_batches, put_batch, put_stream
from test_layers import D, before, land


@pytest.fixture
def cfg(folder, request):
    tag = request.node.name.replace("[", "_").replace("]", "")[:60]
    return PipelineConfig(
        bronze_schema=f"b_{tag}", silver_schema=f"s_{tag}", gold_schema=f"g_{tag}", monitoring_schema=f"m_{tag}",
        warehouse=f"{folder}/warehouse", landing=f"{folder}/landing", amount_scale=2,
    )


def day(n):
    return D - dt.timedelta(days=n)


def test_touched_days_are_those_whose_window_or_spine_holds_the_event():
    served = day(6), D
    assert touched_serving_days({D}, 21, served) == {D}
    assert touched_serving_days({day(27)}, 21, served) == {day(6)}
    assert touched_serving_days({day(28), None}, 21, served) == set()
    assert touched_serving_days({day(3)}, 2, served) == {day(3), day(2), day(1)}
    assert touched_serving_days({D + dt.timedelta(days=1)}, 21, served) == set()
    assert runs_of({D, day(1), day(4), day(3), day(6)}) == [(day(6), day(6)), (day(4), day(3)), (day(1), D)]
    assert runs_of([]) == []


def test_a_batch_replaces_itself_only(spark, folder):
    at = f"{folder}/raw"
    one, two = spark.range(3).toDF("id"), spark.range(10, 14).toDF("id")
    put_batch(one, at, "a")
    put_batch(two, at, "b")
    put_batch(two.limit(1), at, "a")
    ids = lambda *names: sorted(r.id for r in load_batches(spark, at, list(names) or None).collect())
    assert ids() == [10, 10, 11, 12, 13] and ids("a") == [10]
    put_batch(two.withColumn("more", two.id * 2), at, "c")
    assert load_batches(spark, at).where("more IS NULL").count() == 5
    put_batch(one.limit(0), at, "b")
    assert ids("b") == [] and ids("a", "b") == [10]
    drop_batch(spark, at, "a")
    drop_batch(spark, at, "a")
    assert ids("a") == []
    for bad in ("", "1", "2024-01-01", "a/b", "a=b", "ä"):
        with pytest.raises(ValueError, match="cannot name a batch"):
            put_batch(one, at, bad)


def test_a_repeated_micro_batch_changes_nothing(spark, folder):
    """A failure between the write and the commit: the same batch comes again."""
    at = f"{folder}/raw"
    spark.range(5).selectExpr("CAST(id AS STRING) AS value").write.text(f"{folder}/in")
    calls = []

    def put(rows, name):
        put_batch(rows, at, name)
        calls.append(name)
        if len(calls) == 1:
            raise RuntimeError("lost here")

    stream = lambda: spark.readStream.text(f"{folder}/in")
    with pytest.raises(Exception, match="lost here"):
        put_stream(stream(), at, f"{folder}/checkpoint", put)
    put_stream(stream(), at, f"{folder}/checkpoint", put)
    assert len(calls) == 2 and calls[0] == calls[1]
    assert load_batches(spark, at).count() == 5
    # Another stream over the same files has batches of its own.
    put_stream(stream(), at, f"{folder}/other")
    assert load_batches(spark, at).count() == 10


def event_rows(rng, n, days):
    def one():
        return (day(rng.choice(days)), rng.randrange(4), rng.choice(["point", "prepaid"]), rng.randrange(3))

    prints, taps = [one() for _ in range(n)], [one() for _ in range(n // 3)]
    return prints, taps, [(d, u, p, rng.randrange(1, 999) / 100) for d, u, p, _ in (one() for _ in range(n // 2))]


def features(spark, cfg):
    rows = spark.table(cfg.table("gold", cfg.feature_table)).select(*schemas.FEATURES.names[:-1]).collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("seed", [1])
def test_incremental_equals_a_full_run(spark, cfg, seed):
    rng = random.Random(seed)
    full = dataclasses.replace(
        cfg, **{f"{x}_schema": f"{getattr(cfg, x + '_schema')}_f" for x in ("bronze", "silver", "gold", "monitoring")}
    )
    steps = [
        event_rows(rng, 40, range(5, 35)),
        event_rows(rng, 12, [2, 3, rng.randrange(5, 40)]),
        ([], [], [(day(12), 1, "point", 3.5)]),
    ]
    for n, rows in enumerate(steps):
        land(cfg, *rows, part=f"p{n}")
        run_ingest_shared(spark, cfg, checkpoints=f"{cfg.warehouse}/_ck")
        run_incremental(spark, cfg)
        run_ingest(spark, full)
        run_conform(spark, full)
        run_features(spark, full)
        assert features(spark, cfg) == features(spark, full)
    assert run_incremental(spark, cfg) == []


def test_backfill_that_shrinks_and_modes_that_refuse_each_other(spark, cfg):
    land(cfg, [(D, 1, "point", 0), (before(2), 1, "point", 0)], [], [(before(3), 1, "point", 5.0)])
    run_ingest_shared(spark, cfg, batch="backfill")
    assert run_incremental(spark, cfg) == [before(2), D]
    assert [r[7] for r in features(spark, cfg) if r[0] == D] == [1]
    # The payment is taken back: its day and those it reached are computed anew.
    land(cfg, [(D, 1, "point", 0), (before(2), 1, "point", 0)], [], [])
    run_ingest_shared(spark, cfg, batch="backfill")
    assert set(run_incremental(spark, cfg)) >= {D, before(2)}
    assert [r[7] for r in features(spark, cfg) if r[0] == D] == [0]
    with pytest.raises(ValueError, match="shared ingest"):
        run_ingest(spark, cfg)
    with pytest.raises(ValueError, match="shared ingest"):
        run_ingest_stream(spark, cfg, f"{cfg.warehouse}/_other")
    with pytest.raises(ValueError, match="either"):
        run_ingest_shared(spark, cfg)


def test_days_noted_before_a_failure_are_not_lost(spark, cfg, monkeypatch):
    land(cfg, [(D, 1, "point", 0)], [], [])
    run_ingest_shared(spark, cfg, batch="one")
    real = incremental._refresh_features
    monkeypatch.setattr(incremental, "_refresh_features", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_incremental(spark, cfg)
    monkeypatch.setattr(incremental, "_refresh_features", real)
    assert D in run_incremental(spark, cfg) and len(features(spark, cfg)) == 1


def test_only_days_in_reach_are_read(spark, cfg):
    prints = [(day(n), 1, "point", 0) for n in range(60)]
    land(cfg, prints, prints, [(d, u, p, 1.0) for d, u, p, _ in prints])
    run_ingest_shared(spark, cfg, batch="all")
    run_incremental(spark, cfg)
    read = features_of_days(spark, cfg, day(2), day(1)).inputFiles()
    days = {f.split("/day=")[1][:10] for f in read}
    assert days == {str(day(n)) for n in range(1, 24)}


def test_replay_releases_once_and_finishes_what_was_begun(spark, cfg, monkeypatch):
    pays = [(before(2), 1, "point", 10.0), (before(2), 1, "point", -1.0), (before(2), 1, "point", -1.0), (before(3), 2, "point", -5.0)]
    land(cfg, [(D, 1, "point", 0), (D, 2, None, 0)], [], pays)
    run_ingest(spark, cfg)
    for _ in range(2):  # Two runs set the same rows aside; they return once.
        run_conform(spark, cfg, Run.new(), quarantine=True)
    silver = lambda: sorted(r.total for r in spark.table(cfg.table("silver", "pays")).collect())
    assert replay.replay(spark, cfg, "pays", rules.payment_rules()) == 0 and silver() == [10.0]
    eased = [Expectation("total_moderate", "total >= -2", "drop")]
    real = replay._finish
    monkeypatch.setattr(replay, "_finish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        replay.replay(spark, cfg, "pays", eased)
    assert silver() == [10.0]
    monkeypatch.setattr(replay, "_finish", real)
    assert replay.replay(spark, cfg, "pays", eased) == 0
    assert silver() == [-1.0, -1.0, 10.0]
    assert replay.replay(spark, cfg, "pays", eased) == 0 and silver() == [-1.0, -1.0, 10.0]
    kept = spark.table(cfg.table("monitoring", "pays_quarantine"))
    assert kept.where(f"{layers.RESOLVED_AT} IS NOT NULL").count() == 2
    assert kept.where("total = -5").where(f"{layers.RESOLVED_BY} IS NULL").count() == 2
    assert replay.replay(spark, cfg, "pays", [Expectation("any", "true", "drop")]) == 1
    # Impressions are a set: one released beside its copy stays one.
    assert replay.replay(spark, cfg, "prints", [Expectation("any", "true", "drop")]) == 1
    assert spark.table(cfg.table("silver", "prints")).count() == 2
    assert replay.replay(spark, cfg, "taps", eased) == 0


def test_rows_read_through_the_shared_table_keep_what_is_odd(spark, cfg):
    land(cfg, [(D, 1, "point", 0)], [], [])
    with open(f"{cfg.source('prints')}/odd.json", "w") as f:
        f.write('{"day":"2020-11-30","event_data":{"position":1,"value_prop":"point"},"user_id":3,"extra":1}\nbroken\n')
    run_ingest_shared(spark, cfg, batch="one")
    raw = spark.table(cfg.table("bronze", "prints_raw"))
    assert {str(r._rescued) for r in raw.collect()} == {"None", "{'extra': '1'}"}
    assert [r._malformed for r in raw.where("_malformed IS NOT NULL").collect()] == ["broken"]
    assert read_rescued(spark, cfg.source("prints"), layers.schemas.EVENT_LANDING).count() == 3

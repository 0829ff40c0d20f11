"""Typed readers, lineage, conforming and incremental ingest."""

import datetime as dt
import os

import pytest

from lookback import schemas
from lookback.operators.conform import distinct_on, flatten_events, flatten_payments, require_keys
from lookback.session import scratch_dir
from lookback.sources.files import load, read_csv, read_jsonl, with_lineage
from lookback.streaming.ingest import ingest_new_files, stream_files

GOOD = '{"day":"2020-11-01","event_data":{"position":1,"value_prop":"point"},"user_id":7}'


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_malformed_json_line_and_bad_scalar_become_nulls(spark, folder):
    path = write(
        f"{folder}/p.json",
        GOOD,
        '{"day": "2020-',
        '{"day":"2020-11-02","event_data":{"position":"x","value_prop":"point"},"user_id":8}',
    )
    got = read_jsonl(spark, path, schemas.EVENT_LANDING).collect()
    assert len(got) == 3
    assert sum(r.day is None and r.user_id is None for r in got) == 1
    assert [r.event_data.position for r in got if r.user_id == 8] == [None]


def test_malformed_line_keeps_its_text(spark, folder):
    path = f"{folder}/a.json"
    write(path, GOOD, "{broken")
    rows = read_jsonl(spark, path, schemas.EVENT_LANDING, "_malformed").collect()
    assert sorted(r._malformed or "" for r in rows) == ["", "{broken"]


def test_malformed_date_becomes_null_and_not_an_error(spark, folder):
    path = write(f"{folder}/p.json", GOOD, GOOD.replace("2020-11-01", "someday"))
    got = flatten_events(read_jsonl(spark, path, schemas.EVENT_LANDING))
    assert got.schema.names == schemas.EVENTS.names
    assert {r.day for r in got.collect()} == {dt.date(2020, 11, 1), None}
    assert require_keys(got, ["day"]).count() == 1


def test_csv_with_reordered_header_raises_or_binds_by_name(spark, folder):
    path = write(f"{folder}/p.csv", "user_id,total,pay_date,value_prop", "7,1.5,2020-11-01,point")
    with pytest.raises(Exception, match="header|CSV"):
        read_csv(spark, path, schemas.PAYMENT_LANDING).collect()
    (row,) = read_csv(spark, path, schemas.PAYMENT_LANDING, by_name=True).collect()
    assert row.asDict() == {
        "pay_date": "2020-11-01", "total": 1.5, "user_id": 7, "value_prop": "point"
    }


def test_csv_bad_amount_is_null(spark, folder):
    path = write(f"{folder}/p.csv", "pay_date,total,user_id,value_prop", "2020-11-01,abc,7,point")
    (row,) = flatten_payments(read_csv(spark, path, schemas.PAYMENT_LANDING)).collect()
    assert row.total is None and row.user_id == 7


def test_lineage_names_file_and_time(spark, folder):
    path = write(f"{folder}/p.json", GOOD)
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    (row,) = with_lineage(read_jsonl(spark, path, schemas.EVENT_LANDING), at).collect()
    assert row._source_file.endswith("/p.json") and row._ingested_at is not None
    csv = write(f"{folder}/p.csv", "pay_date,total,user_id,value_prop", "2020-11-01,1,7,point")
    by_name = read_csv(spark, csv, schemas.PAYMENT_LANDING, by_name=True)
    assert with_lineage(by_name).first()._source_file.endswith("/p.csv")


def test_events_are_a_set_and_null_position_counts_once(spark):
    d = dt.date(2020, 11, 1)
    df = spark.createDataFrame([(d, 1, "point", None)] * 2 + [(d, 1, "point", 0)], schemas.EVENTS)
    assert distinct_on(df, schemas.EVENT_KEY).count() == 2


def test_stream_takes_each_file_once(spark, folder):
    def take():
        stream = stream_files(spark, f"{folder}/in", schemas.EVENT_LANDING, max_files=1)
        ingest_new_files(stream, f"{folder}/raw", f"{folder}/ckpt")
        return load(spark, f"{folder}/raw").count()

    write(f"{folder}/in/a.json", GOOD, GOOD)
    assert take() == 2
    assert take() == 2
    write(f"{folder}/in/b.json", GOOD)
    assert take() == 3
    sources = {r._source_file.rsplit("/", 1)[1] for r in load(spark, f"{folder}/raw").collect()}
    assert sources == {"a.json", "b.json"}


def test_scratch_lies_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(root) and one != two


def test_cluster_session_without_a_shared_folder_is_refused():
    class Session:
        conf = {"spark.master": "yarn"}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")
    Session.conf["spark.checkpoint.dir"] = "hdfs://shared/"
    assert scratch_dir(Session(), "x").startswith("hdfs://shared/x-")

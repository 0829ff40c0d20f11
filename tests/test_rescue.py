"""Hinted JSON: every part of every line has a place."""

import json
import os

import pytest
from pyspark.sql import types as T

from lookback import schemas
from lookback.operators.conform import flatten_payments
from lookback.sources.files import load, read_csv
from lookback.sources.rescue import read_rescued, rescued_fields, stream_rescued
from lookback.streaming.ingest import ingest_new_files, stream_files

LINES = [
    '{"day":"2024-01-01","event_data":{"position":1,"value_prop":"a"},"user_id":5}',
    '{"day":"2024-01-01","event_data":{"position":1,"value_prop":"a","x":{"y":[1,null]}},"user_id":5,"z":true}',
    '{"day":20240101,"event_data":{"position":"12","value_prop":7},"user_id":"12"}',
    '{"day":null,"event_data":{"position":1.5},"user_id":9223372036854775808}',
    '{"event_data":[1],"user_id":{"a":1}}',
    '{"event_data":null}',
    "{}",
    "[1]",
    "7",
    '"text"',
    "null",
    '{"a":1,"a":2}',
    '{"day":"2024-01-0',
    "   ",
    "",
    '{"dotted.name":1,"we ird \'k\'":"é"}',
]
# day, (position, value_prop) or None, user, rescued, malformed
WANT = [
    ("2024-01-01", (1, "a"), 5, None, None),
    ("2024-01-01", (1, "a"), 5, {"event_data.x": '{"y":[1,null]}', "z": "true"}, None),
    ("20240101", (12, "7"), 12, None, None),
    (None, (None, None), None, {"event_data.position": "1.5", "user_id": "9223372036854775808"}, None),
    (None, None, None, {"event_data": "[1]", "user_id": '{"a":1}'}, None),
    (None, None, None, None, None),
    (None, None, None, None, None),
    *[(None, None, None, None, x) for x in ("[1]", "7", '"text"', "null", '{"a":1,"a":2}', '{"day":"2024-01-0')],
    (None, None, None, {"dotted.name": "1", "we ird 'k'": '"é"'}, None),
]


def places(df):
    def event(e):
        return None if e is None else (e.position, e.value_prop)

    return sorted(
        ((r.day, event(r.event_data), r.user_id, r._rescued, r._malformed) for r in df.collect()), key=str
    )


@pytest.fixture
def landed(folder):
    with open(f"{folder}/a.json", "w") as f:
        f.write("\n".join(LINES))
    return folder


def test_every_part_of_a_line_has_a_place(spark, landed):
    df = read_rescued(spark, landed, schemas.EVENT_LANDING)
    assert places(df) == sorted(WANT, key=str)
    assert df.columns == ["day", "event_data", "user_id", "_rescued", "_malformed", "_ingested_at", "_source_file"]


def test_stream_equals_batch(spark, landed):
    stream = stream_rescued(spark, landed, schemas.EVENT_LANDING, max_files=1)
    ingest_new_files(stream, f"{landed}/raw", f"{landed}/checkpoint")
    assert places(load(spark, f"{landed}/raw")) == sorted(WANT, key=str)


def test_inferred_types_of_what_is_missing(spark, landed):
    got = {r.path: (r.n_rows, r.inferred) for r in rescued_fields(read_rescued(spark, landed, schemas.EVENT_LANDING)).collect()}
    assert got["event_data.x"] == (1, "OBJECT<y: ARRAY<BIGINT>>") and got["z"] == (1, "BOOLEAN")
    assert got["event_data.position"][0] == 1 and len(got) == 7


def test_nested_hints_at_any_depth(spark, folder):
    schema = T.StructType().add("a", T.StructType().add("b", T.StructType().add("c", "integer").add("t", "timestamp")))
    rows = [{"a": {"b": {"c": 1, "d": 2}, "e": 3}}, {"a": {"b": 4}}, {"a": {"b": {"c": None, "t": "no time"}}}]
    with open(f"{folder}/x.json", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    got = [(r.a.b and (r.a.b.c, r.a.b.t), r._rescued) for r in read_rescued(spark, f"{folder}/x.json", schema).collect()]
    assert got == [
        ((1, None), {"a.b.d": "2", "a.e": "3"}),
        (None, {"a.b": "4"}),
        ((None, None), {"a.b.t": '"no time"'}),
    ]


def test_csv_keeps_broken_lines_in_batch_and_stream(spark, folder):
    lines = ["pay_date,total,user_id,value_prop", "2020-11-01,abc,7,point", "2020-11-01,1.5,7,point", "2020-11-02,2,8", "x,1,2,y,z"]
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/p.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    batch = read_csv(spark, f"{folder}/in", schemas.PAYMENT_LANDING, malformed="_malformed")
    want = sorted([lines[1], lines[3], lines[4], None], key=str)
    assert sorted((r._malformed for r in batch.collect()), key=str) == want
    assert {r.total for r in flatten_payments(batch).collect()} >= {1.5, None}
    stream = stream_files(spark, f"{folder}/in", schemas.PAYMENT_LANDING, "csv", malformed="_malformed")
    ingest_new_files(stream, f"{folder}/raw", f"{folder}/checkpoint")
    assert sorted((r._malformed for r in load(spark, f"{folder}/raw").collect()), key=str) == want

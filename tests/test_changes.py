"""Applied changes: old + diff = new, and nothing else is touched."""

import datetime as dt
import os
import random

import pytest

from lookback.operators.changes import ChangeConflict, apply_changes
from lookback.operators.publish import partition_values, snapshot_diff, write_table

SCHEMA = "day date, id int, v string, n double"
D = dt.date(2024, 1, 1)


def day(n):
    return D + dt.timedelta(days=n)


@pytest.fixture
def table(spark, request, folder):
    name = f"c_{abs(hash(request.node.name)) % 10**8}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{folder}'")
    yield f"{name}.t"
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def files(folder):
    return {os.path.join(a, f) for a, _, fs in os.walk(f"{folder}/t") for f in fs if f.endswith(".parquet")}


def put(spark, table, rows):
    write_table(spark.createDataFrame(rows, SCHEMA), table, ["day"])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_old_and_diff_make_new(spark, table, seed):
    rng = random.Random(seed)
    old = {i: (day(rng.randrange(6)), i, rng.choice("abc"), float(i)) for i in range(60)}
    new = {i: r for i, r in old.items() if rng.random() > 0.2}
    for i in rng.sample(sorted(new), 15):
        new[i] = (day(rng.randrange(8)), i, rng.choice(["x", None]), new[i][3])
    new |= {i: (day(rng.randrange(9)), i, "new", None) for i in range(100, 110)}
    put(spark, table, list(old.values()))
    after = spark.createDataFrame(list(new.values()), SCHEMA)
    changes = snapshot_diff(spark.table(table), after, ["id"])
    apply_changes(changes, table, ["id"], "day", ["id"])
    got = spark.table(table).select("day", "id", "v", "n").collect()
    assert sorted(map(tuple, got), key=str) == sorted(new.values(), key=str)
    assert partition_values(spark, table) == {str(r[0]) for r in new.values()}


def test_only_named_days_are_rewritten(spark, table, folder):
    rows = [(day(d), 10 * d + i, "a", 1.0) for d in range(5) for i in range(3)]
    put(spark, table, rows)
    before = files(folder)
    new = spark.createDataFrame([(r[0], r[1], "b" if r[1] == 20 else r[2], r[3]) for r in rows if r[1] not in (40, 41, 42)], SCHEMA)
    assert apply_changes(snapshot_diff(spark.table(table), new, ["id"]), table, ["id"], "day") == 2
    kept = {f for f in before if f"day={day(2)}" not in f and f"day={day(4)}" not in f}
    assert kept <= files(folder) and len(kept) == 3
    assert partition_values(spark, table) == {str(day(d)) for d in range(4)}


@pytest.mark.parametrize(
    "change",
    [
        ("delete", D, 1, "other", 1.0),
        ("delete", D, 9, "a", 1.0),
        ("insert", D, 1, "a", 1.0),
        ("update_post", D, 9, None, None),
        ("update_pre", day(1), 1, "a", 1.0),
        ("upsert", D, 9, "a", 1.0),
    ],
)
def test_changes_that_do_not_fit_write_nothing(spark, table, folder, change):
    put(spark, table, [(D, 1, "a", 1.0), (D, 2, None, None), (day(1), 3, "c", 3.0)])
    before = files(folder)
    changes = spark.createDataFrame([change, ("insert", D, 50, "n", 0.0)], f"_change_type string, {SCHEMA}")
    if change[0] == "update_post":
        # An update without its pre-image is an insert; with a row there it does not fit.
        changes = spark.createDataFrame([("update_post", D, 2, "x", 1.0)], changes.schema)
    with pytest.raises(ChangeConflict):
        apply_changes(changes, table, ["id"], "day")
    assert files(folder) == before


def test_nulls_in_rows_and_days_fit_and_twice_is_refused(spark, table):
    put(spark, table, [(D, 1, "a", 1.0), (None, 2, None, None)])
    new = spark.createDataFrame([(D, 2, None, 5.0), (None, 3, None, None)], SCHEMA)
    rows = snapshot_diff(spark.table(table), new, ["id"]).collect()
    changes = spark.createDataFrame(rows, "_change_type string, id int, day date, v string, n double")
    apply_changes(changes, table, ["id"], "day")
    got = {r.id: (r.day, r.v, r.n) for r in spark.table(table).collect()}
    assert got == {2: (D, None, 5.0), 3: (None, None, None)}
    with pytest.raises(ChangeConflict):
        apply_changes(changes, table, ["id"], "day")
    none = changes.limit(0)
    assert apply_changes(none, table, ["id"], "day") == 0

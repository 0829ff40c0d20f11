"""Lookups of few keys read few row groups."""

import pytest
from pyspark.sql import functions as F

from lookback.operators.keyed import any_of, lookup_few, write_keyed
from lookback.operators.lookup import lookup_features
from lookback.session import setting


@pytest.fixture
def features(spark, folder):
    # Users in no order, so that statistics alone cannot skip a row group.
    df = spark.range(0, 60_000, 1, 2).selectExpr("pmod(xxhash64(id), 1000000) AS user_id", "concat('u', id) AS name", "id AS v")
    write_keyed(df, f"{folder}/f", ["user_id", "name"], distinct=5_000, row_group_bytes=64 << 10)
    return spark.read.parquet(f"{folder}/f")


def rows_scanned(spark, df, folder_part):
    """Rows that the scan of a folder put out, which whole row groups make up."""
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        query = df.select("*")
        query.collect()
        plan = query._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        (scan,) = [s for s in scans if folder_part in s.toString()]
        return scan.metrics().apply("numOutputRows").value()


def test_few_keys_read_few_row_groups(spark, folder, features):
    some = [r.user_id for r in features.where("v % 20000 = 7").collect()]
    spine = spark.createDataFrame([(u,) for u in some], "user_id long")
    plain = lookup_features(spine, features, ["user_id"], ["v"])
    fast = lookup_few(spine, features, ["user_id"], ["v"])
    assert sorted(fast.collect()) == sorted(plain.collect())
    assert rows_scanned(spark, plain, f"{folder}/f"[-20:]) == 60_000
    assert rows_scanned(spark, fast, f"{folder}/f"[-20:]) < 20_000
    absent = features.where(any_of("name", ["nobody", "none"]))
    assert absent.count() == 0 and rows_scanned(spark, absent, f"{folder}/f"[-20:]) < 6_000


def test_many_keys_nulls_and_no_spine(spark, features):
    many = features.where("v < 500").select("user_id").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    for few in (3, 1000):
        got = lookup_few(many, features, ["user_id"], ["v"], few=few)
        want = lookup_features(many, features, ["user_id"], ["v"])
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
        assert "Or(EqualTo" in got._jdf.queryExecution().executedPlan().toString() or few == 3
    assert lookup_few(many.limit(0), features, ["user_id"], ["v"]).count() == 0
    assert any_of("v", [1])._jc.toString() and features.where(any_of("v", [])).count() == 0
    assert features.where(any_of("v", list(range(150)))).agg(F.count("*")).first()[0] == 150

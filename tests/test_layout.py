"""Space-filling layout, compaction, versions."""

import glob
import os
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lookback.operators import versions as v
from lookback.operators.layout import compact, interleaved, z_ordered
from lookback.operators.publish import clustered
from lookback.session import setting


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def grid(spark):
    # Users and categories without any relation to each other.
    return spark.range(0, 40_000, 1, 8).selectExpr(
        "id", "pmod(xxhash64(id), 1000) AS user_id", "concat('c', lpad(pmod(xxhash64(id, 7), 500), 3, '0')) AS prop"
    )


def files_read(folder, column, value):
    """Files whose statistics do not rule the value out."""
    n = 0
    for path in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        n += any(s.min <= value <= s.max for s in stats)
    return n


def test_filters_on_either_column_skip_files(spark, folder):
    df = grid(spark)
    z_ordered(df, ["user_id", "prop"], files=64).write.parquet(f"{folder}/z")
    with setting(spark, "spark.sql.shuffle.partitions", "64"), setting(
        spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"
    ):
        clustered(df, ["user_id", "prop"]).write.parquet(f"{folder}/sorted")
    assert rows_of(spark.read.parquet(f"{folder}/z")) == rows_of(df)
    n = len(glob.glob(f"{folder}/z/*.parquet"))
    assert n > 50
    for column, value in (("user_id", 123), ("prop", "c321")):
        assert files_read(f"{folder}/z", column, value) <= n // 3
    assert files_read(f"{folder}/sorted", "prop", "c321") > n // 2


def test_bits_are_interleaved(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    got = {(r.a, r.b): r.z for r in df.withColumn("z", interleaved([F.col("a"), F.col("b")], 2)).collect()}
    assert got == {(a, b): 8 * (a >> 1) + 4 * (b >> 1) + 2 * (a & 1) + (b & 1) for a in range(4) for b in range(4)}


def test_layout_keeps_nulls_ties_and_odd_values(spark):
    nan = float("nan")
    rows = [(None, None, None), (1.5, "a", None), (nan, "", 3), (float("inf"), "ä" * 50, 4)] + [(2.0, "hot", 5)] * 500
    df = spark.createDataFrame(rows, "d double, s string, n int")
    got = z_ordered(df, ["d", "s", "n"], files=8)
    assert got.columns == df.columns
    assert Counter(map(str, got.collect())) == Counter(map(str, df.collect()))
    assert z_ordered(df.limit(0), ["d", "s"]).count() == 0
    with pytest.raises(ValueError, match="62 bits"):
        z_ordered(df, ["d", "s"], bits=40)
    with pytest.raises(ValueError, match="cannot lay"):
        z_ordered(df.withColumn("a", F.array("d")), ["a"])


def parquet_files(folder, day):
    return sorted(glob.glob(f"{folder}/day={day}/*.parquet"))


def test_only_crowded_days_are_compacted(spark, folder):
    at = f"{folder}/t"
    df = spark.range(4000).selectExpr("id", "CAST(id % 2 AS INT) AS day")
    df.where("day = 0").repartition(20).write.partitionBy("day").parquet(at)
    df.where("day = 1").coalesce(2).write.mode("append").partitionBy("day").parquet(at)
    more = spark.range(5).selectExpr("id", "'x' AS extra", "0 AS day")
    more.write.mode("append").partitionBy("day").parquet(at)
    still, want = parquet_files(at, 1), rows_of(spark.read.option("mergeSchema", True).parquet(at).select("id", "extra", "day"))
    before = len(parquet_files(at, 0))
    size = sum(os.path.getsize(p) for p in parquet_files(at, 0))
    assert compact(spark, at, "day", target_bytes=size // 3, max_small=4) == 1
    assert parquet_files(at, 1) == still
    assert 2 <= len(parquet_files(at, 0)) <= 4 < before
    assert rows_of(spark.read.parquet(at).select("id", "extra", "day")) == want
    assert compact(spark, at, "day", target_bytes=size // 3, max_small=4) == 0


def test_a_reader_sees_one_version_at_every_step(spark, folder, request):
    spark.sql(f"CREATE SCHEMA versions_test LOCATION '{folder}/s'")
    name, root = "versions_test.t", f"{folder}/v"
    old = spark.range(10).selectExpr("id", "CAST(id % 2 AS INT) AS day")
    new = spark.range(100, 130).selectExpr("id", "CAST(id % 3 + 5 AS INT) AS day")
    try:
        assert v.current_version(spark, name) is None
        first = v.replace_version(old, name, root, ["day"])
        early = spark.table(name)
        early_rows = rows_of(old)
        folder_two = v.write_version(new, root, ["day"])
        assert rows_of(spark.table(name)) == early_rows and v.current_version(spark, name) == first
        v.switch(spark, name, folder_two)
        assert rows_of(spark.table(name)) == rows_of(new)
        assert rows_of(early) == early_rows
        v.clean(spark, name, root, keep=2)
        assert rows_of(early) == early_rows and len(v.versions(spark, root)) == 2
        # A writer that died leaves no version, and the one shown is never removed.
        os.makedirs(f"{root}/v99999999999999999999-dead")
        v.switch(spark, name, first)
        v.replace_version(new.limit(3), f"{name}2", root, keep=1)
        assert rows_of(spark.table(f"{name}2")) == rows_of(new.limit(3))
        v.clean(spark, name, root, keep=1)
        assert len(v.versions(spark, root)) == 1
        with pytest.raises(ValueError, match="must be kept"):
            v.replace_version(new, name, root, keep=0)
    finally:
        spark.sql("DROP SCHEMA versions_test CASCADE")

"""Layout, repeatable overwrites, schema handling and snapshot diffs."""

import datetime as dt
import glob
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lookback import schemas
from lookback.operators.publish import (
    append,
    clustered,
    create_table,
    empty_like,
    insert_overwrite,
    load,
    load_merged,
    replace_partitions,
    replace_table,
    snapshot_diff,
    to_schema,
    write_table,
)

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def pays(spark, rows):
    return spark.createDataFrame(rows, schemas.PAYMENTS)


def content(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_rerun_of_one_day_replaces_only_that_day(spark, folder):
    path = f"{folder}/t"
    first = pays(spark, [(D1, 1, "point", 1.0), (D2, 1, "point", 2.0)])
    write_table(first, path, ["day"])
    again = pays(spark, [(D2, 1, "point", 9.0), (D2, 2, "point", 9.0)])
    want = content(first.where(F.col("day") == D1).unionByName(again))
    for _ in range(2):
        replace_partitions(again, path, ["day"], ["user_id"])
        assert content(load(spark, path)) == want


def test_rerun_into_a_catalog_table(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS pub")
    first = pays(spark, [(D1, 1, "point", 1.0), (D2, 1, "point", 2.0)])
    write_table(first, "pub.t", ["day"])
    again = pays(spark, [(D2, 1, "point", 9.0)])
    for _ in range(2):
        replace_partitions(again, "pub.t", ["day"])
    want = content(first.where(F.col("day") == D1).unionByName(again))
    assert content(spark.table("pub.t")) == want


def test_replaced_table_loses_the_days_that_are_gone(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS pub")
    first = pays(spark, [(D1, 1, "point", 1.0), (D2, 1, "point", 2.0)])
    replace_table(first, "pub.whole", "day", ["user_id"])
    assert content(spark.table("pub.whole")) == content(first)
    second = pays(spark, [(D2, 2, "point", 3.0)])
    for _ in range(2):
        replace_table(second, "pub.whole", "day", ["user_id"])
        assert content(spark.table("pub.whole")) == content(second)
    replace_table(second.limit(0), "pub.whole", "day")
    assert spark.table("pub.whole").count() == 0
    wider = second.withColumn("currency", F.lit("EUR"))
    replace_table(wider, "pub.whole", "day")
    assert content(spark.table("pub.whole")) == content(wider)


def test_replaced_table_loses_odd_partitions_too(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS pub")
    odd = [None, "a/b", "o'x", "50%", "back\\slash", "plain"]
    kind = "v int, p string"
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(odd)], kind)
    replace_table(rows, "pub.odd", "p")
    replace_table(rows, "pub.odd", "p")
    assert content(spark.table("pub.odd")) == content(rows)
    for keep in ("a/b", "o'x"):
        replace_table(rows.where(F.col("p") == keep), "pub.odd", "p")
        assert [r.p for r in spark.table("pub.odd").collect()] == [keep]
        replace_table(rows, "pub.odd", "p")
    replace_table(rows.where("p IS NULL"), "pub.odd", "p")
    assert [r.p for r in spark.table("pub.odd").collect()] == [None]


def test_failed_replacement_keeps_the_old_rows(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS pub")
    first = pays(spark, [(D1, 1, "point", 1.0)])
    replace_table(first, "pub.kept", "day")
    broken = first.withColumn(
        "total", F.when(F.col("user_id") == 1, F.raise_error(F.lit("lost"))).otherwise(1.0)
    )
    with pytest.raises(Exception, match="lost"):
        replace_table(broken, "pub.kept", "day")
    assert content(spark.table("pub.kept")) == content(first)


def test_clustered_write_keeps_the_bag_and_splits_a_hot_key(spark):
    hot = spark.range(3000).select(
        F.lit(D1).alias("day"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("user_id"),
        F.lit("point").alias("value_prop"),
        F.lit(1.0).alias("total"),
    )
    copies = hot.unionByName(hot.where("user_id = 1")).repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = clustered(copies, ["day", "user_id"])
        parts = out.where("user_id = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert content(out) == content(copies)
    assert len(parts) > 1 and max(r["count"] for r in parts) < 2000


def test_clustered_files_have_narrow_key_ranges(spark, folder):
    path = f"{folder}/t"
    rows = spark.range(4000).select(
        F.lit(D1).alias("day"),
        (F.col("id") * 7919 % 4000).alias("user_id"),
        F.lit("point").alias("value_prop"),
        F.lit(1.0).alias("total"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(rows, path, ["day"], cluster_by=schemas.ENTITY)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = []
    for file in glob.glob(f"{path}/day=*/*.parquet"):
        meta = pq.ParquetFile(file)
        at = meta.schema_arrow.get_field_index("user_id")
        stats = meta.metadata.row_group(0).column(at).statistics
        spans.append((stats.min, stats.max))
    spans.sort()
    assert len(spans) > 1
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_declared_schema_orders_casts_and_requires_columns(spark):
    df = spark.createDataFrame([(1, "2024-01-01")], "user_id int, day string").withColumns(
        {"value_prop": F.lit("point"), "total": F.lit(1)}
    )
    assert to_schema(df, schemas.PAYMENTS).schema.names == schemas.PAYMENTS.names
    with pytest.raises(Exception):
        to_schema(df.drop("total"), schemas.PAYMENTS).collect()


def test_insert_overwrite_keeps_the_declared_schema(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS pub")
    create_table(spark, "pub.declared", schemas.PAYMENTS)
    create_table(spark, "pub.declared", schemas.PAYMENTS)
    assert spark.table("pub.declared").count() == 0
    shuffled = pays(spark, [(D1, 1, "point", 1.0)]).select("total", "value_prop", "user_id", "day")
    for _ in range(2):
        insert_overwrite(shuffled, "pub.declared")
    assert spark.table("pub.declared").collect() == pays(spark, [(D1, 1, "point", 1.0)]).collect()


def test_append_with_a_new_column(spark, folder):
    path = f"{folder}/log"
    append(spark.createDataFrame([(1,)], "a int"), path)
    append(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert {tuple(r) for r in load_merged(spark, path).collect()} == {(1, None), (2, "x")}


def test_empty_like(spark):
    df = pays(spark, [(D1, 1, "point", 1.0)])
    assert empty_like(df).schema == df.schema and empty_like(df).count() == 0


def test_snapshot_diff_reports_each_kind_of_change(spark):
    kind = "k int, p int, v double"
    old = spark.createDataFrame(
        [(1, 1, 1.0), (2, None, 2.0), (3, 1, 3.0), (4, 1, None), (5, None, 5.0)], kind
    )
    new = spark.createDataFrame(
        [(1, 1, 1.0), (2, None, 2.5), (4, 1, None), (5, None, 5.0), (6, 1, 6.0)], kind
    )
    got = {tuple(r) for r in snapshot_diff(old, new, ["k", "p"]).collect()}
    assert got == {
        ("update_pre", 2, None, 2.0),
        ("update_post", 2, None, 2.5),
        ("delete", 3, 1, 3.0),
        ("insert", 6, 1, 6.0),
    }
    assert snapshot_diff(new, new, ["k", "p"]).count() == 0

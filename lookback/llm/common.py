"""Helpers the operators share: staged tables, word splitting, connected components."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback.session import scratch_dir

#: Words are runs of anything but ASCII white space; ``bytes.split()`` cuts the same way.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    It cuts the lineage: what is downstream can be computed again after an executor is
    lost without running the steps above, and a row never changes between two reads.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACES}|{SPACES}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES))).cast("long")


def buckets(rows: int, per_bucket: int) -> int:
    """How many buckets hold ``rows`` at ``per_bucket`` rows each."""
    return max(1, math.ceil(rows / per_bucket))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (``a``, ``b``): rows (``node``, ``root``).

    Every node of an edge appears once; ``root`` is one node of its component, the same
    for all of them. In each round a node moves to the neighbour (or itself) of least
    hash, edges are renamed and the loops among them dropped, so the graph shrinks by a
    constant factor whatever its shape or numbering. The hub of a star is no hot key:
    the minimum is combined before the shuffle, and the renaming joins sit on their own
    shuffles, which AQE splits. Empty edges give no rows.
    """
    edges = staged(
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "cc-edges",
    )
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        rank = F.struct(F.xxhash64("b", F.lit(len(moves))).alias("h"), F.col("b").alias("b"))
        own = F.struct(F.xxhash64("a", F.lit(len(moves))).alias("h"), F.col("a").alias("b"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = staged(
            both.groupBy("a")
            .agg(F.min(rank).alias("m"))
            .select(F.col("a").alias("node"), F.least("m", own)["b"].alias("to")),
            "cc-move",
        )
        moves.append(move)
        left = move.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        right = move.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        renamed = edges.join(left, "a").join(right, "b").where("a2 <> b2")
        edges = staged(
            renamed.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
            .distinct(),
            "cc-edges",
        )
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root"))
    labels = moves[0].select("node", F.col("to").alias("root"))
    for move in moves[1:]:
        step = move.select(F.col("node").alias("root"), "to")
        labels = labels.join(step, "root", "left").select(
            "node", F.coalesce("to", "root").alias("root")
        )
    return labels

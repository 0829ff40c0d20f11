"""Repeated runs of lines: a suffix array over line ids, built by prefix doubling in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lookback.llm.common import n_words, staged

AT = ["row", "line"]


def _ranked(classes: DataFrame, by: list[str]) -> DataFrame:
    """Distinct ``classes`` numbered in the order of ``by``; numbers may leave gaps."""
    return staged(
        classes.orderBy(*by).withColumn("rank", F.monotonically_increasing_id()), "lines-rank"
    )


def _level(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows of classes (equal ``by``) of two or more, with the class's rank and first place.

    Counts and first places are combined before the shuffle and only distinct classes are
    sorted, so one very common line is one row of the sort. The join back sits on its own
    shuffles, where AQE splits such a class.
    """
    classes = (
        rows.groupBy(*by)
        .agg(F.count("*").alias("n"), F.min(F.struct("late", "doc", *AT)).alias("first"))
        .where("n > 1")
        .select(*by, "first")
    )
    return staged(
        rows.join(_ranked(classes, by), by).select(
            *AT,
            "late",
            "doc",
            "rank",
            F.col("first.row").alias("to_row"),
            F.col("first.line").alias("to_line"),
        ),
        "lines-level",
    )


def _shifted(level: DataFrame, by: int | Column, name: str) -> DataFrame:
    return level.select("row", (F.col("line") - by).alias("line"), F.col("rank").alias(name))


def suffix_levels(lines: DataFrame) -> list[DataFrame]:
    """Ranks of the places whose next 1, 2, 4, ... lines occur more than once.

    ``lines`` has ``row``, ``line`` (place in the row), ``doc`` and ``late`` (the order of
    rows) and the line's two hashes. Level ``k`` sorts the places by their first ``2**k``
    lines: it joins each place with the one ``2**(k-1)`` lines on, and ranks the pairs of
    their ranks. Places alone in their class have their final rank; they share no longer
    run and are left out, so the tables shrink from level to level. A run never leaves
    its row. Equal ranks of a level form one interval of the suffix array whose common
    prefix is at least ``2**k`` lines.
    """
    levels = [_level(lines, ["h1", "h2"])]
    while not levels[-1].isEmpty():
        level, step = levels[-1], 1 << (len(levels) - 1)
        ahead = _shifted(level, step, "next")
        pairs = level.select(*AT, "late", "doc", "rank").join(ahead, AT)
        pairs = pairs.withColumnRenamed("rank", "here")
        levels.append(_level(pairs, ["here", "next"]))
    return levels[:-1]


def repeated_runs(lines: DataFrame) -> DataFrame:
    """For every place that starts a later copy: the longest run that occurred earlier.

    Rows (``row``, ``line``, ``to_row``, ``to_line``, ``len``): the first ``len`` lines from
    a place occur first at ``to_row``, ``to_line``, and one line more occurs nowhere earlier.

    A place starts with the longest power of two of lines that occurred earlier. Going down
    the levels, ``len`` and the first occurrence name the class of places that share these
    lines, and a place whose next ``2**k`` lines follow at an earlier place of its class
    too grows by them: with the class's first place, or else with the earliest of the
    places that go on alike, which becomes the first of a class of its own. Places that
    have grown leave their class; whoever shares no more than the class's lines and fewer
    than the grown ones' next lines with them shares them with the first of those as well,
    which stays.
    """
    levels = suffix_levels(lines)
    later = None
    for k, level in enumerate(levels):
        copies = level.where("row <> to_row OR line <> to_line").select(
            *AT, F.struct(F.lit(k).alias("k"), "to_row", "to_line").alias("top")
        )
        later = copies if later is None else later.unionByName(copies)
    if later is None:
        return lines.select(
            *AT,
            F.col("row").alias("to_row"),
            F.col("line").alias("to_line"),
            F.lit(0).cast("long").alias("len"),
        ).limit(0)
    start = staged(
        later.groupBy(*AT)
        .agg(F.max("top").alias("top"))
        .select(
            *AT,
            "top.k",
            "top.to_row",
            "top.to_line",
            F.expr("shiftleft(1L, top.k)").alias("len"),
        ),
        "lines-runs",
    )
    names = [*AT, "to_row", "to_line", "len"]
    alike = ["to_row", "to_line", "len", "own"]
    runs = start.where(F.col("k") == len(levels) - 1).select(*names)
    for k in range(len(levels) - 2, -1, -1):
        own = levels[k].select(
            F.col("row").alias("o_row"), F.col("line").alias("o_line"), "late", "doc", F.col("rank").alias("own")
        )
        other = levels[k].select(F.col("row").alias("t_row"), F.col("line").alias("t_line"), F.col("rank").alias("other"))
        same = F.col("own").eqNullSafe(F.col("other"))
        known = F.col("own").isNotNull()
        met = (
            runs.join(own, (F.col("row") == F.col("o_row")) & (F.col("line") + F.col("len") == F.col("o_line")), "left")
            .join(other, (F.col("to_row") == F.col("t_row")) & (F.col("to_line") + F.col("len") == F.col("t_line")), "left")
            .select(
                *AT,
                "to_row",
                "to_line",
                (F.col("len") + F.when(same & known, 1 << k).otherwise(0)).alias("len"),
                *(F.when(~same & known, F.col(c)).alias(c) for c in ("own", "late", "doc")),
            )
        )
        met = staged(met, "lines-runs")
        apart = met.where("own IS NOT NULL")
        groups = (
            apart.groupBy(*alike)
            .agg(F.count("*").alias("n"), F.min(F.struct("late", "doc", *AT)).alias("first"))
            .where("n > 1")
            .select(*alike, F.col("first.row").alias("f_row"), F.col("first.line").alias("f_line"))
        )
        # Written: the join then sits on its own shuffles, where AQE can split a group.
        groups = staged(groups, "lines-groups")
        grows = F.expr("f_row IS NOT NULL AND (row <> f_row OR line <> f_line)")
        regrouped = staged(
            apart.join(groups, alike, "left").select(
                *AT,
                F.when(grows, F.col("f_row")).otherwise(F.col("to_row")).alias("to_row"),
                F.when(grows, F.col("f_line")).otherwise(F.col("to_line")).alias("to_line"),
                (F.col("len") + F.when(grows, 1 << k).otherwise(0)).alias("len"),
            ),
            "lines-runs",
        )
        runs = (
            met.where("own IS NULL")
            .select(*names)
            .unionByName(regrouped)
            .unionByName(start.where(F.col("k") == k).select(*names))
        )
    return runs


def deleted_ranges(lines: DataFrame, min_words: int) -> DataFrame:
    """Per row the line ranges that later copies of runs of ``min_words`` or more cover.

    Rows (``row``, ``ranges``: array of structs ``start``, ``stop``, both included). The
    windows run over the lines of one row.
    """
    in_row = Window.partitionBy("row").orderBy("line")
    upto = in_row.rowsBetween(Window.unboundedPreceding, 0)
    words = staged(
        lines.select(*AT, "words").withColumn("sum", F.sum("words").over(upto)), "lines-words"
    )
    runs = repeated_runs(lines)
    ends = words.select(F.col("row").alias("e_row"), F.col("line").alias("e_line"), F.col("sum").alias("e_sum"))
    long_runs = (
        runs.join(words, AT)
        .join(ends, (F.col("row") == F.col("e_row")) & (F.col("line") + F.col("len") - 1 == F.col("e_line")))
        .where(F.col("e_sum") - F.col("sum") + F.col("words") >= min_words)
        .select(*AT, (F.col("line") + F.col("len") - 1).alias("stop"))
    )
    covered = (
        words.select(*AT)
        .join(long_runs, AT, "left")
        .withColumn("reach", F.max("stop").over(upto))
        .where(F.col("reach") >= F.col("line"))
    )
    islands = covered.withColumn("island", F.col("line") - F.row_number().over(in_row))
    return (
        islands.groupBy("row", "island")
        .agg(F.min("line").alias("start"), F.max("line").alias("stop"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("ranges"))
    )


def dedup_lines(
    docs: DataFrame, *, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without later copies of repeated line runs, and what was deleted.

    Lines end at ``\\n``. For every place the longest run of lines (within its row) that
    occurred earlier is found, earlier meaning in a row of smaller id (null last; rows
    that repeat an id in the order read) or further up in the same row: the longest common
    prefix with any earlier place. Runs of ``min_words`` words or more are deleted; the
    first occurrence stays, shorter runs stay everywhere.

    All columns are kept. ``text_col`` holds the remaining lines (an empty text if none
    remain); ``lb_lines`` and ``lb_deleted`` count lines and ``lb_ranges`` lists the
    deleted ranges of line numbers, counted from 0. A null text stays null, with no
    lines; empty lines count as lines of no words. Lines are compared by 128 bits of
    hash. No rows give no rows.
    """
    names = docs.columns
    rows = staged(docs.withColumn("lb_row", F.monotonically_increasing_id()), "lines-docs")
    every = rows.select(
        F.col("lb_row").alias("row"),
        F.col(id_col).isNull().alias("late"),
        F.col(id_col).alias("doc"),
        F.posexplode(F.split(F.col(text_col), "\n")).alias("line", "text"),
    )
    every = staged(
        every.select(
            "row",
            "late",
            "doc",
            F.col("line").cast("long").alias("line"),
            F.xxhash64("text").alias("h1"),
            F.xxhash64(F.lit(1), "text").alias("h2"),
            n_words(F.col("text")).alias("words"),
        ),
        "lines-all",
    )
    seen = every.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    # Written: the join then sits on its own shuffles, where AQE can split a common line.
    seen = staged(seen, "lines-seen")
    lines = staged(every.join(seen, ["h1", "h2"]), "lines-repeated")
    ranges = deleted_ranges(lines, min_words).select(F.col("row").alias("lb_row"), F.col("ranges").alias("lb_ranges"))
    pieces = F.split(F.col(text_col), "\n")
    # What lies between the ranges, which are sorted and disjoint: one pass over the lines.
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("lb_ranges", lambda r: r["stop"] + 1))
    stops = F.transform("lb_ranges", lambda r: r["start"])
    between = lambda p: F.zip_with(
        starts,
        F.concat(stops, F.array(F.size(p).cast("long"))),
        lambda a, b: F.slice(p, (a + 1).cast("int"), (b - a).cast("int")),
    )
    kept = F.flatten(F.transform(F.array(pieces), lambda p: F.flatten(between(p))))
    total = F.aggregate("lb_ranges", F.lit(0).cast("long"), lambda a, r: a + r["stop"] - r["start"] + 1)
    text = F.when(F.col("lb_ranges").isNull(), F.col(text_col)).otherwise(F.concat_ws("\n", kept))
    joined = rows.join(ranges, "lb_row", "left")
    return joined.select(
        *(text.alias(n) if n == text_col else n for n in names),
        F.coalesce(F.size(pieces), F.lit(0)).alias("lb_lines"),
        F.coalesce(total, F.lit(0).cast("long")).alias("lb_deleted"),
        F.coalesce("lb_ranges", F.array().cast("array<struct<start:bigint,stop:bigint>>")).alias("lb_ranges"),
    )

"""Embedding near-duplicates through an inverted multi-index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookback.llm.common import buckets, components, staged
from lookback.llm.simhash import spanning

#: Members or queries of a cell that meet in one block.
PART = 1024
#: Rows of whole blocks that one call verifies.
BATCH = 4096


class Grid:
    """Two codebooks, one per half of the (zero-padded) unit vectors; cells are their pairs."""

    def __init__(self, sample: np.ndarray, words: int, seed: int, steps: int = 12) -> None:
        self.size = sample.shape[1]
        self.half = (self.size + 1) // 2
        rng = np.random.default_rng(seed)
        self.books = [
            _kmeans(part, words, rng, steps)
            for part in (sample[:, : self.half], sample[:, self.half :])
        ]

    @property
    def cells(self) -> int:
        return len(self.books[0]) * len(self.books[1])

    def traverse(self, unit: np.ndarray, visits: int) -> np.ndarray:
        """The ``visits`` nearest cells of each vector, nearest first.

        Both halves' words are sorted by distance. Cell (i, j) of these two sequences can
        be among the nearest n only if the (i+1)(j+1) cells not beyond it in either
        sequence are at most n, so only such cells are summed and sorted.
        """
        near = [
            _distances(part, book)
            for part, book in zip((unit[:, : self.half], unit[:, self.half :]), self.books, strict=True)
        ]
        order = [np.argsort(d, axis=1, kind="stable") for d in near]
        first, second = (np.take_along_axis(d, o, 1) for d, o in zip(near, order, strict=True))
        i, j = np.array(
            [
                (a, b)
                for a in range(first.shape[1])
                for b in range(min(second.shape[1], visits // (a + 1)))
            ]
        ).T
        total = first[:, i] + second[:, j]
        best = np.argsort(total, axis=1, kind="stable")[:, :visits]
        cell = order[0][:, i] * len(self.books[1]) + order[1][:, j]
        return np.take_along_axis(cell, best, 1)

    def ranks(self, query: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many cells the traversal of one vector visits before each of ``cells``."""
        one = query[None, :]
        first = _distances(one[:, : self.half], self.books[0])[0]
        second = _distances(one[:, self.half :], self.books[1])[0]
        total = (first[:, None] + second[None, :]).ravel()
        return (np.sort(total)[:, None] < total[cells]).sum(axis=0)


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1)


def _kmeans(x: np.ndarray, words: int, rng: np.random.Generator, steps: int) -> np.ndarray:
    book = x[rng.choice(len(x), min(words, len(x)), replace=False)].copy()
    for _ in range(steps):
        near = _distances(x, book).argmin(1)
        n = np.bincount(near, minlength=len(book))
        for k in np.flatnonzero(n):
            book[k] = x[near == k].mean(0)
    return book


def _units(vectors, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, zero-padded to ``size``, and their own lengths."""
    widths = np.array([len(v) for v in vectors], np.int64)
    if (widths == size).all():
        x = np.array([np.asarray(v, np.float64) for v in vectors]).reshape(-1, size)
    else:
        x = np.zeros((len(widths), size))
        for row, v in zip(x, vectors, strict=True):
            row[: len(v)] = v
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares can then neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True), widths


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and without null or non-finite components."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _verify(threshold: float, size: int):
    """Count links between the queries and members of whole blocks."""

    def block(frame: pd.DataFrame) -> pd.DataFrame:
        unit, widths = _units(frame["embedding"].to_numpy(), size)
        cid = frame["cid"].to_numpy(np.int64)
        names, node = np.unique(cid, return_inverse=True)
        copies, cell, is_query = (frame[c].to_numpy() for c in ("n", "cell", "is_query"))
        ask, held = np.flatnonzero(is_query), np.flatnonzero(~is_query.astype(bool))
        found = np.zeros(len(names), np.int64)
        if not len(ask) or not len(held):
            return pd.DataFrame({"cid": names[:0], "links": found[:0], "root": names[:0]})
        hit = (unit[ask] @ unit[held].T >= threshold) & (cid[ask][:, None] != cid[held])
        hit &= widths[ask][:, None] == widths[held]
        q, m = np.nonzero(hit)
        q, m = ask[q], held[m]
        np.add.at(found, node[q], copies[m])
        # A member whose own traversal misses the query's cell learns of the link here.
        visits = np.array(frame["visits"].to_numpy()[held].tolist(), np.int64)
        place = np.zeros(len(frame), np.int64)
        place[held] = np.arange(len(held))
        back = np.ones(len(q), bool)
        for column in range(visits.shape[1]):
            back &= visits[place[m], column] != cell[q]
        np.add.at(found, node[m[back]], copies[q[back]])
        root = spanning(len(names), node[q], node[m])
        some = np.flatnonzero((found > 0) | (root != np.arange(len(names))))
        return pd.DataFrame({"cid": names[some], "links": found[some], "root": names[root[some]]})

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([block(f) for _, f in frame.groupby(["at", "mine", "other"], sort=False)])

    return run


def similar_groups(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.9,
    per_cell: int = 64,
    recall: float = 0.999,
    min_visits: int = 8,
    sample_rows: int = 8192,
    probes: int = 512,
    min_links: int = 1000,
    seed: int = 42,
) -> DataFrame:
    """Links and groups of vectors whose cosine is ``threshold`` or more.

    Rows (``id_col``, ``n_links``: other vectors linked directly, ``component_id``: the
    smallest id reachable through links, ``kept``: whether that is the row's own id).

    Equal vectors are one class with a count. Codebooks for both halves are fitted on at
    most ``sample_rows`` classes (those of least hash); their product grid has about one
    cell per ``per_cell`` classes, so cells keep their size when the data grow. Every
    class is indexed in its nearest cell. Its multi-sequence traversal visits cells
    nearest first until the target ``recall``: how many that takes is measured with
    ``probes`` classes against all others (twice the count, at least ``min_visits``), and
    with more, up to the whole sample, while these have fewer than ``min_links`` links.
    If even the sample has fewer, all of them must be met, and ``recall`` also of pairs
    made up at the threshold itself, in random directions, to fill the number.
    Whatever the visited cells hold is verified by its exact cosine. A link counts for
    both its ends, whichever one's traversal met it. Blocks of a cell return a count per
    class and a spanning forest, never pairs; a cell over ``PART`` members or queries is
    cut into blocks that each pair a part with a part.

    Vectors that are null, empty, zero or have null or non-finite components link with
    nothing, nor do vectors of different lengths. Null ids never name a group. Repeated
    rows are different vectors that link. No rows give no rows.
    """
    own = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(vector_col).alias("embedding"),
    )
    rows = staged(own.withColumn("ok", usable(F.col("embedding"))), "index-rows")
    classes = (
        rows.where("ok")
        .groupBy("embedding")
        .agg(F.min("id").alias("least"), F.count("*").alias("n"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = staged(classes, "index-classes")
    total = classes.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("size")).first()
    none = F.lit(0).cast("long")
    if not total["n"]:
        return rows.select(
            F.col("id").alias(id_col), none.alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
        )
    size = total["size"]
    sample = classes.orderBy(F.xxhash64("embedding", F.lit(seed)), "cid").limit(sample_rows)
    sample = sample.select("cid", "embedding").toPandas()
    units, widths = _units(sample["embedding"].to_numpy(), size)
    words = max(1, math.ceil(math.sqrt(total["n"] / per_cell)))
    grid = Grid(units, words, seed)
    probe = (units, widths, sample["cid"].to_numpy())
    depth = _depth(classes, grid, probe, threshold, recall, probes, min_links, seed)
    visits = min(grid.cells, max(min_visits, 2 * depth))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_pylist()
            if held:
                found = grid.traverse(_units(held, size)[0], visits)
                cells = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel().astype(np.int32)), found.shape[1])
                arrays = [*batch.columns, pa.array(found[:, 0].astype(np.int32)), cells.cast(pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["embedding", "cid", "n", "cell", "visits"])

    kind = vectors.schema[vector_col].dataType.simpleString()
    indexed = staged(
        classes.select("embedding", "cid", "n").mapInArrow(
            index, f"embedding {kind}, cid long, n long, cell int, visits array<int>"
        ),
        "index-cells",
    )
    sides = (
        indexed.select(F.explode("visits").alias("at"), F.lit(1).alias("q"), F.lit(0).alias("m"))
        .unionByName(indexed.select(F.col("cell").alias("at"), F.lit(0).alias("q"), F.lit(1).alias("m")))
        .groupBy("at")
        .agg(F.sum("q").alias("asks"), F.sum("m").alias("holds"))
        .where("asks > 0 AND holds > 0")
        .select(
            "at",
            F.ceil(F.col("asks") / PART).cast("int").alias("ask_parts"),
            F.ceil(F.col("holds") / PART).cast("int").alias("hold_parts"),
        )
    )
    sides = staged(sides, "index-sides")
    columns = ["embedding", "cid", "n", "cell", "visits"]
    part = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = (
        indexed.withColumn("at", F.explode("visits"))
        .join(sides, "at")
        .select(
            *(c if c != "visits" else F.lit(None).cast("array<int>").alias(c) for c in columns),
            "at",
            part("ask_parts").alias("mine"),
            every("hold_parts").alias("other"),
            F.lit(True).alias("is_query"),
        )
    )
    holding = (
        indexed.withColumn("at", F.col("cell"))
        .join(sides, "at")
        .select(
            *columns,
            "at",
            every("ask_parts").alias("mine"),
            part("hold_parts").alias("other"),
            F.lit(False).alias("is_query"),
        )
    )
    n = buckets(total["n"] * (visits + 1), BATCH)
    found = staged(
        asking.unionByName(holding)
        .withColumn("batch", F.pmod(F.xxhash64("at", "mine", "other"), F.lit(n)).cast("int"))
        .groupBy("batch")
        .applyInPandas(_verify(threshold, size), "cid long, links long, root long"),
        "index-links",
    )
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = staged(
        classes.join(links, "cid", "left")
        .join(roots, F.col("cid") == F.col("node"), "left")
        .select(
            "embedding",
            "least",
            (F.coalesce("links", none) + F.col("n") - 1).alias("n_links"),
            F.coalesce("root", "cid").alias("root"),
        ),
        "index-classes",
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = named.join(least, "root").select("embedding", "n_links", "component_id")
    linked = rows.where("ok").join(answer, "embedding").select("id", "n_links", "component_id")
    single = rows.where("NOT ok").select("id", none.alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(single).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _depth(
    classes: DataFrame, grid: Grid, sample, threshold: float, recall: float, probes: int, min_links: int, seed: int
) -> int:
    """Cells that the probes' traversals visit to meet ``recall`` of ``min_links`` links or more."""
    met, upto = {}, 0
    while upto < len(sample[0]) and sum(met.values()) < min_links:
        start, upto = upto, max(probes, 2 * upto)
        for rank, n in _link_ranks(classes, grid, [s[start:upto] for s in sample], threshold):
            met[rank] = met.get(rank, 0) + n
    links = sum(met.values())
    depth = _reach(met, recall if links >= min_links else 1.0)
    if links < min_links:
        made = _made_ranks(grid, sample[0], sample[1], threshold, min_links - links, seed)
        depth = max(depth, _reach(dict(zip(*np.unique(made, return_counts=True), strict=True)), recall))
    return depth


def _reach(met: dict[int, int], recall: float) -> int:
    """Least number of visits that meets ``recall`` of the links counted by rank."""
    whole, seen = sum(met.values()), 0
    for rank in sorted(met):
        seen += met[rank]
        if seen >= recall * whole:
            return int(rank) + 1
    return 0


def _made_ranks(
    grid: Grid, units: np.ndarray, widths: np.ndarray, threshold: float, n: int, seed: int
) -> np.ndarray:
    """Ranks of the cells of ``n`` vectors that have the cosine ``threshold`` with a sampled one."""
    rng = np.random.default_rng(seed)
    ranks = [np.empty(0, np.int64)]
    for i in np.arange(n) % len(units):
        aside = np.zeros(grid.size)
        aside[: widths[i]] = rng.normal(size=widths[i])
        aside -= (aside @ units[i]) * units[i]
        other = threshold * units[i]
        if (length := np.linalg.norm(aside)) > 1e-9:
            other = other + math.sqrt(max(0.0, 1 - threshold**2)) * aside / length
        ranks.append(grid.ranks(units[i], grid.traverse(other[None, :], 1)[0]))
    return np.concatenate(ranks)


def _link_ranks(classes: DataFrame, grid: Grid, probe, threshold: float) -> list[tuple[int, int]]:
    """How many links of the probes have their other end in the cell of each rank."""
    units, widths, cids = probe
    size = grid.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(1).to_pylist()
            if not held:
                continue
            x, own = _units(held, size)
            hit = (units @ x.T >= threshold) & (widths[:, None] == own)
            hit &= cids[:, None] != batch.column(0).to_numpy()
            if not hit.any():
                continue
            cells = grid.traverse(x, 1)[:, 0]
            ranks = [grid.ranks(units[i], cells[hit[i]]) for i in np.flatnonzero(hit.any(1))]
            rank, n = np.unique(np.concatenate(ranks).astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(rank), pa.array(n)], names=["rank", "n"])

    seen = classes.select("cid", "embedding").mapInArrow(run, "rank long, n long")
    return [(r["rank"], r["n"]) for r in seen.groupBy("rank").agg(F.sum("n").alias("n")).collect()]

"""SimHash near-duplicates, linked through BK-trees over shards of the fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.llm.common import buckets, components, staged

#: Tree nodes and queries that meet in one search; a larger shard is cut into parts.
PART = 512
#: Rows of whole shards that one call of the search handles.
BATCH = 4096


def text_fingerprint(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit fingerprint of a whole text; 0 if it has no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashed = np.fromiter((xxhash.xxh64_intdigest(p, 42) for p in parts), np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashed), 65536):
        block = hashed[start : start + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashed), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(``id``, ``fp``) of every row; null texts count as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [text_fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, fp long")


class BKForest:
    """BK-trees, one per shard: a child hangs on its parent by their Hamming distance.

    Trees are grown level by level on whole arrays. At each level an item goes to the
    child at its distance from the current node; the first of a distance becomes that
    child.
    """

    def __init__(self, shard: np.ndarray, code: np.ndarray) -> None:
        self.code = code
        keys, first, where = np.unique(shard, return_index=True, return_inverse=True)
        self.roots = dict(zip(keys.tolist(), first.tolist(), strict=True))
        at = first[where]
        active = np.flatnonzero(at != np.arange(len(code)))
        at = at[active]
        edges, children = [], []
        while len(active):
            gap = np.bitwise_count(code[active] ^ code[at]).astype(np.int64)
            edge, first, where = np.unique(at * 65 + gap, return_index=True, return_inverse=True)
            child = active[first]
            edges.append(edge)
            children.append(child)
            at = child[where]
            rest = at != active
            active, at = active[rest], at[rest]
        edge = np.concatenate(edges) if edges else np.empty(0, np.int64)
        child = np.concatenate(children) if children else np.empty(0, np.int64)
        order = np.argsort(edge)
        self.edge, self.child = edge[order], child[order]

    def search(
        self, shard: np.ndarray, code: np.ndarray, radius: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) index pairs within ``radius``, following only edges that may hold one."""
        query = np.flatnonzero(np.isin(shard, list(self.roots)))
        node = np.array([self.roots[s] for s in shard[query].tolist()], np.int64)
        while len(query):
            gap = np.bitwise_count(code[query] ^ self.code[node]).astype(np.int64)
            hit = gap <= radius
            yield query[hit], node[hit]
            low = np.searchsorted(self.edge, node * 65 + np.maximum(gap - radius, 0), "left")
            high = np.searchsorted(self.edge, node * 65 + np.minimum(gap + radius, 64), "right")
            width = high - low
            ends = np.cumsum(width)
            within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - width, width)
            node = self.child[np.repeat(low, width) + within]
            query = np.repeat(query, width)


def spanning(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least index of each item's component in a graph of ``n`` items."""
    label = np.arange(n)
    while len(left):
        least = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if (label == before).all():
            break
    return label


def _search_rows(radius: int):
    """One batch of whole (shard, tree part, query part) groups to forest edges."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        code = frame["fp"].to_numpy(np.int64).view(np.uint64)
        _, key = np.unique(
            frame[["combo", "band", "tree", "query"]].to_numpy(np.int64), axis=0, return_inverse=True
        )
        key = key.reshape(-1)
        trees = np.flatnonzero(frame["in_tree"].to_numpy(bool))
        asks = np.flatnonzero(frame["in_query"].to_numpy(bool))
        forest = BKForest(key[trees], code[trees])
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for start in range(0, len(asks), 1024):
            chunk = asks[start : start + 1024]
            for query, node in forest.search(key[chunk], code[chunk], radius):
                a, b = chunk[query], trees[node]
                keep = a != b
                left.append(a[keep])
                right.append(b[keep])
        label = spanning(len(code), np.concatenate(left), np.concatenate(right))
        moved = np.flatnonzero(label != np.arange(len(label)))
        signed = code.view(np.int64)
        return pd.DataFrame({"a": signed[moved], "b": signed[label[moved]]})

    return run


def near_links(classes: DataFrame, radius: int) -> DataFrame:
    """Edges (``a``, ``b``) that connect distinct ``fp`` within ``radius`` bits of another.

    Shards come from the pigeonhole principle: of ``blocks`` bit blocks, two fingerprints
    within ``radius`` agree on ``blocks - radius`` whole ones, so every choice of that
    many blocks gives a shard key and each link falls into at least one shard. More rows
    only take more, narrower blocks, which keeps shards small. A shard holds one BK-tree;
    one over ``PART`` rows is cut into parts, each tree part is sent to all query parts
    of the shard, and no part is ever larger. A tree of all fingerprints would grow with
    the data and is never broadcast. Of the links in a group only a spanning forest is
    returned, never all pairs.
    """
    rows = classes.count()
    blocks = radius + 1
    while blocks < radius + 3 and rows > 256 * 2 ** (64 * (blocks - radius) // blocks):
        blocks += 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = 0
        for block in chosen:
            mask |= (1 << cuts[block + 1]) - (1 << cuts[block])
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    shards = classes.select(
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(i).alias("combo"), F.col("fp").bitwiseAND(F.lit(m)).alias("band"))
                    for i, m in enumerate(masks)
                )
            )
        ).alias("s"),
    ).select("fp", "s.combo", "s.band")
    sizes = shards.groupBy("combo", "band").agg(F.count("*").alias("n")).where("n > 1")
    sizes = staged(sizes, "simhash-sizes")
    parts = F.ceil(F.col("n") / PART).cast("int")
    mine = F.pmod(F.xxhash64("fp"), "parts").cast("int")
    spread = (
        shards.join(sizes, ["combo", "band"])
        .withColumn("parts", parts)
        .withColumn("part", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "combo",
            "band",
            "fp",
            F.least("part", "other").alias("tree"),
            F.greatest("part", "other").alias("query"),
            (F.col("part") <= F.col("other")).alias("in_tree"),
            (F.col("part") >= F.col("other")).alias("in_query"),
        )
    )
    spread = staged(spread, "simhash-shards")
    n = buckets(spread.count(), BATCH)
    return (
        spread.withColumn(
            "batch", F.pmod(F.xxhash64("combo", "band", "tree", "query"), F.lit(n)).cast("int")
        )
        .groupBy("batch")
        .applyInPandas(_search_rows(radius), "a long, b long")
    )


def simhash_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 3,
) -> DataFrame:
    """Near-duplicate group of every row: (``id_col``, ``fingerprint``, ``component_id``).

    Texts are split at ASCII white space after lower-casing A-Z; shingles of ``shingle``
    words (repeats included) are hashed with XXH64, and a bit of the fingerprint is set
    when over half of the hashes set it. Rows link at ``radius`` or fewer differing bits;
    ``component_id`` is the smallest id reachable through links, the row's own included.

    Null or empty texts have fingerprint zero and link like any other. A text of fewer
    words than a shingle is one shingle. Rows with equal texts share one class, so
    thousands of copies cost one tree node. A row with a null id is in its group but
    never names it; a group of null ids only has a null ``component_id``. Repeated rows
    stay as they are. No rows give no rows.
    """
    return _groups(docs, id_col, text_col, shingle, radius).select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def _groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    """(``id``, ``fp``, ``root``: a fingerprint that names the group, ``component_id``) of every row."""
    prints = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    classes = staged(
        prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes"
    )
    roots = components(near_links(classes, radius))
    labelled = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    labelled = staged(labelled, "simhash-roots")
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp")


def one_of_each(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 3,
) -> DataFrame:
    """One row of each near-duplicate group: that of the smallest id, all columns kept.

    Rows with a null id always stay, since no id tells them apart from their group. Of
    rows of a group that repeat its smallest id, the first by text stays. Rows that repeat
    an id with texts of different groups are told apart by their fingerprints.
    """
    groups = _groups(docs, id_col, text_col, shingle, radius)
    named = staged(groups.where("id IS NOT NULL").select("id", "fp", "root", "component_id"), "simhash-named")
    keep = named.where("id = component_id").select(F.col("id").alias("keep_id"), "fp", "root").distinct()
    many = named.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("many_id"))
    many = staged(many, "simhash-repeated")
    kept = docs.join(keep, docs[id_col] == keep["keep_id"], "left_semi")
    if not many.isEmpty():

        @F.arrow_udf("long")
        def fingerprint(texts: pa.Array) -> pa.Array:
            return pa.array([text_fingerprint(t.as_py(), shingle) for t in texts], pa.int64())

        one = kept.join(many, kept[id_col] == many["many_id"], "left_anti")
        rows = kept.join(many, kept[id_col] == many["many_id"], "left_semi").select(
            F.struct(*docs.columns).alias("lb_r"), F.col(text_col).cast("binary").alias("lb_t")
        )
        # Written first: a Python function cannot be evaluated inside a join's condition.
        rows = staged(rows, "simhash-rows")
        rows = staged(rows.select("lb_r", fingerprint("lb_t").alias("lb_fp")), "simhash-prints")
        same = (F.col(f"lb_r.{id_col}") == keep["keep_id"]) & (rows["lb_fp"] == keep["fp"])
        first = F.min(F.struct(F.col(f"lb_r.{text_col}").alias("t"), F.col("lb_r").alias("r"))).alias("m")
        rows = rows.join(keep, same).groupBy("keep_id", "root").agg(first)
        kept = one.unionByName(rows.select("m.r.*"))
    return kept.unionByName(docs.where(F.col(id_col).isNull()))

"""Document quality: a classifier's evidence combined with that of the document's site."""

from __future__ import annotations

import math
import operator
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookback.llm.common import staged

UPPER = string.ascii_uppercase.encode()
DIGITS = string.digits.encode()
PUNCTUATION = string.punctuation.encode()
#: Byte grams are hashed to so many bits.
BITS = 20


def shape(text: bytes, words: list[bytes], distinct: int) -> list[float]:
    """Features that do not depend on the vocabulary; ``words`` are not empty."""
    size, n = len(text), len(words)
    share = lambda chars: 1 - len(text.translate(None, chars)) / size
    return [
        share(UPPER),
        share(DIGITS),
        share(PUNCTUATION),
        sum(map(operator.eq, words, words[1:])) / n,
        1 - distinct / n,
        math.log(n),
        math.log(size / n),
        max(map(len, words)) / size,
    ]


def grams(text: bytes) -> np.ndarray:
    """Hashed windows of five and of eight bytes of a text, one per window.

    The short ones find parts of words, the long ones starts of words with the space
    before them.
    """
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    found = []
    for size, factor in ((5, 0x9E3779B97F4A7C15), (8, 0xC2B2AE3D27D4EB4F)):
        n = len(raw) - size + 1
        if n > 0:
            packed = raw[:n].copy()
            for i in range(1, size):
                packed |= raw[i : n + i] << np.uint64(8 * i)
            found.append((packed * np.uint64(factor)) >> np.uint64(64 - BITS))
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, np.int64)


def _table(chosen: np.ndarray) -> np.ndarray:
    """1 + the place of a gram among the chosen ones, 0 for the others."""
    table = np.zeros(1 << BITS, np.int32)
    table[chosen] = np.arange(1, len(chosen) + 1)
    return table


def _present(held: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places of the chosen grams that occur."""
    at = table[held]
    return np.unique(at[at > 0]) - 1


@dataclass
class Logistic:
    """Weights of the shape features and of chosen grams for one label."""

    dense: np.ndarray
    chosen: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray, held: np.ndarray, table: np.ndarray) -> float:
        return float(self.bias + x @ self.dense + self.weights[_present(held, table)].sum())


@dataclass
class Model:
    """A text is good if it is neither poor (first part) nor toxic (second part)."""

    mean: np.ndarray
    scale: np.ndarray
    parts: list[Logistic]

    def score(self, text: bytes | None, tables: list[np.ndarray]) -> float | None:
        """Probability that a whole text is good; None if it has no word."""
        words = (text or b"").lower().split()
        if not words:
            return None
        x = shape(text, words, len(set(words)))
        x = np.clip((np.array(x) - self.mean) / self.scale, -8, 8)
        held = grams(b" " + b" ".join(words) + b" ")
        good = 1.0
        for part, table in zip(self.parts, tables, strict=True):
            good /= 1 + math.exp(max(-30.0, min(30.0, part.logit(x, held, table))))
        return good


def _fitted(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 30) -> np.ndarray:
    """Newton steps for a ridge-penalised logistic regression; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = 8000,
    n_grams: int = 256,
    seed: int = 42,
) -> Model:
    """Fit on at most ``max_rows`` labelled rows, the first by a seeded hash of their id.

    A row is good if its quality is 1 and it is not toxic. Rows whose id or labels are
    null, or whose text has no word, are left out; of labels that contradict each other
    the worse one holds. ``n_grams`` byte grams are chosen by how strongly their presence
    tells the classes apart. A label without both classes rejects nothing. The
    sample of ids is broadcast and its few features meet on the driver: both are bounded
    by ``max_rows``.
    """
    chosen = (
        labels.groupBy(F.col(id_col).alias("lb_id"))
        .agg((1 - F.min("quality")).cast("int").alias("poor"), F.max("toxic").cast("int").alias("toxic"))
        .where("lb_id IS NOT NULL AND poor IS NOT NULL AND toxic IS NOT NULL")
        .orderBy(F.xxhash64("lb_id", F.lit(seed)), "lb_id")
        .limit(max_rows)
    )

    sample = staged(
        docs.select(F.col(text_col).cast("binary").alias("text"), F.col(id_col).alias("lb_id"))
        .join(F.broadcast(chosen), "lb_id")
        .select("text", "poor", "toxic"),
        "quality-sample",
    )
    best = {name: _telling_grams(sample, name, n_grams) for name in ("poor", "toxic")}
    tables = [_table(grams) for grams in best.values()]

    def features(batches):
        for batch in batches:
            rows = []
            for text, poor, toxic in zip(*batch.columns, strict=True):
                words = (text.as_py() or b"").lower().split()
                if words:
                    raw = grams(b" " + b" ".join(words) + b" ")
                    rows.append(
                        {
                            "dense": shape(text.as_py(), words, len(set(words))),
                            "of_poor": _present(raw, tables[0]),
                            "of_toxic": _present(raw, tables[1]),
                            "poor": poor.as_py(),
                            "toxic": toxic.as_py(),
                        }
                    )
            places = pa.list_(pa.int32())
            kinds = [("dense", pa.list_(pa.float64())), ("of_poor", places), ("of_toxic", places)]
            schema = pa.schema([*kinds, ("poor", pa.int32()), ("toxic", pa.int32())])
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    held = sample.mapInArrow(
        features,
        "dense array<double>, of_poor array<int>, of_toxic array<int>, poor int, toxic int",
    ).toArrow()
    if not len(held):
        return Model(np.zeros(8), np.ones(8), [])
    x = np.array(held["dense"].to_pylist())
    mean, scale = x.mean(0), x.std(0) + 1e-9
    x = np.clip((x - mean) / scale, -8, 8)
    parts = []
    for name, chosen_grams in best.items():
        bad = held[name].to_numpy() > 0
        if bad.any() and not bad.all():
            present = np.zeros((len(bad), len(chosen_grams)))
            for row, hits in zip(present, held[f"of_{name}"].to_pylist(), strict=True):
                row[hits] = 1
            w = _fitted(np.hstack([x, present]), bad.astype(float), ridge=1.0)
            size = x.shape[1]
            parts.append(Logistic(w[:size], chosen_grams, w[size:-1], float(w[-1])))
    return Model(mean, scale, parts)


def _telling_grams(sample: DataFrame, label: str, n: int) -> np.ndarray:
    """The ``n`` grams whose presence differs most between the two classes of a label."""

    def counts(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                held, bad = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                for text, mark in zip(*batch.slice(at, 500).columns, strict=True):
                    words = (text.as_py() or b"").lower().split()
                    if words:
                        own = np.unique(grams(b" " + b" ".join(words) + b" "))
                        held.append(own)
                        if mark.as_py():
                            bad.append(own)
                gram, n = np.unique(np.concatenate(held), return_counts=True)
                of_bad = np.bincount(np.searchsorted(gram, np.concatenate(bad)), minlength=len(gram))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), pa.array(n), pa.array(of_bad.astype(np.int64))],
                    names=["gram", "n", "bad"],
                )

    size = sample.agg(F.count("*").alias("n"), F.sum(label).alias("bad")).first()
    if not size["bad"] or size["bad"] == size["n"]:
        return np.empty(0, np.int64)
    totals = (
        sample.select("text", label)
        .mapInArrow(counts, "gram long, n long, bad long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    )
    share = F.col("n") / size["n"]
    gap = F.abs(F.col("bad") / size["bad"] - (F.col("n") - F.col("bad")) / (size["n"] - size["bad"]))
    strength = gap / F.sqrt(share * (1 - share) + 1e-6)
    top = totals.where("n >= 5").orderBy(strength.desc(), "gram").limit(n).select("gram")
    return np.array([r["gram"] for r in top.collect()], np.int64)


def classifier_score(model: Model, text: Column) -> Column:
    """The classifier's probability that a text is good; null if it has no word."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        tables = [_table(part.chosen) for part in model.parts]
        return pa.array([model.score(t.as_py(), tables) for t in texts], pa.float64())

    return score(text.cast("binary"))


def _strength(groups: DataFrame, level: list[str], mean: float) -> float:
    """Prior strength (pseudo documents) by the method of moments over the sites of a level.

    The spread of site means beyond what their sizes explain tells how much sites differ;
    if they do not, the prior outweighs any site.
    """
    site = groups.groupBy(*level).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")
    )
    gap = F.col("s") / F.col("n") - F.lit(mean)
    within = F.greatest(F.col("q") / F.col("n") - (F.col("s") / F.col("n")) ** 2, F.lit(1e-9))
    row = site.where("n > 1").agg(
        F.sum(F.col("n") * gap * gap).alias("between"),
        F.sum(F.col("n") * within / (F.col("n") - 1)).alias("noise"),
        F.sum("n").alias("n"),
    ).first()
    if not row["n"]:
        return 1e6
    spread = (row["between"] - row["noise"]) / row["n"]
    return float(min(1e6, max(1.0, mean * (1 - mean) / spread - 1))) if spread > 1e-9 else 1e6


def judge(
    docs: DataFrame,
    model: Model,
    *,
    host: Column,
    path: Column,
    text_col: str = "text",
    threshold: float = 0.5,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``doc_score``, ``site_score``, ``quality`` and ``kept`` added.

    ``doc_score`` is the classifier's probability. Sites are ``host`` and ``path`` within
    it. A host's posterior starts from the global mean and a path's from its host's, each
    weighed by a prior strength estimated over all sites of its level, so sparse sites
    shrink towards what lies above them. A document's own score is left out of its site.
    ``quality`` is its posterior: the classifier's log odds moved by those of its site
    against the global mean. A text without words has null scores and is not kept. A null
    host or path is a site of its own. No rows give no rows. A text takes time and memory
    in proportion to its length.

    Rows are written once with their scores, so each text is scored once; both the sums and
    the result read that. ``keep_text`` false leaves the text out there and in the result.

    Sums per site are combined before the shuffle, so a host with a third of all rows is
    a few rows per task. The site table joins by its measured size: Spark broadcasts it
    while small and otherwise sorts, splitting a hot site.
    """
    score = classifier_score(model, F.col(text_col))
    scored = docs.withColumns({"lb_host": host, "lb_path": path, "doc_score": score})
    if not keep_text:
        scored = scored.drop(text_col)
    names = [c for c in docs.columns if keep_text or c != text_col]
    scored = staged(scored, "quality-scores")
    groups = (
        scored.where("doc_score IS NOT NULL")
        .groupBy("lb_host", "lb_path")
        .agg(
            F.count("*").alias("n"),
            F.sum("doc_score").alias("s"),
            F.sum(F.col("doc_score") ** 2).alias("q"),
        )
    )
    groups = staged(groups, "quality-sites")
    total = groups.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = min(0.999, max(0.001, total["s"] / total["n"])) if total["n"] else 0.5
    k_host = _strength(groups, ["lb_host"], mean)
    k_path = _strength(groups, ["lb_host", "lb_path"], mean)
    hosts = groups.groupBy("lb_host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    sites = (
        groups.alias("g")
        .join(hosts.alias("h"), F.col("g.lb_host").eqNullSafe(F.col("h.lb_host")))
        .select(
            F.col("g.lb_host").alias("at_host"),
            F.col("g.lb_path").alias("at_path"),
            F.col("n").alias("path_n"),
            F.col("s").alias("path_s"),
            "host_n",
            "host_s",
        )
    )
    # Written, so that its size is known and a small table spares the texts a shuffle.
    sites = staged(sites, "quality-means")
    at = F.col("lb_host").eqNullSafe(F.col("at_host")) & F.col("lb_path").eqNullSafe(F.col("at_path"))
    own = F.col("doc_score")
    host_mean = (F.lit(k_host * mean) + F.col("host_s") - own) / (k_host + F.col("host_n") - 1)
    site_mean = (k_path * host_mean + F.col("path_s") - own) / (k_path + F.col("path_n") - 1)
    clip = lambda p: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    logit = lambda p: F.log(clip(p) / (1 - clip(p)))
    odds = logit(own) + logit(F.col("site_score")) - F.lit(math.log(mean / (1 - mean)))
    judged = scored.join(sites, at, "left").withColumn("site_score", site_mean)
    # Without a score there is no posterior either: greatest() would skip the null.
    judged = judged.withColumn("quality", F.when(own.isNotNull(), 1 / (1 + F.exp(-odds))))
    return judged.withColumn("kept", F.coalesce(F.col("quality") >= threshold, F.lit(False))).select(
        *names, "doc_score", "site_score", "quality", "kept"
    )

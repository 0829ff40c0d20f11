"""Quality rules: base counts, and bands of N-gram perplexity per language."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lookback.llm.common import staged

SYMBOLS = b"#*$%&|<>"
#: Between documents: a byte that no word has. A text ends with one.
MARK = b"\n"
PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text counted at once.
CHUNK = 4 << 20
WINDOW = 5


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines and words in repeated windows."""
    text = text or b""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        reach = 0
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + WINDOW - max(i, reach)
                reach = i + WINDOW
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def _stream(text: bytes | None, order: int) -> bytes:
    """The words of a text joined by spaces, with marks before and one after."""
    return MARK * (order - 1) + b" ".join((text or b"").split()) + MARK


def packed(stream: np.ndarray, order: int) -> np.ndarray:
    """Every ``order`` bytes of a stream as one number, the last byte lowest."""
    n = max(0, len(stream) - order + 1)
    raw = stream.astype(np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(order):
        out = (out << np.uint64(8)) | raw[i : n + i]
    return out


def _language(lang: Column) -> Column:
    """Language as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


@dataclass
class Chunk:
    """Texts of one language; ``rows`` says which they are."""

    rows: list[int]
    streams: list[bytes]

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The gram that ends at each byte but the leading marks; first one of each text."""
        sizes = np.array([len(s) for s in self.streams])
        stream = np.frombuffer(b"".join(self.streams), np.uint8)
        begins = np.cumsum(sizes) - sizes
        valid = np.ones(len(stream), bool)
        for i in range(order - 1):
            valid[begins + i] = False
        inner = sizes - (order - 1)
        return packed(stream, order)[valid[order - 1 :]], np.cumsum(inner) - inner


def _chunks(langs: list[str], texts: list[bytes | None], order: int) -> Iterator[tuple[str, Chunk]]:
    held: dict[str, Chunk] = {}
    size: Counter[str] = Counter()
    for row, (lang, text) in enumerate(zip(langs, texts, strict=True)):
        chunk = held.setdefault(lang, Chunk([], []))
        chunk.rows.append(row)
        chunk.streams.append(_stream(text, order))
        size[lang] += len(chunk.streams[-1])
        if size[lang] >= CHUNK:
            del size[lang]
            yield lang, held.pop(lang)
    yield from held.items()


def count_grams(docs: DataFrame, *, order: int, text_col: str, lang_col: str) -> DataFrame:
    """(``lang``, ``gram``, ``n``) of all byte N-grams of all texts.

    A task counts chunks of its texts by sorting and returns each chunk's distinct grams,
    which are few; Spark adds them up, combining before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            for lang, chunk in _chunks(langs, texts, order):
                gram, n = np.unique(chunk.grams(order)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

    rows = docs.select(
        _language(F.col(lang_col)).alias("lang"), F.col(text_col).cast("binary").alias("text")
    )
    counted = rows.mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, order: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Interpolated modified Kneser-Ney model of packed gram counts, one table per order.

    Tables (``lang``, ``gram``, ``lp``: natural log of the probability of the last byte
    after the others) from one byte up, and (``lang``, ``gram``, ``lg``: log weight that
    a context passes on to the next shorter one) from the empty context up. The highest order uses counts, the lower ones how
    many different bytes precede a gram; discounts come from each order's counts of
    counts. Below one byte all 256 are equally likely.
    """
    types = {order: counts.select("lang", "gram", "n")}
    for m in range(order - 1, 0, -1):
        below = F.col("gram").bitwiseAND((1 << 8 * m) - 1)
        types[m] = staged(
            types[m + 1].groupBy("lang", below.alias("gram")).agg(F.count("*").alias("n")), "kn-types"
        )
    found: list[DataFrame] = []
    weights: dict[int, DataFrame] = {}
    for m in range(1, order + 1):
        few = lambda k: F.count(F.when(F.col("n") == k, 1)).cast("double")
        y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
        cut = lambda k, a, b: F.greatest(
            F.lit(0.0), F.least(F.lit(float(k)), F.when(F.col(a) > 0, k - (k + 1) * y * F.col(b) / F.col(a)).otherwise(0.5))
        )
        discounts = (
            types[m]
            .groupBy("lang")
            .agg(*(few(k).alias(f"n{k}") for k in range(1, 5)))
            .select("lang", cut(1, "n1", "n2").alias("d1"), cut(2, "n2", "n3").alias("d2"), cut(3, "n3", "n4").alias("d3"))
        )
        # Written, so that its size is known: a row per language is broadcast at once.
        discounts = staged(discounts, "kn-discounts")
        rows = types[m].join(discounts, "lang").withColumn("context", F.shiftright("gram", 8))
        cutoff = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = rows.withColumn("cut", cutoff)
        contexts = rows.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("passed")
        )
        weights[m - 1] = contexts.select("lang", F.col("context").alias("gram"), F.log(F.greatest("passed", F.lit(1e-12))).alias("lg"))
        rows = rows.join(contexts, ["lang", "context"])
        own = (F.col("n") - F.col("cut")) / F.col("total")
        if m == 1:
            p = own + F.greatest("passed", F.lit(1e-12)) / 256
        else:
            lower = found[-1].select("lang", F.col("gram").alias("suffix"), F.col("lp").alias("low"))
            rows = rows.withColumn("suffix", F.col("gram").bitwiseAND((1 << 8 * (m - 1)) - 1))
            rows = rows.join(lower, ["lang", "suffix"])
            p = own + F.greatest("passed", F.lit(1e-12)) * F.exp("low")
        found.append(staged(rows.select("lang", "gram", F.log(p).alias("lp")), "kn-level"))
    return found, [weights[m] for m in range(order)]


#: Log probabilities are multiples of 1 / FINE: few enough bits for arrays of short floats.
FINE = float(1 << 18)


@dataclass
class HashedModel:
    """Sorted hash arrays per language and order, with logarithms beside them.

    ``grams[lang, m]`` has the probabilities of grams of ``m`` bytes, ``contexts[lang, m]``
    the weights that contexts of ``m`` bytes pass on.
    """

    order: int
    grams: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]
    contexts: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]

    @classmethod
    def collect(cls, levels: list[DataFrame], weights: list[DataFrame], least: int = 1) -> HashedModel:
        """Tables of consecutive orders from ``least`` on, and of contexts one shorter."""
        grams, contexts = {}, {}
        for held, tables, value, first in ((grams, levels, "lp", least), (contexts, weights, "lg", least - 1)):
            for m, one in enumerate(tables, first):
                rows = one.select("lang", "gram", value).toArrow()
                langs = rows["lang"].combine_chunks().dictionary_encode()
                for code, lang in enumerate(langs.dictionary.to_pylist()):
                    mine = langs.indices.to_numpy() == code
                    key = rows["gram"].to_numpy()[mine].astype(np.uint64) * PRIME
                    order = np.argsort(key)
                    held[lang, m] = key[order], rows[value].to_numpy()[mine][order].astype(np.float32)
        return cls(least + len(levels) - 1, grams, contexts)

    def scores(self, lang: str, grams: np.ndarray) -> np.ndarray:
        """Log probability of the last byte of each gram, backing off where it is unknown."""
        out = np.zeros(len(grams))
        rest = np.arange(len(grams))
        for m in range(self.order, 0, -1):
            tail = grams[rest] & np.uint64((1 << 8 * m) - 1)
            value, known = _found(self.grams.get((lang, m)), tail)
            out[rest] += value
            rest, tail = rest[~known], tail[~known]
            if not len(rest):
                return out
            out[rest] += _found(self.contexts.get((lang, m - 1)), tail >> np.uint64(8))[0]
        out[rest] -= math.log(256)
        return out


def _found(table: tuple[np.ndarray, np.ndarray] | None, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of grams (0 where there is none) and which are there."""
    if table is None or not len(table[0]):
        return np.zeros(len(grams)), np.zeros(len(grams), bool)
    keys, values = table
    hashed = grams * PRIME
    at = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
    known = keys[at] == hashed
    return np.where(known, values[at], 0), known


BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _measured(rows: DataFrame, order: int, model) -> DataFrame:
    """(``id``, ``lang``, base counts, ``log_ppl``); ``model`` broadcasts its arrays."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = HashedModel(order, *model.value)
        for batch in batches:
            langs, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            counts = np.array([base_counts(t) for t in texts], np.int64).reshape(-1, 5)
            score = np.full(len(texts), np.nan)
            for lang, chunk in _chunks(langs, texts, order):
                grams, begins = chunk.grams(order)
                sizes = np.diff(np.append(begins, len(grams)))
                total = np.add.reduceat(held.scores(lang, grams), begins)
                score[chunk.rows] = -total / sizes
            score[counts[:, 0] == 0] = np.nan
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *map(pa.array, counts.T), pa.array(score, from_pandas=True)],
                names=["id", "lang", *(c.split()[0] for c in BASE.split(", ")), "log_ppl"],
            )

    return rows.mapInArrow(run, f"id {kind}, lang string, {BASE}, log_ppl double")


def _joined(rows: DataFrame, order: int, top: DataFrame) -> DataFrame:
    """As ``_measured``, for a model of any size: a document's grams meet it in a join."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            counts = np.array([base_counts(t) for t in texts], np.int64).reshape(-1, 5)
            held = [
                np.unique(Chunk([0], [_stream(t, order)]).grams(order)[0], return_counts=True) for t in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    *map(pa.array, counts.T),
                    pa.array([g.astype(np.int64) for g, _ in held], pa.list_(pa.int64())),
                    pa.array([n for _, n in held], pa.list_(pa.int64())),
                ],
                names=["id", "lang", *(c.split()[0] for c in BASE.split(", ")), "grams", "ns"],
            )

    shape = f"id {kind}, lang string, {BASE}, grams array<long>, ns array<long>"
    held = staged(rows.mapInArrow(run, shape).withColumn("row", F.monotonically_increasing_id()), "kn-docs")
    grams = held.select("row", "lang", F.explode(F.arrays_zip("grams", "ns")).alias("g"))
    grams = grams.select("row", "lang", F.col("g.grams").alias("gram"), F.col("g.ns").alias("k"))
    sums = (
        grams.join(top.select("lang", "gram", "lp"), ["lang", "gram"])
        .groupBy("row")
        .agg((-F.sum(F.col("lp") * F.col("k")) / F.sum("k")).alias("log_ppl"))
    )
    names = [c.split()[0] for c in BASE.split(", ")]
    score = F.when(F.col("n_words") > 0, F.col("log_ppl"))
    return held.join(sums, "row", "left").select("id", "lang", *names, score.alias("log_ppl"))


def bands(measured: DataFrame, width: float, step: float = 1e-3) -> DataFrame:
    """(``lang``, ``middle``, ``reach``): the median and ``width`` robust deviations.

    Log perplexities are rounded to ``step`` and counted, so the median and the median
    deviation are exact for the rounded values, need no sorting of documents and do not
    depend on their order. A deviation below ``step`` counts as ``step``.
    """
    def median(rows: DataFrame, value: str) -> DataFrame:
        counts = rows.groupBy("lang", value).agg(F.sum("k").alias("k"))
        order = Window.partitionBy("lang").orderBy(value)
        counts = counts.withColumns(
            {"upto": F.sum("k").over(order), "all": F.sum("k").over(Window.partitionBy("lang"))}
        )
        middle = counts.where(2 * F.col("upto") >= F.col("all"))
        return middle.groupBy("lang").agg(F.min(value).alias("median"))

    cells = (
        measured.where("log_ppl IS NOT NULL AND NOT base_failed")
        .groupBy("lang", F.round(F.col("log_ppl") / step).cast("long").alias("cell"))
        .agg(F.count("*").alias("k"))
    )
    cells = staged(cells, "kn-cells")
    centre = median(cells, "cell")
    gaps = cells.join(centre, "lang").select("lang", F.abs(F.col("cell") - F.col("median")).alias("gap"), "k")
    spread = median(gaps, "gap").withColumnRenamed("median", "gap")
    reach = F.greatest(F.col("gap"), F.lit(1)) * 1.4826 * width
    return centre.join(spread, "lang").select(
        "lang", (F.col("median") * step).alias("middle"), (reach * step).alias("reach")
    )


def quality_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = 5,
    width: float = 3.2,
    short: float = 50.0,
    max_grams: int = 8_000_000,
) -> DataFrame:
    """Base counts and the perplexity verdict of every document.

    Rows (``id_col``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept``, ``perplexity``, ``low``, ``high``).
    ``base_failed``: fewer than 10 words, or over a fifth of them in windows of five words
    found twice or more. Otherwise ``kept`` says whether the perplexity lies in the band
    of the document's language: ``width`` robust deviations of the log perplexity around
    its median over all documents that the base rules pass. A text of ``n`` words is a
    small sample, so its band is wider by the factor ``1 + short / n``.

    The model is a modified Kneser-Ney model of byte N-grams over the words joined by
    single spaces, one per language, counted over all documents. Counting and the model's
    tables are Spark aggregations. Every gram of a document is in the model, so documents
    need its highest order only. With up to ``max_grams`` of these grams they are broadcast
    as sorted hash arrays: 12 bytes a gram, and some 30 on their way to the driver, 240 MB
    at most. A larger model is joined with the documents' distinct grams instead. Log
    probabilities are rounded to 2^-18, which makes their sums exact in any order, so both
    ways give equal scores and verdicts.

    Null and empty texts have no words, no perplexity and fail the base rules. A null
    language is one of its own. Repeated rows stay; null ids stay null. No rows give no
    rows.
    """
    counts = staged(count_grams(docs, order=order, text_col=text_col, lang_col=lang_col), "kn-counts")
    tables = kneser_ney(counts, order)
    rows = docs.select(
        F.col(id_col).alias("id"),
        _language(F.col(lang_col)).alias("lang"),
        F.col(text_col).cast("binary").alias("text"),
    )
    top = tables[0][-1].select("lang", "gram", (F.round(F.col("lp") * FINE) / FINE).alias("lp"))
    if counts.count() <= max_grams:
        model = HashedModel.collect([top], [], least=order)
        model = docs.sparkSession.sparkContext.broadcast((model.grams, model.contexts))
        measured = _measured(rows, order, model)
    else:
        measured = _joined(rows, order, top)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    measured = staged(measured.withColumn("base_failed", failed), "kn-scored")
    reach = F.col("reach") * (1 + short / F.greatest("n_words", F.lit(1)))
    inside = F.abs(F.col("log_ppl") - F.col("middle")) <= reach
    return measured.join(bands(measured, width), "lang", "left").select(
        F.col("id").alias(id_col),
        *(c.split()[0] for c in BASE.split(", ")),
        "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
        F.exp("log_ppl").alias("perplexity"),
        F.exp(F.col("middle") - reach).alias("low"),
        F.exp(F.col("middle") + reach).alias("high"),
    )

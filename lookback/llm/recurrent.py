"""Whole-document log-likelihood under a gated recurrent language model."""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, count, islice, pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.llm.common import staged

#: The end of a text counts as a token; no word has this spelling.
END = xxhash.xxh64_intdigest(b"") - (1 << 63)
#: Head words per class, and classes of all other words (by length and final punctuation).
MEMBERS = 32
TAIL_CLASSES = 10
#: Documents looked at together, distinct words counted together, tokens packed together.
DOCS, WORDS, TOKENS = 500, 200_000, 8_000_000
#: Words outside the head, at most, whose counts are sent to all tasks; all others are joined.
LISTED = 1 << 17
#: Sixteenths of the training documents that each round learns from, all of them once.
ROUNDS = ((0, 1), (1, 4), (4, 16))


def word_hashes(words: Iterable[bytes]) -> np.ndarray:
    """XXH64 of each word, less 2^63."""
    return (np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def tail_classes(words: Iterable[bytes]) -> np.ndarray:
    """Class of each word by length and final punctuation."""
    words = list(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    last = b"".join(w[-1:] or b" " for w in words)
    stop = np.isin(np.frombuffer(last, np.uint8), np.frombuffer(b".,;:!?", np.uint8))
    return 2 * np.minimum(size // 3, TAIL_CLASSES // 2 - 1) + stop


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_counts(rows: DataFrame) -> DataFrame:
    """(``word``: hash, ``c``, ``kind``: tail class) of the tokens of all rows' ``text``.

    A task adds up words before they leave it, and Spark again before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(_words(text.as_py()))
                seen[b""] += 1
                if len(seen) > WORDS:
                    yield _counted(seen)
                    seen.clear()
        yield _counted(seen)

    counted = rows.select("text").mapInArrow(run, "word long, kind int, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.min("kind").alias("kind"))


def _counted(seen: Counter[bytes]) -> pa.RecordBatch:
    arrays = [
        pa.array(word_hashes(seen), pa.int64()),
        pa.array(tail_classes(seen), pa.int32()),
        pa.array(list(seen.values()), pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["word", "kind", "c"])


@dataclass
class Vocabulary:
    """Head words by falling count (the end first) and what the tail classes sum up to.

    ``listed`` holds all words that occur ``least`` times or more, by hash, and ``often`` how
    often each of them does; without them, every word outside the head is looked up by a join.
    """

    head: dict[int, int]
    counts: np.ndarray
    tail: np.ndarray
    total: int
    distinct: int
    listed: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    often: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    least: int | None = None

    @classmethod
    def of(cls, counts: DataFrame, head_words: int, listed_words: int) -> Vocabulary:
        whole = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
        top = counts.where(F.col("word") != END).orderBy(F.desc("c"), "word").limit(head_words - 1).collect()
        end = counts.where(F.col("word") == END).agg(F.sum("c").alias("c")).first()["c"] or 0
        head = {END: 0} | {r["word"]: i for i, r in enumerate(top, 1)}
        held = np.zeros((TAIL_CLASSES, 2))
        for r in counts.groupBy("kind").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
            held[r["kind"]] = r["n"], r["v"]
        for r in [*top, {"kind": int(tail_classes([b""])[0]), "c": end}]:
            held[r["kind"]] -= r["c"], 1
        least, listed = cls._least(counts, listed_words), counts.select("word", "c").limit(0)
        if least is not None:
            listed = counts.select("word", "c").where(F.col("c") >= least)
        listed = listed.toArrow().sort_by("word")
        return cls(
            head,
            np.array([end, *(r["c"] for r in top)], float),
            np.maximum(held, 0),
            int(whole["n"] or 0),
            int(whole["v"]),
            listed["word"].to_numpy(),
            listed["c"].to_numpy(),
            least,
        )

    @staticmethod
    def _least(counts: DataFrame, most: int) -> int | None:
        """The least count that at most ``most`` words reach, among the starts of count ranges.

        Ranges are an eighth of a doubling wide, so there are few, however large the counts;
        None if too many words share the highest one.
        """
        bands = counts.groupBy(F.floor(F.log2("c") * 8).alias("band")).agg(F.min("c").alias("c"), F.count("*").alias("n"))
        least, held = None, 0
        for r in bands.orderBy(F.desc("band")).collect():
            held += r["n"]
            if held > most:
                break
            least = r["c"]
        return least


@dataclass
class _Known:
    """What a task knows of the words it has met: places by word, and their values by place."""

    vocab: Vocabulary

    def __post_init__(self) -> None:
        self.place: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.hashes, self.codes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.known, self.gain = np.zeros(0, bool), np.zeros(0)
        self.base, self.joined = np.zeros(0), np.zeros(0, bool)

    def places(self, words: Iterable[bytes], n: int) -> np.ndarray:
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, n)
        if len(self.place) > len(self.hashes):
            self._add(list(islice(self.place, len(self.hashes), None)))
        return at

    def _add(self, words: list[bytes]) -> None:
        """Values of new words.

        Head words have a code, are known if they have a count, and have their whole base
        part in ``base``. Others have their class, the base part of an unseen word, and in
        ``gain`` what their count, if listed, adds to it; the rest are ``joined``.
        """
        v = self.vocab
        hashed = word_hashes(words)
        first, part = len(v.counts), math.log10(v.total + 0.5 * (v.distinct + 1))
        code = np.fromiter(map(v.head.get, hashed.tolist(), repeat(-1)), np.int64, len(words))
        head = code >= 0
        known, gain, joined = np.zeros(len(words), bool), np.zeros(len(words)), ~head
        base = np.full(len(words), math.log10(0.5) - part)
        known[head] = v.counts[code[head]] > 0
        base[head] = np.log10((v.counts[code[head]] + 0.5) / (v.total + 0.5 * (v.distinct + 1)))
        if len(v.listed):
            at = np.minimum(np.searchsorted(v.listed, hashed), len(v.listed) - 1)
            listed = ~head & (v.listed[at] == hashed)
            known |= listed
            gain[listed] = np.log10(v.often[at[listed]] + 0.5) - math.log10(0.5)
            joined &= ~listed
        code = np.where(head, code, first + tail_classes(words))
        self.hashes, self.codes = np.append(self.hashes, hashed), np.append(self.codes, code)
        self.known, self.gain = np.append(self.known, known), np.append(self.gain, gain)
        self.base, self.joined = np.append(self.base, base), np.append(self.joined, joined)


def encode(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Tokens as small numbers, and what the words not listed need looked up.

    Adds ``n_tokens``, ``codes`` (16-bit: head words, then tail classes), ``known`` and
    ``base`` (sums over tokens, words to be looked up counted as unseen), ``inner`` (log10
    of what tail words have within their classes, likewise) and the distinct words to be
    looked up with their counts.
    """
    first = len(vocab.counts)
    unseen = np.log10(0.5 / (vocab.tail[:, 0] + 0.5 * (vocab.tail[:, 1] + 1)))
    worth = np.append(np.zeros(first), unseen)
    kind = rows.schema["id"].dataType.simpleString()

    def some(met: _Known, texts: list[bytes | None]) -> list[pa.Array]:
        lists = [_words(t) for t in texts]
        for words in lists:
            words.append(b"")
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ends = np.append(0, np.cumsum(sizes))
        at = met.places(chain.from_iterable(lists), int(ends[-1]))
        own = np.repeat(np.arange(len(lists)), sizes)
        codes = met.codes[at]
        total = lambda values: np.bincount(own, values[at], len(lists))
        gain = total(met.gain)
        inner = np.bincount(own, worth[codes], len(lists)) + gain
        rest = met.joined[at]
        pairs, ns = np.unique(own[rest] * len(met.hashes) + at[rest], return_counts=True)
        cuts = np.searchsorted(pairs, np.arange(len(lists) + 1) * len(met.hashes))
        offsets = pa.array(cuts, pa.int32())
        data = codes.astype("<i2").tobytes()
        return [
            pa.array(sizes),
            pa.array([data[2 * a : 2 * b] for a, b in pairwise(ends.tolist())], pa.binary()),
            pa.array(total(met.known).astype(np.int64)),
            pa.array(total(met.base) + gain),
            pa.array(inner),
            pa.ListArray.from_arrays(offsets, pa.array(met.hashes[pairs % len(met.hashes)])),
            pa.ListArray.from_arrays(offsets, pa.array(ns.astype(np.int64))),
        ]

    names = ["n_tokens", "codes", "known", "base", "inner", "words", "ns"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = _Known(vocab)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                arrays = some(met, part.column(3).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *arrays], names=["row", "id", "held_out", *names])
                if len(met.place) > WORDS:
                    met = _Known(vocab)

    return rows.select("row", "id", "held_out", "text").mapInArrow(
        run,
        f"row long, id {kind}, held_out boolean, n_tokens long, codes binary, known long, "
        "base double, inner double, words array<long>, ns array<long>",
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """The logistic function, written over its argument."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _gates(x: np.ndarray, size: int) -> np.ndarray:
    """The three gates of the last axis put first, each one contiguous."""
    return np.ascontiguousarray(np.moveaxis(x.reshape(*x.shape[:-1], 3, size), -2, 0))


def _softmax(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores less their row's highest, written over them, then their exponentials and sums."""
    score -= np.ascontiguousarray(score.T).max(0)[:, None]  # far faster than along short rows
    e = np.exp(score)
    return e, e.sum(1, keepdims=True)


class Network:
    """A GRU over token codes with a class-factored softmax, in float32.

    ``p`` holds the weights: ``x`` (input of each token to the three gates), ``u`` and
    ``b`` (recurrence), ``c``/``cb`` (classes from the state) and ``o``/``ob`` (members of
    each class of head words). Tail classes have no members here: what a word is worth
    within its class follows from its count.
    """

    def __init__(self, p: dict[str, np.ndarray]) -> None:
        self.p = p
        self.size = p["u"].shape[0]
        self.heads = p["o"].shape[0]

    @classmethod
    def start(cls, vocab: Vocabulary, size: int, seed: int) -> Network:
        """Small random weights; the output biases start at the counted frequencies."""
        rng = np.random.default_rng(seed)
        heads = math.ceil(len(vocab.counts) / MEMBERS)
        members = np.zeros(heads * MEMBERS)
        members[: len(vocab.counts)] = vocab.counts + 0.5
        members = members.reshape(heads, MEMBERS)
        classes = np.concatenate([members.sum(1), vocab.tail[:, 0] + 0.5])
        with np.errstate(divide="ignore"):
            inner = np.maximum(np.log(members / members.sum(1, keepdims=True)), -1e4)
        small = lambda *shape: rng.normal(0, 0.1, shape)
        tokens = len(vocab.counts) + TAIL_CLASSES
        p = {
            "x": small(tokens, 3 * size),
            "u": small(size, 3 * size) / math.sqrt(size / 16),
            "b": np.zeros(3 * size),
            "c": small(size, len(classes)),
            "cb": np.log(classes / classes.sum()),
            "o": small(heads, MEMBERS, size),
            "ob": inner,
        }
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def filled(self, flat: np.ndarray) -> Network:
        p, at = {}, 0
        for k, v in self.p.items():
            p[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        return Network(p)

    def states(self, ids: np.ndarray, h: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States after each step of (steps, streams) input codes; -1 starts from zero."""
        n, u = self.size, _gates(self.p["u"], self.size)
        x = np.take(_gates(self.p["x"] + self.p["b"], n), np.maximum(ids, 0), axis=1)
        fresh = ids < 0
        starts = fresh.any(1)
        out = np.empty((*ids.shape, n), u.dtype)
        for t in range(len(ids)):
            if starts[t]:
                h = np.where(fresh[t][:, None], u.dtype.type(0), h)
            r = h @ u
            z, reset = _sigmoid(x[:2, t] + r[:2])
            new = reset * r[2]
            new += x[2, t]
            np.tanh(new, out=new)
            if keep is not None:
                keep.append((h, z, reset, new, r[2], fresh[t]))
            step = h - new
            step *= z
            h = np.add(new, step, out=out[t])
        return out, h

    def losses(self, h: np.ndarray, target: np.ndarray, grad: dict | None = None):
        """Log probability of each target given its state; with ``grad``, also dLoss/dState.

        Targets of -1 are padding. Gradients are of the mean negative log probability.
        Targets of one class lie together, so each class takes one product over its rows.
        """
        real = target >= 0
        whole = bool(real.all())
        if not whole:
            h, target = h[real], target[real]
        first = self.heads * MEMBERS
        tails = len(self.p["cb"]) - self.heads
        classes = np.append(np.arange(first) // MEMBERS, self.heads + np.arange(tails))
        group = classes.astype(np.int16)[target]
        score = h @ self.p["c"]
        score += self.p["cb"]
        e, total = _softmax(score)
        every = np.arange(len(h))
        lp = score[every, group] - np.log(total[:, 0])
        back = None
        if grad is not None:
            d = np.divide(e, total, out=e)
            d[every, group] -= 1
            d /= max(1, len(h))
            grad["c"], grad["cb"] = h.T @ d, d.sum(0)
            back = d @ self.p["c"].T
            grad["o"], grad["ob"] = np.zeros_like(self.p["o"]), np.zeros_like(self.p["ob"])
        order = np.argsort(group, kind="stable")
        ends = np.searchsorted(group[order], np.arange(self.heads + 1))
        order = order[: ends[-1]]
        held = h[order]
        parts = [(k, slice(ends[k], ends[k + 1])) for k in range(self.heads) if ends[k] < ends[k + 1]]
        score = np.empty((len(held), MEMBERS), lp.dtype)
        for k, at in parts:
            np.matmul(held[at], self.p["o"][k].T, out=score[at])
            score[at] += self.p["ob"][k]
        if parts:
            e, total = _softmax(score)
            every, member = every[: len(held)], target[order] % MEMBERS
            lp[order] += score[every, member] - np.log(total[:, 0])
        if parts and grad is not None:
            d = np.divide(e, total, out=e)
            d[every, member] -= 1
            d /= max(1, len(h))
            more = np.empty_like(held)
            for k, at in parts:
                grad["o"][k], grad["ob"][k] = d[at].T @ held[at], d[at].sum(0)
                np.matmul(d[at], self.p["o"][k], out=more[at])
            back[order] += more
        if not whole:
            lp, back = _spread(lp, real), _spread(back, real)
        return lp if grad is None else (lp, back)

    def window(self, ids: np.ndarray, target: np.ndarray, h: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of one window by truncated backpropagation, and the state after it."""
        keep: list = []
        grad: dict[str, np.ndarray] = {}
        out, last = self.states(ids, h, keep)
        _, d_out = self.losses(out.reshape(-1, self.size), target.ravel(), grad)
        d_out = d_out.reshape(out.shape)
        n, u = self.size, self.p["u"]
        grad["u"] = np.zeros_like(u)
        d_x = np.empty((*ids.shape, 3 * n), u.dtype)
        d_h = np.zeros_like(last)
        for t in range(len(ids) - 1, -1, -1):
            before, z, reset, new, r_new, fresh = keep[t]
            d_h += d_out[t]
            rest = 1 - z
            d_new = d_h * rest
            d_new *= 1 - new * new
            d_z = before - new
            d_z *= d_h
            d_z *= z
            d_z *= rest
            d_reset = d_new * r_new
            d_reset *= reset
            d_reset *= 1 - reset
            np.concatenate([d_z, d_reset, d_new], 1, out=d_x[t])
            d_new *= reset
            d_r = np.concatenate([d_z, d_reset, d_new], 1)
            grad["u"] += before.T @ d_r
            d_h *= z
            d_h += d_r @ u.T
            if fresh.any():
                d_h[fresh] = 0
        d_x = d_x.reshape(-1, 3 * n)
        grad["b"] = d_x.sum(0)
        codes = np.maximum(ids.ravel(), 0).astype(np.int16)
        order = np.argsort(codes, kind="stable")
        grad["x"] = np.zeros_like(self.p["x"])
        codes, starts, sizes = np.unique(codes[order], return_index=True, return_counts=True)
        few = sizes <= 2
        one, two = starts[few], (sizes == 2)[few]
        sums = d_x[order[one]]
        sums[two] += d_x[order[one[two] + 1]]
        grad["x"][codes[few]] = sums
        if not few.all():
            # Codes seen often are added up in runs, which for short ones takes longer.
            order = order[np.repeat(~few, sizes)]
            runs = np.append(0, np.cumsum(sizes[~few])[:-1])
            grad["x"][codes[~few]] = np.add.reduceat(d_x[order], runs)
        return grad, last


def _spread(values: np.ndarray | None, real: np.ndarray) -> np.ndarray | None:
    """Values of the real targets at their places, zero at padding."""
    if values is None:
        return None
    out = np.zeros((len(real), *values.shape[1:]), values.dtype)
    out[real] = values
    return out


def packed(docs: list[np.ndarray], streams: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents laid end to end in parallel streams of about equal length.

    Returns (steps, streams) arrays: the target codes, the codes before them (-1 at the
    start of a document, where the state starts anew) and the document's number; padding
    has target -1.
    """
    loads = [(0, s) for s in range(min(streams, len(docs)))]
    placed: list[tuple[int, int, int]] = []
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        load, s = heapq.heappop(loads)
        placed.append((i, s, load))
        heapq.heappush(loads, (load + len(docs[i]), s))
    steps = max(load for load, _ in loads)
    target = np.full((steps, len(loads)), -1, np.int16)
    before = np.full((steps, len(loads)), -1, np.int16)
    owner = np.zeros((steps, len(loads)), np.int32)
    for i, s, at in placed:
        codes = docs[i]
        target[at : at + len(codes), s] = codes
        before[at + 1 : at + len(codes), s] = codes[:-1]
        owner[at : at + len(codes), s] = i
    return target, before, owner


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    """Rows and their codes (the last column), some ``TOKENS`` at a time."""
    rows, docs, size = [], [], 0
    for batch in batches:
        begin = 0
        for i, codes in enumerate(batch.column(batch.num_columns - 1), 1):
            docs.append(np.frombuffer(codes.as_py(), "<i2"))
            size += len(docs[-1])
            if size >= TOKENS:
                yield [*rows, batch.slice(begin, i - begin)], docs
                rows, docs, size, begin = [], [], 0, i
        if begin < batch.num_rows:
            rows.append(batch.slice(begin))
    if docs:
        yield rows, docs


def _windows(target: np.ndarray, before: np.ndarray, size: int, steps: int):
    """Windows of packed documents with the streams that still run and their carried state.

    Yields (inputs, targets, states, streams, start); the caller writes the state that
    follows back into ``states`` at ``streams``.
    """
    h = np.zeros((target.shape[1], size), np.float32)
    for at in range(0, len(target), steps):
        own = target[at : at + steps]
        live = np.flatnonzero((own >= 0).any(0))
        yield before[at : at + steps, live].astype(np.int64), own[:, live].astype(np.int64), h, live, at


def _learn(
    net: Network, target: np.ndarray, before: np.ndarray, steps: int, rate: float, least: int
) -> Network:
    """One pass over packed documents, the state carried from window to window.

    Adam moves the weights once windows with ``least`` tokens have been seen, so the end
    of a long document, alone in its window, counts for no more than its tokens.
    """
    one = {k: np.zeros_like(v) for k, v in net.p.items()}
    two = {k: np.zeros_like(v) for k, v in net.p.items()}
    held, seen, n = {k: np.zeros_like(v) for k, v in net.p.items()}, 0, 0
    for inputs, own, h, live, at in _windows(target, before, net.size, steps):
        grad, h[live] = net.window(inputs, own, h[live])
        tokens = int((own >= 0).sum())
        for k, g in grad.items():
            g *= np.float32(tokens)
            held[k] += g
        seen += tokens
        if seen < least and at + steps < len(target):
            continue
        n += 1
        norm = math.sqrt(sum(float((g * g).sum()) for g in held.values())) / seen
        shrink = min(1.0, 1.0 / max(norm, 1e-9)) / seen
        speed = rate * min(1.0, n / 20) * math.sqrt(1 - 0.999**n) / (1 - 0.9**n)
        for k, g in held.items():
            g *= np.float32(shrink)
            step = g - one[k]
            step *= 0.1
            one[k] += step
            np.multiply(g, g, out=step)
            step -= two[k]
            step *= 0.001
            two[k] += step
            np.sqrt(two[k], out=step)
            step += 1e-6
            np.divide(np.multiply(one[k], speed, out=g), step, out=step)
            net.p[k] -= step
            g[:] = 0
        seen = 0
    return net


def train_round(
    coded: DataFrame, net: Network, *, streams: int, steps: int, rate: float, least: int
) -> Network:
    """Every task learns from its documents, starting alike; the weights are averaged.

    Averages are by tokens, over pieces of the weights, first within groups of tasks and
    then over the groups, so neither a task nor the driver ever holds more than a group's
    pieces or one set of weights.
    """
    shapes, flat = {k: v.shape for k, v in net.p.items()}, net.flat()
    piece = 1024

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, at = {}, 0
        for k, shape in shapes.items():
            size = int(np.prod(shape))
            p[k] = flat[at : at + size].reshape(shape).copy()
            at += size
        mine, seen, group = Network(p), 0, 0
        for rows, docs in _packs(batches):
            target, before, _ = packed(docs, streams)
            mine = _learn(mine, target, before, steps, rate, least)
            seen += int((target >= 0).sum())
            group = rows[0].column(0)[0].as_py() >> 33
        if seen:
            held = mine.flat().astype(np.float64) * seen
            parts = [held[i : i + piece] for i in range(0, len(held), piece)]
            n = len(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(n), pa.int32()),
                    pa.array([group % 64] * n, pa.int32()),
                    pa.array([float(seen)] * n, pa.float64()),
                    pa.array(parts, pa.list_(pa.float64())),
                ],
                names=["piece", "part", "weight", "sums"],
            )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "piece": [frame["piece"].iloc[0]],
                "part": [0],
                "weight": [frame["weight"].sum()],
                "sums": [np.sum(frame["sums"].to_list(), axis=0)],
            }
        )

    shape = "piece int, part int, weight double, sums array<double>"
    learned = coded.select("row", "codes").mapInArrow(run, shape)
    some = learned.groupBy("piece", "part").applyInPandas(add, shape)
    whole = staged(some.groupBy("piece").applyInPandas(add, shape), "lm-weights")
    found = whole.orderBy("piece").collect()
    if not found:
        return net
    return net.filled(np.concatenate([np.array(r["sums"]) / r["weight"] for r in found]))


def log_likelihoods(coded: DataFrame, net: Network, *, streams: int, steps: int) -> DataFrame:
    """Rows with ``lp``: natural log of the probability of their classes and head words.

    Takes ``codes`` out and leaves the other columns as they are.
    """
    p = net.p
    others = [n for n in coded.columns if n != "codes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Network(p)
        for rows, docs in _packs(batches):
            target, before, owner = packed(docs, streams)
            total = np.zeros(len(docs))
            for inputs, own, h, live, at in _windows(target, before, mine.size, steps):
                out, h[live] = mine.states(inputs, h[live])
                lp = mine.losses(out.reshape(-1, mine.size), own.ravel())
                total += np.bincount(owner[at : at + steps, live].ravel(), lp, len(docs))
            begin = 0
            for batch in rows:
                lp = pa.array(total[begin : begin + batch.num_rows])
                begin += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lp], names=[*others, "lp"])

    shape = coded.select(*others).withColumn("lp", F.lit(0.0)).schema
    return coded.select(*others, "codes").mapInArrow(run, shape)


def score_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    head_words: int = 1024,
    listed_words: int = LISTED,
    size: int = 16,
    streams: int = 256,
    steps: int = 16,
    rate: float = 5e-3,
    least: int = 1024,
    seed: int = 42,
) -> DataFrame:
    """Base and model score of every whole text.

    Rows (``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score``). Tokens are the words after lower-casing A-Z, then one end.
    Rows whose crc32(id as text) mod 5 is 1 are held out, the model learns from all
    others: word counts from all their tokens, the recurrent network from all their
    windows, once, in rounds whose weights are averaged over the tasks.

    ``base_score`` is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))). The model reads a
    text token by token. From its state it gives a probability to the next token's class,
    and within a class of the ``head_words`` most frequent words to the member. Other
    words fall into classes by length and final punctuation, where a word of count c has
    (c + 0.5) / (n + 0.5 (v + 1)), n and v being the class's tokens and words; all words
    not seen in training share one such part. ``score`` is the log10 probability of all
    tokens. The state starts from zero with each text and is carried from window to
    window to its end, also where backpropagation is cut.

    Sent to tasks are the head (``head_words``), the weights and the counts of the most
    frequent other words (``listed_words``), all bounded. Counts of all further words are joined
    with the documents' distinct words by word, sums going back by row: no word is a hot
    key there, since the frequent ones are in the head or listed.

    Null and empty texts are their end token. A null id is no remainder 1 and so in
    training. Repeated rows stay. Without training rows the network keeps its start.
    """
    spread = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 1, F.lit(False)).alias("held_out"),
        F.col(text_col).cast("binary").alias("text"),
    )
    counts = staged(word_counts(spread.where("NOT held_out")), "lm-counts")
    counts = counts.where("c > 0")
    vocab = Vocabulary.of(counts, head_words, listed_words)
    coded = staged(encode(spread, vocab), "lm-coded")
    net = Network.start(vocab, size, seed)
    turn = F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(16))
    for low, high in ROUNDS:
        some = coded.where(~F.col("held_out") & (turn >= low) & (turn < high))
        net = train_round(some, net, streams=streams, steps=steps, rate=rate, least=least)
    scored = log_likelihoods(coded.drop("words", "ns"), net, streams=streams, steps=steps)
    tail = coded.select("row", F.explode(F.arrays_zip("words", "ns")).alias("w"))
    tail = tail.select("row", F.col("w.words").alias("word"), F.col("w.ns").alias("k"))
    rare = counts.select("word", "c")
    if vocab.least is not None:
        rare = rare.where(F.col("c") < vocab.least)
    c = F.col("c").cast("double")
    sums = tail.join(rare, "word").groupBy("row").agg(
        F.sum("k").alias("more"),
        F.sum(F.col("k") * (F.log10(c + 0.5) - math.log10(0.5))).alias("gain"),
    )
    gain = F.coalesce("gain", F.lit(0.0))
    found = (
        staged(scored, "lm-scores")
        .join(sums, "row", "left")
        .withColumn("n_known", F.col("known") + F.coalesce("more", F.lit(0)))
        .withColumn("base_score", F.col("base") + gain)
        .withColumn("score", F.col("lp") / math.log(10) + F.col("inner") + gain)
    )
    return found.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )

"""SentencePiece encoding with N-best segmentations, and decoding."""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: A literal U+2581 in a text is no space: it takes this code, which no piece has.
LITERAL = 0x7FFFFFFF
PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Chunks remembered by a task before it starts afresh, texts and bytes looked at together.
REMEMBERED, COUNTED = 150_000, 100_000
#: Chunks of one length from which on a vectorised search is worth its steps.
FEW = 8
#: Lattice cells that one such search holds.
CELLS = 1_000_000
TEXTS, BYTES = 1_000, 3_000_000
ENCODED = (
    "ids array<int>, score double, "
    "alternatives array<struct<score:double,changes:array<struct<start:int,stop:int,ids:array<int>>>>>"
)


@dataclass
class Vocabulary:
    """Pieces of a model as sorted hash arrays of all their prefixes.

    ``hashes`` are sorted; ``ids`` holds the piece of that spelling, or -2 for a mere
    prefix. ``raw`` holds the bytes of every id. Chunks are cut before a space mark that
    follows another character and around characters that occur in no longer piece, where
    no piece can cross; a model with a piece that could gets whole texts as chunks.
    """

    hashes: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    lookup: dict[str, int]
    raw: list[bytes]
    byte_ids: list[int]
    unknown: float
    longest: int
    whole: bool
    model: bytes

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as file:
            model = file.read()
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        every = range(sp.get_piece_size())
        names = [sp.id_to_piece(i) for i in every]
        scores = np.array([sp.get_score(i) for i in every])
        lookup = {
            names[i]: i
            for i in every
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        }
        raw = [n.replace(SPACE, " ").encode() if n in lookup else b"" for n in names]
        byte_ids = [0] * 256
        for i in every:
            if sp.is_byte(i):
                byte_ids[int(names[i][3:5], 16)] = i
                raw[i] = bytes([int(names[i][3:5], 16)])
        prefixes: dict[str, int] = {}
        for name, i in lookup.items():
            for end in range(1, len(name)):
                prefixes.setdefault(name[:end], -2)
            prefixes[name] = i
        keys = list(prefixes)
        hashed = np.array([_hash(k) for k in keys], np.uint64)
        order = np.argsort(hashed)
        if len(np.unique(hashed)) != len(keys):
            raise ValueError("two prefixes share a hash")
        crossing = any(SPACE in n.lstrip(SPACE) or "\n" in n[:-1] + n[1:] for n in lookup)
        return cls(
            hashed[order],
            np.array([prefixes[k] for k in keys])[order],
            scores,
            lookup,
            raw,
            byte_ids,
            float(scores[list(lookup.values())].min()) - 10,
            max(map(len, lookup)),
            crossing,
            model,
        )

    def weighted(self, counts: np.ndarray) -> Vocabulary:
        """The same pieces with the log probabilities that ``counts`` of all ids give them.

        Half an occurrence is added to every piece, so none is impossible.
        """
        pieces = np.array(list(self.lookup.values()))
        held = counts[pieces] + 0.5
        scores = np.zeros(len(self.scores))
        scores[pieces] = np.log(held / held.sum())
        return replace(self, scores=scores, unknown=float(scores[pieces].min()) - 10)


def _hash(text: str) -> int:
    value = 0
    for c in text:
        value = (value * int(PRIME) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return value


def _codes(chunk: str) -> np.ndarray:
    raw = np.frombuffer(chunk.encode("utf-32-le"), np.uint32).astype(np.uint64)
    return np.where(raw == ord(SPACE), LITERAL, np.where(raw == 32, ord(SPACE), raw)).astype(np.uint64)


def best_two(vocab: Vocabulary, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward Viterbi over the lattices of chunks of one length (rows of ``codes``).

    Returns the best score, that of the best other segmentation (-inf if there is none)
    and the best segmentation's ids, right-aligned and filled with -2; -1 stands for a
    character without a piece. Of equal scores the one whose last piece is longer wins.
    """
    rows, size = codes.shape
    longest = min(vocab.longest, size)
    # The piece that ends at a place, by its start: longer ones first; -2 where there is none.
    held = np.full((size + 1, longest, rows), -2, np.int32)
    for start in range(size):
        alive = np.arange(rows)
        value = np.zeros(rows, np.uint64)
        for width in range(1, min(longest, size - start) + 1):
            end = start + width
            value = value * PRIME + codes[alive, end - 1] + np.uint64(1)
            at = np.minimum(np.searchsorted(vocab.hashes, value), len(vocab.hashes) - 1)
            known = vocab.hashes[at] == value
            alive, value = alive[known], value[known]
            held[end, longest - width, alive] = vocab.ids[at[known]]
            if not len(alive):
                break
        held[start + 1, longest - 1][held[start + 1, longest - 1] < 0] = -1
    gains = np.concatenate([vocab.scores, [-np.inf, vocab.unknown]])
    every = np.arange(rows)
    first = np.full((size + 1, rows), -np.inf)
    second = np.full((size + 1, rows), -np.inf)
    step = np.zeros((size + 1, rows), np.int64)
    piece = np.full((size + 1, rows), -2, np.int64)
    first[0] = 0
    for end in range(1, size + 1):
        wide = min(longest, end)
        pieces = held[end, longest - wide :]
        gain = gains[pieces]
        total = first[end - wide : end] + gain
        best = total.argmax(axis=0)
        first[end] = total[best, every]
        total[best, every] = second[end - wide + best, every] + gain[best, every]
        second[end] = total.max(axis=0)
        step[end] = wide - best
        piece[end] = pieces[best, every]
    ids = np.full((rows, size), -2, np.int64)
    at, column = np.full(rows, size), np.full(rows, size)
    while len(every):
        column[every] -= 1
        ids[every, column[every]] = piece[at[every], every]
        at[every] -= step[at[every], every]
        every = every[at[every] > 0]
    return first[size], second[size], ids


def lattice_nbest(vocab: Vocabulary, chunk: str, n: int) -> list[tuple[float, list[int]]]:
    """The ``n`` best segmentations of a chunk: backward A* over its piece lattice.

    The forward Viterbi score of a place is exactly what the rest of a path can still
    gain, so paths leave the queue in the order of their totals. Of equal totals the one
    nearer to the start of the chunk goes first, and no place is left more than ``n``
    times, since its ``n`` best ways to the end are all that ``n`` answers can use: a
    chunk of equal characters, whose paths all tie, takes time in proportion to its length.
    """
    codes = "".join(SPACE if c == " " else "\0" if c == SPACE else c for c in chunk)
    size = len(codes)
    best, into = [0.0] + [-np.inf] * size, [[] for _ in range(size + 1)]
    for start in range(size):
        for end in range(start + 1, min(size, start + vocab.longest) + 1):
            # A literal mark was given the code of NUL above; neither spells a piece.
            i = vocab.lookup.get(codes[start:end], -1)
            if i >= 0 or end == start + 1:
                gain = vocab.scores[i] if i >= 0 else vocab.unknown
                into[end].append((start, i, gain))
                best[end] = max(best[end], best[start] + gain)
    found, left, count = [], [0] * (size + 1), 0
    queue = [(-best[size], size, 0, 0.0, ())]
    while queue and len(found) < n:
        total, at, _, score, path = heapq.heappop(queue)
        if left[at] == n:
            continue
        left[at] += 1
        if at == 0:
            ids = []
            while path:
                ids.append(path[0])
                path = path[1]
            found.append((-total, ids))
            continue
        for start, i, gain in into[at]:
            if left[start] < n:
                count += 1
                step = (score + gain, (i if i >= 0 else ~start, path))
                heapq.heappush(queue, (-(best[start] + step[0]), start, count, *step))
    return [(s, list(_spelled(vocab, chunk, ids))) for s, ids in found]


def _spelled(vocab: Vocabulary, chunk: str, ids: list[int]):
    """Ids with characters without a piece (``~place``) as byte pieces."""
    for i in ids:
        if i >= 0:
            yield i
        else:
            yield from (vocab.byte_ids[b] for b in chunk[~i].encode())


def chunked(vocab: Vocabulary, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different chunks of texts, each with a space before it, the chunks' numbers in
    order, and at which of them each text begins (and the last one ends)."""
    held = [b" " + t.encode() if t else b"" for t in texts]
    rows = np.cumsum([0, *map(len, held)])
    data = b"".join(held)
    raw = np.frombuffer(data, np.uint8)
    if vocab.whole:
        starts = np.zeros(len(raw), bool)
    else:
        space, line = raw == 32, raw == 10
        was_space, was_line = (np.concatenate([[False], x[:-1]]) for x in (space, line))
        starts = (space & ~was_space) | line | (was_line & ~space)
    starts[rows[:-1][np.diff(rows) > 0]] = True
    at = np.append(np.flatnonzero(starts), len(raw))
    parts = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))
    coded = parts.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.searchsorted(at, rows)


def blocks(texts: list[str | None], most: int = TEXTS, chars: int = BYTES) -> Iterator[list[str | None]]:
    """Runs of at most ``most`` texts and, but for single longer ones, ``chars`` characters."""
    block, size = [], 0
    for text in texts:
        if block and (len(block) == most or size + len(text or "") > chars):
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text or "")
    if block:
        yield block


def count_pieces(vocab: Vocabulary, texts: DataFrame) -> np.ndarray:
    """How often the model's own encoder gives each id over all of ``texts`` (one column).

    Tasks count whole chunks and encode each different one once per ``COUNTED`` of them;
    what leaves a task, and what the driver gets, is one number per id. Chunks with a
    literal U+2581, which the encoder would take for a space, are left out. Nulls count
    nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = sentencepiece.SentencePieceProcessor(model_proto=vocab.model)
        lone = sp.piece_to_id(SPACE)
        total = np.zeros(sp.get_piece_size(), np.int64)
        seen: dict[str, int] = {}

        def add() -> None:
            nonlocal total
            times = np.fromiter(seen.values(), np.int64, len(seen))
            # The encoder adds the space that most chunks begin with (but to an empty text);
            # where a chunk has none, the piece for it does not count.
            ids = sp.encode([c.removeprefix(" ") for c in seen], num_threads=1)
            width = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64, width.sum())
            total = total + np.bincount(flat, np.repeat(times, width), len(total)).astype(np.int64)
            total[lone] += seen.get(" ", 0)
            total[lone] -= sum(n for (c, n), i in zip(seen.items(), ids, strict=True) if c[0] != " " and i[:1] == [lone])
            seen.clear()

        for batch in batches:
            for block in blocks(batch.column(0).to_pylist()):
                chunks, places, _ = chunked(vocab, block)
                for chunk, n in zip(chunks, np.bincount(places, minlength=len(chunks)).tolist(), strict=True):
                    if SPACE not in chunk:
                        seen[chunk] = seen.get(chunk, 0) + n
                if len(seen) > COUNTED:
                    add()
        add()
        got = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(got), pa.array(total[got])], names=["id", "n"])

    counts = np.zeros(len(vocab.scores), np.int64)
    for row in texts.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    return counts


@dataclass
class Encoder:
    """Encodes batches of texts; remembers chunks, which repeat within a batch."""

    vocab: Vocabulary
    n_best: int
    places: dict[str, int] = field(default_factory=dict)
    runs: list[np.ndarray] = field(default_factory=list)
    score: list[np.ndarray] = field(default_factory=list)
    gap: list[np.ndarray] = field(default_factory=list)
    sizes: list[np.ndarray] = field(default_factory=list)
    nbest: dict[str, list[tuple[float, list[int]]]] = field(default_factory=dict)

    def learn(self, chunks: list[str]) -> None:
        """Find the best segmentations of new chunks, all of one length at a time."""
        by_size: dict[int, list[str]] = {}
        for chunk in chunks:
            by_size.setdefault(len(chunk), []).append(chunk)
        for size, same in by_size.items():
            if len(same) < FEW:
                self._learn_few(same)
                continue
            for at in range(0, len(same), block := max(1, CELLS // (size + 1) // min(size, self.vocab.longest))):
                self._learn(same[at : at + block], size)

    def _learn(self, chunks: list[str], size: int) -> None:
        codes = _codes("".join(chunks)).reshape(-1, size)
        first, second, ids = best_two(self.vocab, codes)
        for chunk in chunks:
            self.places[chunk] = len(self.places)
        plain = ids >= 0
        rows = np.flatnonzero((ids == -1).any(axis=1))
        sizes = plain.sum(axis=1)
        if len(rows):
            held = [r[p] for r, p in zip(ids, plain, strict=True)]
            for r in rows.tolist():
                held[r] = np.array(self._with_bytes(chunks[r], ids[r]), np.int64)
            sizes = np.array([len(h) for h in held])
            flat = np.concatenate(held)
        else:
            flat = ids[plain]
        self.runs.append(flat.astype(np.int32))
        self.sizes.append(sizes)
        self.score.append(first)
        self.gap.append(first - second)

    def _learn_few(self, chunks: list[str]) -> None:
        """The same by the search itself: of a chunk alone, each step of an array costs more."""
        for chunk in chunks:
            found = self.nbest_of(chunk)
            self.places[chunk] = len(self.places)
            self.runs.append(np.array(found[0][1], np.int32))
            self.sizes.append(np.array([len(found[0][1])]))
            self.score.append(np.array([found[0][0]]))
            self.gap.append(np.array([found[0][0] - found[1][0] if len(found) > 1 else np.inf]))

    def _with_bytes(self, chunk: str, ids: np.ndarray) -> list[int]:
        out, at = [], 0
        for i in ids[ids > -2].tolist():
            if i >= 0:
                out.append(i)
                at += len(self.vocab.raw[i].decode())
            else:
                out += [self.vocab.byte_ids[b] for b in chunk[at].encode()]
                at += 1
        return out

    def encode(self, texts: list[str | None]) -> pa.RecordBatch:
        """A row of ``ENCODED`` per text; nulls for a null text, no ids for an empty one."""
        if len(self.places) > REMEMBERED:
            self.__init__(self.vocab, self.n_best)
        chunks, numbers, rows = chunked(self.vocab, texts)
        self.learn(sorted(c for c in chunks if c not in self.places))
        for name in ("runs", "score", "gap", "sizes"):
            held = getattr(self, name)
            setattr(self, name, [np.concatenate(held)] if held else [])
        if not self.places:
            flat = np.empty(0, np.int32)
            score = gap = np.empty(0)
            sizes = np.empty(0, np.int64)
        else:
            flat, score, gap, sizes = self.runs[0], self.score[0], self.gap[0], self.sizes[0]
        begins = np.cumsum(sizes) - sizes
        every = np.fromiter(map(self.places.__getitem__, chunks), np.int64, len(chunks))[numbers]
        width = sizes[every]
        stops = np.cumsum(width)
        within = np.arange(width.sum()) - np.repeat(stops - width, width)
        values = flat[np.repeat(begins[every], width) + within]
        offsets = np.concatenate([[0], stops])[rows]
        scores, others = [], []
        for text, a, b, base in zip(texts, rows[:-1], rows[1:], offsets, strict=False):
            at = every[a:b]
            scores.append(None if text is None else float(score[at].sum()))
            parts = (chunks, numbers[a:b])
            starts = stops[a:b] - width[a:b] - base
            others.append(None if text is None else self.others(parts, at, starts, scores[-1], gap, width[a:b]))
        ids = pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()),
            pa.array(values),
            mask=pa.array([t is None for t in texts]) if texts else None,
        )
        change = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("ids", pa.list_(pa.int32()))])
        other = pa.list_(pa.struct([("score", pa.float64()), ("changes", pa.list_(change))]))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(scores, pa.float64()), pa.array(others, other)],
            names=["ids", "score", "alternatives"],
        )

    def others(self, parts, at, starts, total, gap, width) -> list[dict]:
        """The next best segmentations of a text, as changes to the best one.

        A text's lattice is a chain of its chunks' lattices. The best ``n`` differ from
        the first only in the ``n - 1`` chunks with the smallest loss for a second choice
        (the earlier of equal ones): whatever changes another chunk is no better than
        changing one of those instead. Those chunks' own best lists come from the A*
        search and are merged by total score.
        """
        if self.n_best < 2 or not len(at):
            return []
        loss = gap[at]
        order = np.arange(len(loss))
        if len(loss) > self.n_best:
            limit = np.partition(loss, self.n_best - 2)[self.n_best - 2]
            order = np.flatnonzero(loss <= limit)
        order = order[np.argsort(loss[order], kind="stable")][: self.n_best - 1]
        chunks, numbers = parts
        choices = [(int(o), self.nbest_of(chunks[numbers[o]])) for o in order if np.isfinite(loss[o])]
        seen = {(0,) * len(choices)}
        queue, found = [(0.0, (0,) * len(choices))], []
        while queue and len(found) < self.n_best:
            lost, taken = heapq.heappop(queue)
            found.append((lost, taken))
            for k, (_, options) in enumerate(choices):
                if taken[k] + 1 < len(options):
                    more = taken[:k] + (taken[k] + 1,) + taken[k + 1 :]
                    if more not in seen:
                        seen.add(more)
                        gain = options[taken[k]][0] - options[taken[k] + 1][0]
                        heapq.heappush(queue, (lost + gain, more))
        out = []
        for lost, taken in found[1:]:
            changes = [
                {"start": int(starts[o]), "stop": int(starts[o] + width[o]), "ids": options[t][1]}
                for (o, options), t in zip(choices, taken, strict=True)
                if t
            ]
            changes.sort(key=lambda c: c["start"])
            out.append({"score": total - lost, "changes": changes})
        return out

    def nbest_of(self, chunk: str) -> list[tuple[float, list[int]]]:
        if chunk not in self.nbest:
            found = lattice_nbest(self.vocab, chunk, max(2, self.n_best))
            if len(self.nbest) > REMEMBERED:
                self.nbest.clear()
            self.nbest[chunk] = found
        return self.nbest[chunk]


def spelled_texts(raw: pa.Array, ids: pa.Array) -> list[str | None]:
    """The texts that lists of ids spell; ``raw`` holds the bytes of every id."""
    # Bytes of ids taken one after the other lie one after the other.
    taken = raw.take(ids.flatten())
    ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)
    data = memoryview(taken.buffers()[2] or b"")
    sizes = np.nan_to_num(ids.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    rows = ends[np.concatenate([[0], np.cumsum(sizes)])].tolist()
    return [
        None if null else str(data[a:b], "utf-8", "replace").removeprefix(" ")
        for a, b, null in zip(rows[:-1], rows[1:], ids.is_null().to_pylist(), strict=True)
    ]


def encoded(vocab: Vocabulary, text: Column, n_best: int = 4, verify: bool = False) -> Column:
    """Struct ``ids``, ``score`` and ``alternatives`` (``ENCODED``) of a whole text.

    The text is taken as it is (no normalisation) with a space put before it, as the
    model's format has it. ``ids`` is the segmentation of the highest score; a character
    without a piece is spelled in byte pieces and scores 10 below the lowest piece.
    ``alternatives`` are the next best ``n_best - 1`` (fewer if there are no more), each
    as changes: spans of ``ids`` to replace. Of equal scores any may come first, the same
    on every run. Null gives null, an empty text no ids. A text takes time and memory in
    proportion to its length, also one that is a single word or repeats one character.

    ``verify`` adds ``round_trip``: whether the ids, decoded again, give the text.
    """
    kind = ENCODED.replace(" array<", ":array<").replace("score double", "score:double")

    @F.arrow_udf(f"struct<{kind}{',round_trip:boolean' if verify else ''}>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocab, n_best)
        raw = pa.array(vocab.raw, pa.large_binary())
        for batch in batches:
            held = []
            for block in blocks(batch.to_pylist()) if len(batch) else [[]]:
                rows = encoder.encode(block)
                if verify:
                    same = [a == b for a, b in zip(block, spelled_texts(raw, rows.column(0)), strict=True)]
                    rows = rows.append_column("round_trip", pa.array(same, pa.bool_()))
                held.append(rows.to_struct_array())
            yield pa.concat_arrays(held)

    return encode(text)


def decoded(vocab: Vocabulary, ids: Column) -> Column:
    """The text of an array of ids: the inverse of ``encoded``; null gives null."""
    held = vocab.raw

    @F.arrow_udf("string")
    def decode(batch: pa.Array) -> pa.Array:
        return pa.array(spelled_texts(pa.array(held, pa.large_binary()), batch), pa.string())

    return decode(ids)

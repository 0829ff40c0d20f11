"""Alignment of two tokenizers over the same bytes: groups by pointer jumping."""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.llm.common import staged
from lookback.llm.pieces import SPACE, blocks

#: Chunks remembered by a task before it starts afresh, learned at once, encoded as one text.
REMEMBERED, LEARNED, JOINED = 60_000, 10_000, 100
#: Texts and characters aligned at once.
TEXTS, CHARS = 300, 1_000_000
LINKS = "array<struct<a:int,b:int,n:int>>"


def successor_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terminal token of every token of A and of B, as a place in B.

    Both cut the same bytes; ``ends`` are the tokens' last offsets, rising. A token points
    to the token of the other side that covers its last byte, which of all tokens that
    overlap it reaches farthest right; of two that end together the one of B is last and
    points to itself. Successors are doubled until none changes: after k steps a token
    knows what lies 2^k tokens on, so a group of m tokens takes log2(m) of them.
    """
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)
    over_b = np.searchsorted(ends_a, ends_b)
    alone = ends_a[over_b] == ends_b
    point = np.concatenate([n + over_a, np.where(alone, n + np.arange(len(ends_b)), over_b)])
    while True:
        after = point[point]
        if np.array_equal(after, point):
            break
        point = after
    return point[:n] - n, point[n:] - n


@dataclass(frozen=True)
class TokenizerPair:
    """A byte-level BPE (``a``: file of the tokenizers library) and a piece model (``b``).

    What is held are the files' contents, so executors need no copy of them.
    """

    a_json: str
    b_model: bytes

    @classmethod
    def load(cls, a_path: str, b_path: str) -> TokenizerPair:
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read())

    def __reduce__(self):
        # What is opened from the contents stays here: a tokenizer loses settings on its way.
        return TokenizerPair, (self.a_json, self.b_model)

    @cached_property
    def a(self) -> tokenizers.Tokenizer:
        # Spark gives a task one core; threads beside it also keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = tokenizers.Tokenizer.from_str(self.a_json)
        tokenizer.encode_special_tokens = True
        return tokenizer

    @cached_property
    def b(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.b_model)

    @cached_property
    def a_bytes(self) -> list[bytes]:
        """Bytes of A's tokens: byte-level spelling has a printable character per byte."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        held = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            held[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        return held

    @cached_property
    def b_bytes(self) -> list[bytes]:
        """Bytes of B's pieces: the space mark as a space, byte pieces as their byte."""
        held = []
        for i in range(self.b.get_piece_size()):
            name = self.b.id_to_piece(i)
            held.append(bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace(SPACE, " ").encode())
        return held

    @cached_property
    def crossing(self) -> bool:
        """Whether a piece of B holds a space after another character."""
        return any(SPACE in self.b.id_to_piece(i).lstrip(SPACE) for i in range(self.b.get_piece_size()))


def _back(mask: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([np.zeros(min(by, len(mask)), bool), mask[: max(0, len(mask) - by)]])


def solid(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks UTF-8 bytes at which a character begins, and ends, that is surely no white
    space: ASCII above the space, and those of lead bytes under which Unicode has none."""
    plain = (raw > 32) & (raw < 127)
    two = (raw >= 0xC3) & (raw <= 0xDF)
    three = (raw == 0xE0) | ((raw >= 0xE4) & (raw <= 0xEF))
    tail = (raw >= 0x80) & (raw < 0xC0)
    return plain | two | three, plain | (tail & _back(two, 1)) | (tail & _back(tail, 1) & _back(three, 2))


def cut_places(raw: np.ndarray) -> np.ndarray:
    """Marks spaces of UTF-8 bytes before which both tokenizers cut whatever is around.

    A single space between two characters that are no white space: A's pre-tokens run over
    no such place, and no piece of B holds a space after another character.
    """
    begins, ends = solid(raw)
    return (raw == 32) & _back(ends, 1) & np.append(begins[1:], False)[: len(raw)]


def _array(data, offsets: np.ndarray) -> pa.Array:
    offsets = np.ascontiguousarray(offsets, np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _parts(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an array just taken or built, and their offsets."""
    return np.frombuffer(values.buffers()[2] or b"", np.uint8), np.frombuffer(values.buffers()[1], np.int64, len(values) + 1)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(itertools.chain.from_iterable(ids), np.int64, size.sum()), size


@dataclass
class Aligner:
    """Aligns blocks of texts; remembers chunks between cuts, which repeat.

    ``sizes`` holds, per chunk, the number of tokens of A and B, of groups (also links),
    and of bytes of the groups' spelling; all 0 for a chunk whose tokens do not spell it,
    which ``whole`` tells.
    """

    pair: TokenizerPair
    places: dict[bytes, int] = field(default_factory=dict)
    sizes: np.ndarray = field(default_factory=lambda: np.zeros((0, 4), np.int64))
    whole: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    spelled: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint8))
    links: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __post_init__(self) -> None:
        width = max(len(self.pair.a_bytes), len(self.pair.b_bytes))
        self.numbers = pa.array([f"{i}{sign}" for sign in ",|;" for i in range(width)], pa.large_binary())
        self.a_raw, self.b_raw = (pa.array(x, pa.large_binary()) for x in (self.pair.a_bytes, self.pair.b_bytes))

    def learn(self, chunks: pa.Array) -> None:
        """Align new chunks. Those that begin and end as cuts need are encoded joined."""
        raw, at = _parts(chunks)
        begins, ends = solid(raw)
        mark = (raw == 0xE2) & np.append(raw[1:] == 0x96, False) & np.append(raw[2:] == 0x81, [False, False])[: len(raw)]
        marks = np.concatenate([[0], np.cumsum(mark)])
        second = np.minimum(at[:-1] + 1, len(raw) - 1)
        easy = (np.diff(at) > 1) & begins[second] & ends[at[1:] - 1] & (np.diff(marks[at]) == 0) & (not self.pair.crossing)
        for which, joined in ((np.flatnonzero(easy), JOINED), (np.flatnonzero(~easy), 1)):
            for i in range(0, len(which), LEARNED):
                self._learn(chunks.take(pa.array(which[i : i + LEARNED])), joined)

    def _learn(self, chunks: pa.Array, joined: int) -> None:
        raw, at = _parts(chunks)
        data = raw.tobytes()
        cuts = at[np.append(np.arange(0, len(chunks), joined), len(chunks))]
        texts = [data[x:y].decode() for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        a, size_a = _flat([e.ids for e in self.pair.a.encode_batch_fast(texts, add_special_tokens=False)])
        b, size_b = _flat(self.pair.b.encode([t[1:] for t in texts], num_threads=1))
        whole = np.ones(len(chunks), bool)
        raw_a, raw_b = self.a_raw.take(pa.array(a)), self.b_raw.take(pa.array(b))
        if _parts(raw_a)[0].tobytes() != data or _parts(raw_b)[0].tobytes() != data:
            if joined > 1:
                self._learn(chunks, 1)
                return
            spelled = zip(_joined(raw_a, size_a), _joined(raw_b, size_b), _joined(chunks, np.ones(len(chunks), int)), strict=True)
            whole = np.array([x == c and y == c for x, y, c in spelled])
            a, b = a[np.repeat(whole, size_a)], b[np.repeat(whole, size_b)]
            at = np.concatenate([[0], np.cumsum(np.where(whole, np.diff(at), 0))])
        ends_a, ends_b = (np.cumsum(np.diff(_parts(r.take(pa.array(i)))[1])) for r, i in ((self.a_raw, a), (self.b_raw, b)))
        last_a, last_b = successor_ends(ends_a, ends_b) if len(a) else (a, b)
        terminal = np.flatnonzero(last_b == np.arange(len(b)))
        linked = np.searchsorted(ends_a, ends_b[terminal])
        # A group's tokens of A, then those of B: each token moves on by what lies before.
        group_a, group_b = np.searchsorted(terminal, last_a), np.searchsorted(terminal, last_b)
        at_a = np.arange(len(a)) + np.concatenate([[0], terminal + 1])[group_a]
        at_b = np.arange(len(b)) + linked[group_b] + 1
        width = len(self.numbers) // 3
        coded = np.zeros(len(a) + len(b), np.int64)
        coded[at_a] = a + width * (np.arange(len(a)) == linked[group_a])
        coded[at_b] = b + 2 * width * (np.arange(len(b)) == terminal[group_b])
        text, offsets = _parts(self.numbers.take(pa.array(coded)))
        # Both cut at the chunks' ends, so counts up to there tell a chunk's share.
        upto_a, upto_b = (np.searchsorted(e, at, "right") for e in (ends_a, ends_b))
        groups = np.searchsorted(terminal, upto_b)
        upto = np.column_stack([upto_a, upto_b, groups, offsets[upto_a + upto_b]])
        for chunk in chunks.to_pylist():
            self.places[chunk] = len(self.places)
        self.spelled = np.concatenate([self.spelled, text])
        self.whole = np.concatenate([self.whole, whole])
        self.sizes = np.concatenate([self.sizes, np.diff(upto, axis=0)])
        self.links = np.concatenate([self.links, a[linked] << 32 | b[terminal]])

    def align(self, texts: list[str | None]) -> pa.RecordBatch:
        """``n_a``, ``n_b``, ``n_groups``, ``groups`` and ``links`` of each text."""
        if len(self.places) > REMEMBERED:
            self.__init__(self.pair)
        held = [b" " + t.encode() if t else b"" for t in texts]
        rows = np.cumsum([0, *map(len, held)])
        data = b"".join(held)
        raw = np.frombuffer(data, np.uint8)
        starts = np.zeros(len(raw), bool) if self.pair.crossing else cut_places(raw)
        starts[rows[:-1][np.diff(rows) > 0]] = True
        at = np.append(np.flatnonzero(starts), len(raw))
        coded = _array(data, at).dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        if new := [i for i, c in enumerate(chunks) if c not in self.places]:
            self.learn(coded.dictionary.take(pa.array(new)))
        every = np.fromiter(map(self.places.__getitem__, chunks), np.int64, len(chunks))[coded.indices.to_numpy()]
        first = np.searchsorted(at, rows)
        wrong = np.concatenate([[0], np.cumsum(~self.whole[every])])
        whole = np.diff(wrong[first]) == 0
        keep = np.repeat(whole, np.diff(first))
        every, row = every[keep], np.repeat(np.arange(len(texts)), np.diff(first))[keep]
        sums = np.zeros((len(texts), 4), np.int64)
        for s in range(4):
            sums[:, s] = np.bincount(row, self.sizes[every, s], len(texts)).astype(np.int64)
        spelled = _array(self.spelled, np.concatenate([[0], np.cumsum(self.sizes[:, 3])]))
        counts = np.bincount(row, minlength=len(texts))
        groups = [g[:-1].decode() for g in _joined(spelled.take(pa.array(every)), counts)]
        offsets, a, b, n = self._links(row, every, len(texts))
        ints = lambda x: pa.array(x.astype(np.int32), pa.int32())
        links = pa.StructArray.from_arrays([ints(a), ints(b), ints(n)], names=["a", "b", "n"])
        return pa.RecordBatch.from_arrays(
            [*(pa.array(sums[:, s]) for s in range(3)), pa.array(groups, pa.string()), pa.ListArray.from_arrays(ints(offsets), links)],
            names=["n_a", "n_b", "n_groups", "groups", "links"],
        )

    def _links(self, row: np.ndarray, every: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        """Different links of each text with their numbers: offsets by text, A, B, number."""
        size = self.sizes[every, 2]
        stops = np.cumsum(size)
        begins = np.cumsum(self.sizes[:, 2]) - self.sizes[:, 2]
        at = np.repeat(begins[every] - stops + size, size) + np.arange(stops[-1] if len(stops) else 0)
        pairs, number = np.unique(self.links, return_inverse=True)
        many = max(1, len(pairs))
        both, times = np.unique(np.repeat(row, size) * many + number[at], return_counts=True)
        pair = pairs[both % many]
        offsets = np.searchsorted(both, np.arange(n + 1) * many)
        return offsets, pair >> 32, pair & 0xFFFFFFFF, times


def _joined(values: pa.Array, sizes: np.ndarray) -> Iterator[bytes]:
    """Runs of ``sizes`` values, joined: values just taken lie one after the other."""
    raw, offsets = _parts(values)
    ends = offsets[np.concatenate([[0], np.cumsum(sizes)])].tolist()
    data = memoryview(raw)
    return (bytes(data[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True))


def aligned(docs: DataFrame, pair: TokenizerPair, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of tokens of two tokenizers over every whole text.

    Both encode a space and the text, without special tokens. Offsets where tokens of both
    end cut them into groups. Returns ``id_col``, ``n_a``, ``n_b``, ``n_groups``,
    ``groups`` (``a1,a2|b1;a3|b2,b3``: ids in order) and ``links``: the different pairs of
    tokens that end together, with how often they do in the text.

    Texts that are null or empty, or that the tokens of either side do not spell (such as
    those with a literal U+2581), have no tokens. Rows with a null or repeated id stay
    rows of their own; other columns are not read. No rows give no rows. A long text is
    cut where both tokenizers cut anyway, and only different chunks are encoded.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(pair)
        for batch in batches:
            done = 0
            for block in blocks(batch.column(1).to_pylist(), TEXTS, CHARS):
                got = aligner.align(block)
                ids = batch.column(0).slice(done, len(block))
                yield pa.RecordBatch.from_arrays([ids, *got.columns], names=["id", *got.schema.names])
                done += len(block)

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    got = rows.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, groups string, links {LINKS}")
    return got.withColumnRenamed("id", id_col)


def link_counts(links: DataFrame) -> DataFrame:
    """Corpus-wide count ``c`` of each pair ``a``, ``b`` and whether it is its ``b``'s highest.

    ``links`` has one column with an array of (a, b, n). Pairs are added up before the
    shuffle; the highest counts are one row per id of B, of which a vocabulary has few.
    """
    pairs = links.select(F.inline(links.columns[0])).groupBy("a", "b").agg(F.sum("n").alias("c"))
    pairs = staged(pairs, "align-pairs")
    top = pairs.groupBy("b").agg(F.max("c").alias("top")).withColumnRenamed("b", "of")
    return pairs.join(top, F.col("b") == F.col("of")).select("a", "b", "c", (F.col("c") == F.col("top")).alias("best"))


def alignment_table(docs: DataFrame, pair: TokenizerPair, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: sizes, a digest of the groups, and how usual its links are.

    ``n_links`` counts its links, ``n_best`` those whose pair is as frequent in the corpus
    as any of its B id, ``count_sum`` adds up the pairs' counts over the links. The digest
    is '' for a text without tokens.
    """
    digest = F.when(F.col("n_a") + F.col("n_b") > 0, F.sha2("groups", 256)).otherwise("")
    own = aligned(docs, pair, id_col=id_col, text_col=text_col).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), "n_a", "n_b", "n_groups",
        digest.alias("groups_sha256"), "links",
    )
    own = staged(own, "align-rows", compression="zstd")
    counts = staged(link_counts(own.select("links")), "align-counts")
    links = own.select("row", F.inline("links"))
    known = links.join(counts, ["a", "b"])
    sums = known.groupBy("row").agg(
        F.sum("n").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("c")).alias("count_sum"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (
        own.drop("links")
        .join(sums, "row", "left")
        .select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", zero("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")
    )

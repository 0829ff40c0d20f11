import itertools
import os
import random
import time
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from lookback.llm.pieces import SPACE, Encoder, Vocabulary, chunked, count_pieces, decoded, encoded, lattice_nbest
from lookback.llm.registry import piece_model_path

pytestmark = pytest.mark.skipif(not os.path.exists(piece_model_path()), reason="no piece model here")


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary.load(piece_model_path())


def every_segmentation(vocab, text, before=" "):
    whole = before + text
    codes = "".join(SPACE if c == " " else "\0" if c == SPACE else c for c in whole)
    found = []

    def walk(at, score, ids):
        if at == len(codes):
            found.append((score, ids))
            return
        for end in range(at + 1, min(len(codes), at + vocab.longest) + 1):
            i = vocab.lookup.get(codes[at:end], -1)
            if i >= 0:
                walk(end, score + vocab.scores[i], [*ids, i])
            elif end == at + 1:
                raw = [vocab.byte_ids[b] for b in whole[at].encode()]
                walk(end, score + vocab.unknown, ids + raw)

    walk(0, 0.0, [])
    return sorted(found, key=lambda f: -f[0])


def applied(row, other):
    ids = list(row["ids"])
    for change in reversed(other["changes"]):
        ids[change["start"] : change["stop"]] = change["ids"]
    return ids


def test_n_best_equals_all_segmentations(vocab):
    rng = random.Random(1)
    parts = ["thest", " of", "  x", "\n", " ▁é", " 日本", "öheit", " the", " a", "zz", "\x00", "\U0001f600"]
    encoder = Encoder(vocab, 4)
    for _ in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 4)))
        row, null, empty = encoder.encode([text, None, ""]).to_pylist()
        assert null["ids"] is None and empty["ids"] == [] and empty["score"] == 0
        if not text:
            continue
        want = every_segmentation(vocab, text)
        scores = [row["score"], *(o["score"] for o in row["alternatives"])]
        assert scores == [s for s, _ in want[:4]]
        for other in row["alternatives"]:
            assert (other["score"], applied(row, other)) in want
        found = {tuple(applied(row, o)) for o in row["alternatives"]} | {tuple(row["ids"])}
        assert len(found) == len(scores)


def test_equal_characters_end_soon(vocab):
    began = time.monotonic()
    for weights in (vocab, vocab.weighted(np.zeros(len(vocab.scores)))):
        row = Encoder(weights, 4).encode(["x" * 50_000]).to_pylist()[0]
        assert len(row["alternatives"]) == 3
    assert time.monotonic() - began < 60
    # Ties searched to the end: as many as there are, each once.
    for size in range(1, 9):
        got = lattice_nbest(vocab, "x" * size, 5)
        ways = sorted((s for s, _ in every_segmentation(vocab, "x" * size, "")), reverse=True)
        assert [s for s, _ in got] == ways[:5] and len({tuple(i) for _, i in got}) == len(got)


def test_counts_equal_the_encoder(spark, vocab, edge_docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    plain = edge_docs.where("NOT contains(text, '\u2581') OR text IS NULL").select("text")
    want = Counter()
    for (text,) in plain.collect():
        want.update(sp.encode(text) if text else [])
    got = count_pieces(vocab, plain)
    assert {i: n for i, n in enumerate(got.tolist()) if n} == want
    weighted = vocab.weighted(got)
    pieces = list(vocab.lookup.values())
    assert abs(np.exp(weighted.scores[pieces]).sum() - 1) < 1e-9
    assert weighted.unknown < weighted.scores[pieces].min()


def test_weights_bring_fewer_pieces_than_ranks(spark, vocab):
    docs = spark.createDataFrame([("the quick brown fox and the slow one " * 20,)], "text string")
    weighted = vocab.weighted(count_pieces(vocab, docs))
    ids = [Encoder(v, 1).encode(["the quick brown"]).to_pylist()[0]["ids"] for v in (weighted, vocab)]
    assert [vocab.raw[i] for i in ids[0]] == [b" the", b" quick", b" brown"]
    assert len(ids[0]) < len(ids[1])


def test_search_returns_paths_in_order_of_score(vocab):
    for chunk in (" nation", "  a", " ▁x", "é"):
        got = lattice_nbest(vocab, chunk, 6)
        assert [s for s, _ in got] == sorted((s for s, _ in got), reverse=True)
        want = every_segmentation(vocab, chunk[1:]) if chunk[0] == " " else None
        if want:
            assert [s for s, _ in got] == [s for s, _ in want[:6]]


def test_no_piece_crosses_a_cut(vocab):
    assert not vocab.whole
    whole = Vocabulary(**{**vocab.__dict__, "whole": True})
    for text in ("a  b\nc", "two words", "\n\n x ", "Bar.\nBaz"):
        chunks, numbers, rows = chunked(vocab, [text, "", text])
        assert "".join(chunks[n] for n in numbers[: rows[1]]) == " " + text and rows[1] == rows[2]
        assert chunked(whole, [text])[0] == [" " + text]
        a, b = (Encoder(v, 1).encode([text]).to_pylist()[0] for v in (vocab, whole))
        assert a["score"] == b["score"]


def test_round_trip_of_edge_texts(edge_docs, no_docs, vocab):
    for docs in (edge_docs, no_docs):
        got = docs.select("text", encoded(vocab, F.col("text")).alias("e"))
        got = got.withColumn("back", decoded(vocab, F.col("e.ids")))
        assert got.where("NOT (back <=> text)").count() == 0
        assert got.count() == docs.count()


def test_forgetting_chunks_changes_nothing(vocab, monkeypatch):
    texts = [" ".join(p) for p in itertools.permutations(["the", "nation", "of", "öheit"], 3)]
    once = Encoder(vocab, 3).encode(texts).to_pylist()
    monkeypatch.setattr("lookback.llm.pieces.REMEMBERED", 1)
    encoder = Encoder(vocab, 3)
    again = [row for t in texts for row in encoder.encode([t]).to_pylist()]
    assert [r["ids"] for r in once] == [r["ids"] for r in again]
    assert [[o["score"] for o in r["alternatives"]] for r in once] == [
        [o["score"] for o in r["alternatives"]] for r in again
    ]

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from lookback.llm.recurrent import (
    END,
    MEMBERS,
    Network,
    Vocabulary,
    encode,
    packed,
    score_documents,
    word_counts,
    word_hashes,
)


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def check_base(docs, got):
    counts, want = Counter(), Counter()
    rows = [(r.doc_id, (r.text or "").encode().lower().split() + [None]) for r in docs.collect()]
    for i, words in rows:
        if not held(i):
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    for i, words in rows:
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        want[str(i), held(i), len(words), sum(counts[w] > 0 for w in words), n, round(base, 4)] += 1
    found = Counter(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got
    )
    assert found == want


def test_base_scores_and_edge_rows(edge_docs, no_docs):
    got = score_documents(edge_docs, head_words=64, streams=8).collect()
    check_base(edge_docs, got)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert score_documents(no_docs).count() == 0


def test_all_rows_held_out(spark):
    ids = [i for i in range(60) if held(i)]
    docs = spark.createDataFrame([(i, "a b c") for i in ids], "doc_id long, text string")
    got = score_documents(docs, head_words=32).collect()
    check_base(docs, got)
    assert len(got) == len(ids) and all(math.isfinite(r.score) for r in got)


def test_model_beats_the_counts_on_held_out_texts(spark):
    rows = [(i, "red blue green " * (4 + i % 5) + f"w{i % 90}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = score_documents(docs, head_words=32, streams=8, rate=0.02, least=64).collect()
    out = [r for r in got if r.held_out]
    assert out and sum(r.score for r in out) > 0.9 * sum(r.base_score for r in out)


@pytest.fixture(scope="module")
def network():
    vocab = Vocabulary({END: 0}, np.arange(70, 0, -1.0), np.full((10, 2), 5.0), 1000, 100)
    net = Network.start(vocab, 4, 0)
    return Network({k: v.astype(np.float64) for k, v in net.p.items()})


def test_gradients_equal_differences(network):
    rng = np.random.default_rng(1)
    ids, target = rng.integers(-1, 80, (5, 3)), rng.integers(0, 70, (5, 3))
    target[4, 2], target[2, 1], target[0, 0] = -1, 3 * MEMBERS + 3, 3 * MEMBERS + 9
    start = rng.normal(size=(3, 4))

    def loss():
        out, _ = network.states(ids, start)
        return -network.losses(out.reshape(-1, 4), target.ravel()).sum() / (target >= 0).sum()

    grad, _ = network.window(ids, target, start)
    for name, weights in network.p.items():
        at = np.unravel_index(np.abs(grad[name]).argmax(), weights.shape)
        weights[at] += 1e-6
        up = loss()
        weights[at] -= 2e-6
        down = loss()
        weights[at] += 1e-6
        assert grad[name][at] == pytest.approx((up - down) / 2e-6, rel=1e-4)


def test_state_carried_over_windows_is_one_long_window(network):
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 80, n).astype(np.int16) for n in (40, 3, 17, 1)]
    target, before, owner = packed(docs, 2)
    assert sorted(np.bincount(owner[target >= 0])) == [1, 3, 17, 40]
    whole, _ = network.states(before.astype(np.int64), np.zeros((2, 4)))
    h, parts = np.zeros((2, 4)), []
    for at in range(0, len(target), 7):
        out, h = network.states(before[at : at + 7].astype(np.int64), h)
        parts.append(out)
    assert np.allclose(whole, np.concatenate(parts))


def test_class_and_member_probabilities_sum_to_one(network):
    h = np.random.default_rng(3).normal(size=(1, 4))
    codes = np.arange(3 * MEMBERS + 10)
    lp = network.losses(np.repeat(h, len(codes), 0), codes)
    assert np.exp(lp).sum() == pytest.approx(1)


@pytest.mark.parametrize("padding", [False, True])
def test_losses_equal_a_plain_softmax_of_each_token(network, padding):
    rng = np.random.default_rng(4)
    h, target = rng.normal(size=(50, 4)), rng.integers(0, 70, 50)
    target[:10] = 3 * MEMBERS + np.arange(10)
    if padding:
        target[20:30] = -1
    p, first = network.p, 3 * MEMBERS
    for state, code, lp in zip(h, target, network.losses(h, target), strict=True):
        group = code // MEMBERS if code < first else code - first + 3
        score = np.exp(state @ p["c"] + p["cb"])
        want = math.log(score[group] / score.sum()) if code >= 0 else 0
        if 0 <= code < first:
            inner = np.exp(p["o"][group] @ state + p["ob"][group])
            want += math.log(inner[code % MEMBERS] / inner.sum())
        assert lp == pytest.approx(want)


def zipf_docs(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"W{w}," if w % 7 == 0 else f"w{w}" for w in rng.zipf(1.3, 60) % 900)) for i in range(120)]
    return spark.createDataFrame([*rows, (None, None), (120, ""), (7, rows[7][1])], "doc_id long, text string")


def test_listed_words_change_no_score(spark):
    docs = zipf_docs(spark).coalesce(1)
    ways = []
    for listed in (0, 60, 1 << 17):
        got = score_documents(docs, head_words=32, listed_words=listed, streams=8).collect()
        check_base(docs, got)
        ways.append(sorted(got, key=lambda r: (str(r.doc_id), r.score)))
    for a, b, c in zip(*ways, strict=True):
        assert a[:5] == b[:5] == c[:5]
        assert a.score == pytest.approx(b.score, rel=1e-12) == pytest.approx(c.score, rel=1e-12)


def test_only_words_not_listed_are_looked_up(spark):
    rows = zipf_docs(spark).selectExpr("doc_id AS row", "doc_id AS id", "false AS held_out", "CAST(text AS BINARY) AS text")
    counts = word_counts(rows)
    words = Counter(w for r in rows.collect() for w in [*bytes(r.text or b"").lower().split(), b""])
    of = dict(zip(word_hashes(words).tolist(), words.values(), strict=True))
    tail = sum(words.values())
    for listed in (0, 1, 60, 1 << 17):
        vocab = Vocabulary.of(counts, 32, listed)
        assert len(vocab.listed) <= listed and vocab.listed.tolist() == sorted(vocab.listed.tolist())
        assert [of[h] for h in vocab.listed.tolist()] == vocab.often.tolist()
        known = {*vocab.listed.tolist(), *vocab.head}
        left = Counter()
        for r in encode(rows, vocab).collect():
            left.update(dict(zip(r.words, r.ns, strict=True)))
        assert left == {h: n for h, n in of.items() if h not in known}
        assert sum(left.values()) <= tail
        tail = sum(left.values())
    assert not left

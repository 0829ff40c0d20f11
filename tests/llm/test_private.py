import itertools
import random
import re
import time
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lookback.llm import private
from lookback.llm.private import (
    LEGAL, START, TAGS, WINDOW, Tagger, base_spans, char_codes, crf_slopes, fit, holds, luhn, model_spans,
    private_spans, read_spans, spans_of, spelled, tags_of, train, viterbi, with_added,
)


def by_pattern(text):
    """The contract's patterns as they stand."""
    size = lambda m: len(re.sub("[^0-9]", "", m.group()))
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [("ip", *m.span())] if all(int(p) <= 255 for p in m.group().split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        out += [("card", *m.span())] if 13 <= size(m) <= 19 and luhn(re.sub("[^0-9]", "", m.group())) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [("phone", *m.span())] if 9 <= size(m) <= 15 else []
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    for _ in range(30_000):
        text = "".join(rng.choice("0123456789..@@ab-+() \né٣") for _ in range(rng.randint(0, 40)))
        assert base_spans(text) == by_pattern(text)
    assert base_spans(None) == base_spans("") == []


@pytest.mark.parametrize("text", ["x" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "1 " * 100_000, "a." * 100_000 + "@"])
def test_long_texts_take_linear_time(text):
    began = time.monotonic()
    base_spans(text)
    assert time.monotonic() - began < 5


def test_gradients():
    rng = np.random.default_rng(0)
    tagger = Tagger.new(width=3, hidden=4)
    tagger.params = {k: v.astype(float) for k, v in tagger.params.items()}
    tagger.params["trans"] = rng.standard_normal((TAGS, TAGS))
    codes = rng.integers(0, 99, (3, 7))
    tags = np.array([[0, 1, 2, 2, 0, 3, 4], [0, 0, 0, 0, 0, 0, 0], [5, 6, 7, 8, 8, 1, 1]])
    _, slopes = tagger.loss_and_slopes(codes, tags)
    for name, value in tagger.params.items():
        for at in rng.choice(value.size, min(8, value.size), replace=False):
            old, step = value.flat[at], 1e-5
            value.flat[at] = old + step
            up = tagger.loss_and_slopes(codes, tags)[0]
            value.flat[at] = old - step
            down = tagger.loss_and_slopes(codes, tags)[0]
            value.flat[at] = old
            assert abs((up - down) / 2 / step - slopes[name].flat[at]) < 1e-6


def paths(steps):
    for tags in itertools.product(range(TAGS), repeat=steps):
        if START[tags[0]] and all(LEGAL[a, b] for a, b in itertools.pairwise(tags)):
            yield tags


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 4))
def test_viterbi_and_likelihood_equal_all_paths(seed, steps):
    rng = np.random.default_rng(seed)
    scores, trans = rng.standard_normal((steps, 2, TAGS)), rng.standard_normal((TAGS, TAGS))
    lengths = np.array([steps, rng.integers(1, steps + 1)])
    got = viterbi(scores, trans, lengths)

    def total(tags, row):
        return sum(scores[t, row, g] for t, g in enumerate(tags)) + sum(trans[a, b] for a, b in itertools.pairwise(tags))

    for row in (0, 1):
        every = {tags: total(tags, row) for tags in paths(lengths[row])}
        assert tuple(got[: lengths[row], row]) == max(every, key=every.get)
        assert not got[lengths[row] :, row].any()
    every = {tags: total(tags, 0) for tags in paths(steps)}
    tags = next(iter(every))
    want = np.log(np.exp(list(every.values())).sum()) - every[tags]
    assert abs(crf_slopes(scores[:, :1], trans, np.array(tags)[:, None])[0] * steps - want) < 1e-9


def test_spans_and_tags_are_inverse():
    spans = [("email", 0, 3), ("card", 3, 4), ("card", 4, 9)]
    assert spans_of(tags_of(12, spans)) == spans
    assert read_spans(spelled(spans)) == spans and read_spans("") == []


def sentences(rng, words, n):
    """Texts with one labelled item each, or a number that is none."""
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    out = []
    for i in range(n):
        kind = ("email", "ip", "card", "phone", "")[i % 5]
        card = digits(15)
        item = {
            "email": f"{rng.choice(words)}{digits(2)}@mail{digits(1)}.example.com",
            "ip": ".".join(str(rng.randint(1, 255)) for _ in range(4)),
            "card": next(card + c for c in "0123456789" if luhn(card + c)),
            "phone": f"+1 ({digits(3)}) 555-{digits(4)}",
            "": rng.choice([f"20{digits(2)}-01-1{digits(1)}", digits(5), f"{digits(2)}.{digits(2)}"]),
        }[kind]
        a, b = (" ".join(rng.choice(words) for _ in range(rng.randint(3, 9))) for _ in "ab")
        out.append((f"{a} {item} {b}", kind, len(a) + 1, len(a) + 1 + len(item)))
    return out


@pytest.fixture(scope="module")
def learned(words):
    rng = random.Random(8)
    rows = sentences(rng, words, 1_000)
    return fit([(t, [(k, a, b)] if k else []) for t, k, a, b in rows])


def test_held_out_spans_are_found(learned, words):
    rows = sentences(random.Random(99), words, 300)
    right = wrong = 0
    for (_, kind, a, b), found in zip(rows, model_spans(learned, [r[0] for r in rows]), strict=True):
        right += (kind, a, b) in found
        wrong += sum(f != (kind, a, b) for f in found)
    assert right > 0.9 * 240 and wrong < 30


def test_windows_are_reconciled_over_long_texts(learned, words, monkeypatch):
    rows = sentences(random.Random(5), words, 100)
    alone = list(model_spans(learned, [r[0] for r in rows]))
    joined, want, at = [], [], 0
    for (text, *_), found in zip(rows, alone, strict=True):
        joined.append(text)
        want += [(k, a + at, b + at) for k, a, b in found]
        at += len(text) + 1
    text = "\n".join(joined)
    assert next(model_spans(learned, [text])) == sorted(want)
    monkeypatch.setattr(private, "DECODED", 50)
    monkeypatch.setattr(private, "TOGETHER", 3)
    assert next(model_spans(learned, [text])) == sorted(want)
    # One line far longer than a window: whatever a span's place in a window, it is found.
    line = next(model_spans(learned, [" ".join(joined)]))
    assert len(set(line) & set(want)) > 0.8 * len(want)
    assert len(char_codes("é\U0001f600x")) == 3 and WINDOW % 2 == 0


def test_added_spans_pass_checks_and_touch_no_base_span():
    text = "4111.1111.1111.1111 and 415-555-0132 or 10 . 0 . 0 . 1 at 1.2.3.4"
    found = [("card", 0, 19), ("phone", 24, 36), ("ip", 40, 54), ("ip", 58, 65), ("card", 24, 36)]
    assert with_added(text, base_spans(text), found) == [("ip", 58, 65), ("card", 0, 19), ("phone", 24, 36), ("ip", 40, 54)]
    assert not holds("card", "4111 1111 1111 1112") and not holds("ip", "1.2.3.400") and not holds("email", "no at sign")
    assert not holds("phone", "1234567890") and not holds("email", "@b.c") and not holds("phone", "2024-05-06")


def test_table_on_edge_rows(spark, edge_docs, no_docs, words):
    extra = sentences(random.Random(6), words, 40)
    rows = [(400 + i, t) for i, (t, *_) in enumerate(extra)] + [(500, "1" * 30_000), (501, "a@b.cd " * 3_000), (400, extra[0][0])]
    docs = edge_docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    tagger = train(docs.select("text"), per_kind=60, plain=60)
    again = train(docs.repartition(5).select("text"), per_kind=60, plain=60)
    assert all((tagger.params[k] == again.params[k]).all() for k in tagger.params)
    got = private_spans(docs, tagger)
    assert got.columns == ["doc_id", "spans", "base_spans", "n_email", "n_ip", "n_card", "n_phone"]
    texts = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
    held = sorted(got.withColumn("d", F.sha2("base_spans", 256)).collect(), key=lambda r: str((r.doc_id, r.base_spans)))
    want = sorted(((i, spelled(by_pattern(t or ""))) for i, t in texts), key=str)
    assert [(r.doc_id, r.base_spans) for r in held] == want
    for r in held:
        base = read_spans(r.base_spans)
        assert set(base) <= set(read_spans(r.spans))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == s[0] for s in base) for k in private.KINDS)
        assert r.d == sha256(r.base_spans.encode()).hexdigest()
    assert train(no_docs.select("text")) is None
    assert private_spans(no_docs, None).count() == 0
    assert private_spans(docs, None).where("spans <> base_spans").count() == 0

import math
from collections import Counter

import numpy as np
import pytest

from lookback.llm.ngram import HashedModel, base_counts, count_grams, kneser_ney, quality_rules


def plain_base(text):
    words = (text or "").encode().split()
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        dup,
        len(covered),
    )


@pytest.mark.parametrize(
    "text",
    [None, "", " \n ", "a b c d e a b c d e f", "a " * 40, "x\nx\n\n\ny\nx ", "é#ü *$ <é>|&%", "a b c d e f g\n" * 3],
)
def test_base_counts(text):
    assert base_counts(None if text is None else text.encode()) == plain_base(text)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, t, "en", 1, 2) for i, t in enumerate(["the cat sat on the mat", "the dog sat", "a cat", "the the", ""])]
    rows += [(9, "le chat est la", "fr", 1, 2), (10, None, None, 1, 2), (None, "x", None, 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, gram int, n int")


def plain_model(texts, order):
    """Textbook modified Kneser-Ney over byte strings."""
    top = Counter()
    for t in texts:
        s = b"\n" * (order - 1) + b" ".join((t or "").encode().split()) + b"\n"
        top.update(s[i : i + order] for i in range(len(s) - order + 1))
    levels = {order: top}
    for m in range(order - 1, 0, -1):
        levels[m] = Counter(g[1:] for g in levels[m + 1])
    cuts = {}
    for m, level in levels.items():
        k = [sum(c == i for c in level.values()) for i in range(5)]
        y = k[1] / max(k[1] + 2 * k[2], 1)
        d = [(i - (i + 1) * y * k[i + 1] / k[i]) if k[i] else 0.5 for i in (1, 2, 3)]
        cuts[m] = [0.0] + [min(float(i), max(0.0, v)) for i, v in enumerate(d, 1)]

    def p(gram):
        if not gram:
            return 1 / 256
        level = levels[len(gram)]
        own = {g: c for g, c in level.items() if g[:-1] == gram[:-1]}
        lower = p(gram[1:])
        if not own:
            return lower
        total = sum(own.values())
        cut = lambda c: cuts[len(gram)][min(c, 3)]
        kept = max(sum(map(cut, own.values())) / total, 1e-12)
        c = own.get(gram, 0)
        return (c - cut(c)) / total + kept * lower if c else kept * lower

    return p


def test_model_equals_the_textbook_and_sums_to_one(corpus):
    counts = count_grams(corpus, order=3, text_col="text", lang_col="lang")
    model = HashedModel.collect(*kneser_ney(counts, 3))
    english = [r.text for r in corpus.where("lang = 'en'").collect()]
    p = plain_model(english, 3)
    for gram in (b"the", b"\n\nt", b" ca", b"at\n", b"zzt", b"tzq", b"he ", b"\n\n\n", b"\xff\xfea"):
        code = np.array([int.from_bytes(gram, "big")], np.uint64)
        assert model.scores("=en", code)[0] == pytest.approx(math.log(p(gram)), abs=1e-5)
    for context in (b"th", b"\n\n", b"zq"):
        codes = (np.uint64(int.from_bytes(context, "big")) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert np.exp(model.scores("=en", codes)).sum() == pytest.approx(1, abs=1e-4)
    assert model.scores("=unknown", codes) == pytest.approx(np.full(256, -math.log(256)))


def test_perplexity_and_both_lookups(corpus):
    small, joined = (
        {r.doc_id: r for r in quality_rules(corpus, order=3, max_grams=m).collect() if r.doc_id is not None}
        for m in (1000, 1)
    )
    english = [r.text for r in corpus.where("lang = 'en'").collect()]
    p = plain_model(english, 3)
    s = b"\n\nthe dog sat\n"
    want = math.exp(-sum(math.log(p(s[i : i + 3])) for i in range(len(s) - 2)) / (len(s) - 2))
    assert small[1].perplexity == pytest.approx(want, rel=1e-4)
    for i, row in small.items():
        assert row.kept == joined[i].kept
        assert (row.perplexity, row.low, row.high) == (joined[i].perplexity, joined[i].low, joined[i].high)


def test_bands_and_verdicts_equal_plain_loops(corpus):
    rows = [r for r in quality_rules(corpus, order=3).collect() if r.doc_id is not None]
    texts = {r.doc_id: (r.lang, r.text) for r in corpus.collect()}
    middle = lambda x: sorted(x)[(len(x) - 1) // 2]
    for lang in {lang for lang, _ in texts.values()}:
        own = [r for r in rows if texts[r.doc_id][0] == lang]
        cells = [math.floor(math.log(r.perplexity) * 1000 + 0.5) for r in own if not r.base_failed]
        if not cells:
            assert not any(r.kept for r in own)
            continue
        centre = middle(cells)
        reach = max(1, middle([abs(c - centre) for c in cells])) * 1.4826 * 3.2 / 1000
        for r in own:
            if r.perplexity is not None:
                wide = reach * (1 + 50 / max(1, r.n_words))
                assert math.log(r.low) == pytest.approx(centre / 1000 - wide, abs=1e-9)
                assert math.log(r.high) == pytest.approx(centre / 1000 + wide, abs=1e-9)
                assert r.kept == (not r.base_failed and abs(math.log(r.perplexity) - centre / 1000) <= wide)


def test_bands_reject_what_is_far_from_its_language(spark, words):
    import random

    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(words) for _ in range(80)), "en") for i in range(200)]
    rows += [(1000, " ".join("ZQ#%XW"[k % 6] * 2 + "!" for k in rng.choices(range(600), k=80)), "en")]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    odd = got[1000]
    assert not odd.base_failed and not odd.kept
    assert not odd.low <= odd.perplexity <= odd.high
    assert sum(r.kept for i, r in got.items() if i < 1000) >= 190


def test_edge_rows(edge_docs, no_docs):
    got = quality_rules(edge_docs).collect()
    assert len(got) == edge_docs.count()
    texts = {r.doc_id: r.text for r in edge_docs.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            base = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            assert base == plain_base(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed) and (r.perplexity is None) == (r.n_words == 0)
    assert quality_rules(no_docs).count() == 0

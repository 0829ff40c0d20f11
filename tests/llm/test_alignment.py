import os
import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lookback.llm import alignment
from lookback.llm.alignment import Aligner, TokenizerPair, aligned, alignment_table, successor_ends
from lookback.llm.registry import byte_model_path, piece_model_path

pytestmark = pytest.mark.skipif(
    not (os.path.exists(piece_model_path()) and os.path.exists(byte_model_path())), reason="no tokenizers here"
)


@pytest.fixture(scope="module")
def pair():
    return TokenizerPair.load(byte_model_path(), piece_model_path())


def by_hand(pair, text):
    """Sizes, groups and links of one text, by the definition, from whole-text encodings."""
    none = 0, 0, 0, "", Counter()
    if not text:
        return none
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    sides = []
    for ids, raw in ((a, pair.a_bytes), (b, pair.b_bytes)):
        if b"".join(raw[i] for i in ids) != (" " + text).encode():
            return none
        sides.append(np.cumsum([len(raw[i]) for i in ids]).tolist())
    shared = set(sides[0]) & set(sides[1])
    parts = []
    for ids, ends in zip((a, b), sides):
        parts.append([[]])
        for i, end in zip(ids, ends):
            parts[-1][-1].append(i)
            if end in shared:
                parts[-1].append([])
    own = list(zip(parts[0][:-1], parts[1][:-1], strict=True))
    groups = [f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in own]
    links = Counter((x[-1], y[-1]) for x, y in own)
    return len(a), len(b), len(groups), ";".join(groups), links


ODD = [*"abcXYZ  \n\t\r.,'12é日本ßñ  　\x00\x1f\u0085ﬁ😀<|s>", " the", "  ", "\n\n", " don't", "<|endoftext|>", "<s>", " é", "▁", " "]


def odd_texts(n):
    rng = random.Random(2)
    return ["".join(rng.choice(ODD[: -2 if rng.random() < 0.9 else None]) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def as_hand(row):
    return row["n_a"], row["n_b"], row["n_groups"], row["groups"], Counter({(x["a"], x["b"]): x["n"] for x in row["links"]})


def test_blocks_equal_whole_texts_by_hand(pair, monkeypatch):
    texts = [None, "", *odd_texts(600), "x" * 5_000, "word " * 3_000]
    want = [by_hand(pair, t) for t in texts]
    assert sum(w[0] == 0 for w in want) > 10
    assert [as_hand(r) for r in Aligner(pair).align(texts).to_pylist()] == want
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    monkeypatch.setattr(alignment, "LEARNED", 7)
    monkeypatch.setattr(alignment, "JOINED", 2)
    aligner = Aligner(pair)
    assert [as_hand(r) for i in range(0, len(texts), 9) for r in aligner.align(texts[i : i + 9]).to_pylist()] == want
    assert [as_hand(r) for r in Aligner(pair).align([None, ""]).to_pylist()] == want[:2]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_pointers_end_at_shared_offsets(a, b):
    a, b = (np.array(sorted(x | {61})) for x in (a, b))
    shared = np.intersect1d(a, b)
    last_a, last_b = successor_ends(a, b)
    assert (b[last_a] == shared[np.searchsorted(shared, a)]).all()
    assert (b[last_b] == shared[np.searchsorted(shared, b)]).all()


def table_by_hand(pair, rows):
    own = [(i, by_hand(pair, t)) for i, t in rows]
    count = Counter()
    for _, r in own:
        count += r[4]
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return Counter(
        (
            i, *r[:3], sum(r[4].values()), sum(n for p, n in r[4].items() if count[p] == top[p[1]]),
            sum(n * count[p] for p, n in r[4].items()), sha256(r[3].encode()).hexdigest() if r[0] else "",
        )
        for i, r in own
    )


def test_table_equals_hand_on_edge_rows(spark, pair, edge_docs, no_docs):
    odd = spark.createDataFrame([(300 + i, t) for i, t in enumerate(odd_texts(60))], "doc_id long, text string")
    docs = edge_docs.unionByName(odd, allowMissingColumns=True)
    got = alignment_table(docs, pair)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = table_by_hand(pair, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert Counter(tuple(r) for r in got.collect()) == want
    assert alignment_table(no_docs, pair).count() == 0


def test_groups_spell_the_text(spark, pair):
    text = "It isn't the alignment of naïve tokens; 12345 of them. "
    row = aligned(spark.createDataFrame([(1, text)], "doc_id long, text string"), pair).first()
    sides = [part.split("|") for part in row.groups.split(";")]
    for side, raw in enumerate((pair.a_bytes, pair.b_bytes)):
        assert b"".join(raw[int(i)] for part in sides for i in part[side].split(",")) == (" " + text).encode()
    for a, b in sides:
        spelled = [b"".join(raw[int(i)] for i in ids.split(",")) for raw, ids in ((pair.a_bytes, a), (pair.b_bytes, b))]
        assert spelled[0] == spelled[1]
    assert row.n_groups == len(sides) == sum(x.n for x in row.links)

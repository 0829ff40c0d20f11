import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lookback.llm import simhash
from lookback.llm.common import components
from lookback.llm.linedup import dedup_lines
from lookback.llm.simhash import BKForest, one_of_each, simhash_groups, spanning, text_fingerprint


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    ids = {}
    for r, (i, _) in zip(root, rows, strict=True):
        ids[r] = min(ids.get(r, 1 << 62), i if i is not None else 1 << 62)
    return sorted(
        (str(i), f"{p:016x}", ids[r] if ids[r] < 1 << 62 else None)
        for r, p, (i, _) in zip(root, prints, rows, strict=True)
    )


def test_groups_equal_brute_force(edge_docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    for part in (512, 2):  # also with shards cut into parts
        monkeypatch.setattr(simhash, "PART", part)
        got = simhash_groups(edge_docs).collect()
        found = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got)
        assert found == brute_groups(rows)


def test_no_rows(no_docs):
    assert simhash_groups(no_docs).count() == 0
    assert one_of_each(no_docs).count() == 0


def test_one_of_each_keeps_columns_and_null_ids(edge_docs):
    kept = one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 1 and ids.count(None) == 2
    assert 4 in ids and 100 not in ids
    assert set(range(30)) <= set(ids)


def test_long_text_in_blocks():
    text = " ".join(str(i % 977) for i in range(70_000))
    assert text_fingerprint(text.encode(), 3) & (1 << 64) - 1 == plain_fingerprint(text)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40, unique=True), st.integers(0, 63))
def test_trees_find_all_within_the_radius(codes, bit):
    codes = np.array(codes + [codes[0] ^ (1 << bit)], np.uint64)
    codes = np.unique(codes)
    shard = np.zeros(len(codes), np.int64)
    found = set()
    for q, n in BKForest(shard, codes).search(shard, codes, 3):
        found |= set(zip(q.tolist(), n.tolist(), strict=True))
    want = {
        (i, j)
        for i in range(len(codes))
        for j in range(len(codes))
        if int(codes[i] ^ codes[j]).bit_count() <= 3
    }
    assert found == want


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (1, 0)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == len(roots) == 41 + 31
    assert len({roots[i] for i in range(41)}) == 1 and len({roots[200 + i] for i in range(30)}) == 1
    assert roots[0] != roots[100]
    assert components(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0


def test_spanning_labels():
    label = spanning(6, np.array([1, 4, 2]), np.array([0, 5, 1]))
    assert label.tolist() == [0, 0, 0, 3, 4, 4]


def test_rows_that_repeat_an_id_stay_with_their_own_group(spark):
    a, b, c = (" ".join(f"{name}{i}" for i in range(40)) for name in "abc")
    rows = [(5, a), (7, a), (7, b), (8, b), (9, c), (9, a), (3, "lone text one"), (3, "other words here two"), (3, "lone text one")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n long")
    got = one_of_each(docs)
    assert got.columns == docs.columns
    want = [(3, "lone text one"), (3, "other words here two"), (5, a), (7, b), (9, c)]
    assert sorted((r.doc_id, r.text) for r in got.collect()) == want
    rows = [(1, a), (2, a), (2, b), (None, b)]
    got = one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(1, a), (2, b), (None, b)], key=str)


def test_one_row_of_each_group_after_another_stage(spark, edge_docs):
    docs = edge_docs.select("doc_id", "text", "lang")
    computed = dedup_lines(docs, min_words=50).select(*docs.columns)
    got = one_of_each(computed).collect()
    rows = [tuple(r) for r in computed.collect()]
    prints = {r[1]: text_fingerprint(None if r[1] is None else r[1].encode(), 3) for r in rows}
    assert {r.doc_id for r in got} <= {r[0] for r in rows}
    kept = [r for r in got if r.doc_id is not None]
    assert len(kept) == len({(r.doc_id, prints[r.text]) for r in kept})
    assert sum(r.doc_id is None for r in got) == sum(r[0] is None for r in rows)

import numpy as np
import pytest

from lookback.llm import multiindex
from lookback.llm.multiindex import Grid, similar_groups
from lookback.llm.simhash import spanning


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 16)).astype(np.float32)
    x[50:90] = x[50] + 0.15 * rng.normal(size=(40, 16))  # near copies, in chains
    x[100:130] = x[100]  # copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [
        (900, None),
        (901, []),
        (902, [0.0] * 16),
        (903, [float("nan")] * 16),
        (904, [1.0, 2.0]),
        (905, [2.0, 4.0]),
        (906, [1.0, None]),
        (907, [float("inf")] + [1.0] * 15),
        (908, [1e30] * 16),
        (909, [1e-30] * 16),
        (None, [3.0] * 16),
        (None, None),
        rows[7],
    ]
    return spark.createDataFrame(
        [(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<float>, cid int, n int, label int"
    )


def brute(rows, threshold):
    n = len(rows)
    x, size = np.zeros((n, 16)), np.zeros(n)
    for i, (_, v) in enumerate(rows):
        if v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            x[i, : len(v)], size[i] = v, len(v)
    scale = np.abs(x).max(1, keepdims=True)
    x = np.divide(x, scale, out=np.zeros_like(x), where=scale > 0)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    hit = (x @ x.T >= threshold) & (size[:, None] == size) & (size > 0)
    np.fill_diagonal(hit, False)
    label = spanning(n, *np.nonzero(hit))
    ids = np.array([i if i is not None else 1 << 40 for i, _ in rows])
    least = [ids[label == k].min() for k in label]
    return sorted(
        (str(i), int(h.sum()), int(c) if c < 1 << 40 else None)
        for (i, _), h, c in zip(rows, hit, least, strict=True)
    )


@pytest.mark.parametrize("part", [1024, 8])
def test_links_and_groups_equal_brute_force(vectors, monkeypatch, part):
    monkeypatch.setattr(multiindex, "PART", part)
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = similar_groups(vectors, per_cell=16).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in got) == brute(rows, 0.9)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_nothing_to_index(vectors):
    assert similar_groups(vectors.limit(0)).count() == 0
    got = similar_groups(vectors.where("vec_id IN (900, 901, 902)")).collect()
    assert [(r.n_links, r.kept) for r in got] == [(0, True)] * 3
    assert similar_groups(vectors.where("vec_id = 5")).first().n_links == 0


def test_traversal_is_the_order_of_all_cells():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 10))
    grid = Grid(x, 7, 1)
    for visits in (1, 5, 30, grid.cells):
        got = grid.traverse(x[:20], visits)
        for q, cells in zip(x[:20], got, strict=True):
            d = [((q[:5] - a) ** 2).sum() + ((q[5:] - b) ** 2).sum() for a in grid.books[0] for b in grid.books[1]]
            want = np.sort(d)[:visits]
            assert np.allclose(np.array(d)[cells], want)
            assert grid.ranks(q, cells).tolist() == list(range(visits))


def test_depth_counts_true_links_only(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 12))
    near = x[:30] + 0.1 * rng.normal(size=(30, 12))
    x = np.concatenate([x, near])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cids = np.arange(len(x))
    grid = Grid(x, 20, 1)
    # A partition for every few rows: far more batches than links.
    classes = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(cids, x)], "cid long, embedding array<double>")
    classes = classes.repartition(100)
    probe = (x[:30], np.full(30, 12), cids[:30])
    hit = (x[:30] @ x.T >= 0.9) & (cids[:30, None] != cids)
    cells = grid.traverse(x, 1)[:, 0]
    want = np.concatenate([grid.ranks(x[i], cells[hit[i]]) for i in range(30)])
    assert hit.sum() > 5 and want.max() > 0
    found = dict(multiindex._link_ranks(classes, grid, probe, 0.9))
    assert found == dict(zip(*np.unique(want, return_counts=True)))
    few = multiindex._depth(classes, grid, probe, 0.9, 0.9, 512, 1, 1)
    assert few == np.sort(want)[int(np.ceil(0.9 * len(want))) - 1] + 1
    # Too few links for the recall: all are met, however many batches there are.
    assert multiindex._depth(classes, grid, probe, 0.9, 0.9, 512, 1000, 1) >= want.max() + 1


def test_depth_without_links_is_measured_at_the_threshold(spark):
    x = np.eye(16)
    grid = Grid(np.random.default_rng(0).normal(size=(300, 16)), 12, 1)
    classes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cid long, embedding array<double>")
    probe = (x, np.full(16, 16), np.arange(16))
    assert multiindex._link_ranks(classes, grid, probe, 0.9) == []
    made = multiindex._made_ranks(grid, x, probe[1], 0.9, 100, 1)
    assert multiindex._depth(classes, grid, probe, 0.9, 1.0, 512, 100, 1) == made.max() + 1 > 1

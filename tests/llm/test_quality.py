import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lookback.llm.quality import judge, train


def site():
    return {"host": F.col("source"), "path": F.col("lang")}


@pytest.fixture(scope="module")
def labelled(spark, words):
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randint(15, 80))]
        kind = i % 6
        if kind == 0:
            text = [w.upper() + "!!" for w in text]
        if kind == 1:
            text[rng.randrange(len(text))] = "zqscum"
        rows.append((i, " ".join(text), "en", f"src{i % 4}"))
        marks.append((i, int(kind != 0), int(kind == 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = train(docs, labels.where("doc_id < 400"))
    found = judge(docs.where("doc_id >= 400"), model, **site()).collect()
    right = [r.kept == (r.doc_id % 6 > 1) for r in found]
    assert len(right) == 200 and np.mean(right) > 0.95


def test_site_posteriors_follow_the_formulas(labelled):
    docs, labels = labelled
    model = train(docs, labels)
    rows = judge(docs, model, **site()).collect()
    p = np.array([r.doc_score for r in rows])
    host = np.array([int(r.source[3:]) for r in rows])
    assert all(0 < r.site_score < 1 for r in rows)
    # Every host has one path here, so the site must lie between the global mean and its own.
    for h in range(4):
        own = p[host == h].mean()
        low, high = sorted([p.mean(), own])
        found = np.mean([r.site_score for r in rows if r.source == f"src{h}"])
        assert low - 0.02 <= found <= high + 0.02
    assert not any(np.isnan(r.quality) for r in rows)


def test_bad_sites_lower_what_the_classifier_leaves_open(spark, labelled):
    docs, labels = labelled
    model = train(docs, labels)
    bad = docs.where("doc_id % 6 = 0").withColumn("source", F.lit("bad"))
    mixed = docs.where("doc_id % 6 > 1").unionByName(bad)
    rows = judge(mixed, model, **site()).groupBy("source").agg(F.avg("site_score").alias("s")).collect()
    means = {r.source: r.s for r in rows}
    assert means["bad"] < min(v for k, v in means.items() if k != "bad")


def test_edge_rows(edge_docs, no_docs, labelled, spark):
    docs, labels = labelled
    model = train(docs, labels)
    found = judge(edge_docs.drop("quality", "kept"), model, **site())
    assert found.count() == edge_docs.count()
    by = {r.doc_id: r for r in found.collect()}
    for i in (102, 103, 104):
        assert by[i].doc_score is None and not by[i].kept
    assert by[105].doc_score is not None
    assert judge(no_docs.drop("quality", "kept"), model, **site()).count() == 0


def test_without_labels_only_empty_texts_go(edge_docs, labelled):
    _, labels = labelled
    model = train(edge_docs, labels.limit(0))
    found = judge(edge_docs.drop("quality", "kept"), model, **site()).collect()
    assert all(r.kept == bool((r.text or "").encode().split()) for r in found)


def test_null_and_contradicting_labels(spark, labelled):
    docs, _ = labelled
    marks = spark.createDataFrame(
        [(None, 1, 0), (2, None, 0), (3, 1, None), (4, 1, 0), (4, 0, 0), (5, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    assert len(train(docs, marks).parts) == 1

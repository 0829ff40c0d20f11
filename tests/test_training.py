import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lookback import DataQualityError, schemas
from lookback.operators.training import (
    area_under_roc,
    click_model,
    hash_split,
    score_batch,
    training_set,
)

D = dt.date(2024, 1, 30)


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        views = rng.randrange(6)
        taps = rng.randrange(views + 1)
        prop = rng.choice(["point", "prepaid", "transport"])
        clicked = int(rng.random() < (0.8 if taps > 1 else 0.1))
        rows.append(
            (D, i, prop, i % 4, clicked, views, taps, 1, 5.0, taps / views if views else 0.0, 5.0, None)
        )
    return spark.createDataFrame(rows, schemas.FEATURES)


def test_spine_row_without_features_stays_with_nulls(spark, features):
    spine = spark.createDataFrame(
        [(D, 1, "nowhere", 9, 1)], "day date, user_id long, value_prop string, position int, clicked int"
    )
    (row,) = training_set(spine, features).collect()
    assert row.clicked == 1 and row.views_3w is None


def test_repeated_feature_key_raises(features):
    spine = features.select(*schemas.EVENT_KEY, "clicked")
    with pytest.raises(DataQualityError, match="pk_unique"):
        training_set(spine, features.unionByName(features.limit(1)))


def test_split_ignores_partitioning_and_is_complete(features):
    key = schemas.EVENT_KEY
    train, test = hash_split(features, key)
    again, _ = hash_split(features.repartition(7), key)
    assert {r.user_id for r in train.collect()} == {r.user_id for r in again.collect()}
    assert train.count() + test.count() == features.count()
    assert 0.7 < train.count() / features.count() < 0.9
    other, _ = hash_split(features, key, seed=7)
    assert {r.user_id for r in other.collect()} != {r.user_id for r in train.collect()}


def test_model_learns_scores_and_keeps_unseen_categories(features):
    rows = training_set(features.select(*schemas.EVENT_KEY, "clicked"), features)
    train, test = hash_split(rows, schemas.EVENT_KEY)
    model = click_model(iterations=5).fit(train.where("value_prop <> 'transport'"))
    assert area_under_roc(model.transform(test)) > 0.7
    scored = score_batch(model, test.drop("clicked"), features)
    assert scored.count() == test.count()
    assert scored.where(~F.col("probability").between(0, 1)).count() == 0
    assert scored.where("value_prop = 'transport'").count() > 0

"""Training set, reproducible split, and the click model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from lookback import schemas
from lookback.functions.scalar import stable_bucket
from lookback.operators.expectations import key_duplicates, stop_if_blocked
from lookback.operators.lookup import lookup_features


def training_set(
    spine: DataFrame,
    features: DataFrame,
    key: Sequence[str] = tuple(schemas.EVENT_KEY),
    names: Sequence[str] = tuple(schemas.FEATURE_NAMES),
    label: str = "clicked",
    check_key: bool = True,
) -> DataFrame:
    """Spine keys and label with the features looked up by key.

    A feature table with a repeated key would multiply the spine, so that raises.
    """
    if check_key:
        stop_if_blocked(
            key_duplicates(features, key, "training", "features", "check").collect(), "features"
        )
    return lookup_features(spine.select(*key, label), features, key, names)


def hash_split(
    df: DataFrame, key: Sequence[str], train_pct: int = 80, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: a row's side does not depend on how
    the data is partitioned, nor on a task that ran again."""
    bucket = stable_bucket(list(key), 100, seed)
    return df.where(bucket < train_pct), df.where(bucket >= train_pct)


def click_model(
    category: str = "value_prop",
    numeric: Sequence[str] = (*schemas.FEATURE_NAMES, "position"),
    label: str = "clicked",
    iterations: int = 40,
    seed: int = 42,
) -> Pipeline:
    """Boosted trees over the features and the indexed category; unseen ones are kept."""
    index = f"{category}_idx"
    return Pipeline(
        stages=[
            StringIndexer(inputCol=category, outputCol=index, handleInvalid="keep"),
            VectorAssembler(inputCols=[*numeric, index], outputCol="features"),
            GBTClassifier(
                labelCol=label, featuresCol="features", maxIter=iterations, seed=seed
            ),
        ]
    )


def area_under_roc(
    scored: DataFrame, label: str = "clicked", score: str = "rawPrediction", bins: int = 0
) -> float:
    """Exact by default: every distinct score is a point. ``bins`` bounds their number."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
    ).evaluate(scored)


def score_batch(
    model: PipelineModel,
    spine: DataFrame,
    features: DataFrame,
    key: Sequence[str] = tuple(schemas.EVENT_KEY),
    names: Sequence[str] = tuple(schemas.FEATURE_NAMES),
) -> DataFrame:
    """Predictions for keys, from the same lookup the training used."""
    rows = lookup_features(spine.select(*key), features, key, names)
    probability = vector_to_array("probability")[1]
    return model.transform(rows).select(*key, "prediction", probability.alias("probability"))

"""Classifier: features, split, forest, predictions and accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from trendspark.operators.encode import transform_features
from trendspark.operators.forest import accuracy, predict, train_forest
from trendspark.operators.split import hash_split, random_split
from trendspark.settings import CLASSIFIER_TREES, TEST_RATIO
from trendspark.staging import stage


def classifier_job(
    df: DataFrame,
    feature_columns: Sequence[str],
    label_column: str,
    *,
    key: str | Sequence[str] | None = None,
    test_ratio: float = TEST_RATIO,
    num_trees: int = CLASSIFIER_TREES,
    seed: int | None = None,
    partitions: int | None = None,
) -> dict:
    """Train on one part of ``df`` and predict the other.

    With ``key`` the split and the training parts go by its hash; without it the split is at random and equal
    rows share a part. ``partitions`` overrides the number of parts that follows from the rows. Returns ``model`` and the tables ``training``, ``testing``, ``predictions`` and ``accuracy``.
    """
    transformed = stage(transform_features(df, feature_columns, label_column), "transformed")
    if key is None:
        training, testing = random_split(transformed, test_ratio, seed)
    else:
        training, testing = hash_split(transformed, key, test_ratio)
    model = train_forest(training, num_trees, seed, partitions, keep=False, key=key)
    predictions = predict(model, testing)
    return {
        "model": model,
        "training": training,
        "testing": testing,
        "predictions": predictions,
        "accuracy": accuracy(predictions),
    }

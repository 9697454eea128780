"""Splits into training and test rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.settings import TEST_RATIO

_HASH_RANGE = 2**32


def _check_ratio(ratio: float) -> None:
    if not 0 <= ratio <= 1:
        raise ValueError("the ratio lies between 0 and 1")


def key_hash(keys: Sequence[str]) -> Column:
    """32 bits of the MD5 of the keys as text, the same in every engine and layout."""
    text = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_split(
    df: DataFrame, keys: str | Sequence[str], test_ratio: float = TEST_RATIO
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the key.

    The split does not depend on partitions, order or engine, needs no shuffle, and
    sends rows of equal key to the same part.
    """
    _check_ratio(test_ratio)
    in_test = key_hash([keys] if isinstance(keys, str) else keys) < math.floor(test_ratio * _HASH_RANGE)
    return df.where(~in_test), df.where(in_test)


def random_split(
    df: DataFrame, test_ratio: float = TEST_RATIO, seed: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows at random; repeatable for one seed and one layout."""
    _check_ratio(test_ratio)
    train, test = df.randomSplit([1 - test_ratio, test_ratio], seed)
    return train, test


def split_target(
    df: DataFrame,
    target: str,
    keys: str | Sequence[str],
    train_fraction: float = 1 - TEST_RATIO,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``X_train, X_test, y_train, y_test``: features without and targets alone.

    The key columns stay in all four parts, so that they can be joined again.
    """
    train, test = hash_split(df, keys, 1 - train_fraction)
    kept = [keys] if isinstance(keys, str) else list(keys)
    return train.drop(target), test.drop(target), train.select(*kept, target), test.select(*kept, target)

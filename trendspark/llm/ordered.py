"""A global order by id without one task that holds all rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_bounds(df: DataFrame, key: str, buckets: int) -> list[int]:
    """At most ``buckets - 1`` values of an integer column that cut its rows about evenly."""
    shares = [i / buckets for i in range(1, buckets)]
    return sorted(set(int(x) for x in df.approxQuantile(key, shares, 0.2 / buckets))) if shares else []


def bucket_of(key: str, bounds: list[int]) -> Column:
    """Number of bounds at or below the key; null keys are in bucket 0.

    Bounds are as many as the tasks of a stage. They are searched in two steps, each over
    about the square root of their number.
    """
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= F.col(key)))

    def array(values: list[int]) -> Column:
        return F.expr(f"array({','.join(f'{v}L' for v in values)})")

    # the last group that begins at or below the key
    group = below(array([g[0] for g in groups]))
    found = (group - 1) * width + below(F.element_at(F.array(*map(array, groups)), group))
    return F.when(F.col(key).isNull() | (F.col(key) < bounds[0]), F.lit(0)).otherwise(found)


def bucket_count(df: DataFrame) -> int:
    """As many buckets as the session plans shuffle partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

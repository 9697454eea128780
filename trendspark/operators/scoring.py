"""Min-max scaling by direction, row scores and the scoring report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.functions import half_even, weighted_total
from trendspark.settings import REPORT_COLUMNS, SCORING_COLUMNS, SCORING_DIRECTIONS, SUM_WEIGHTS


def scaled_columns(
    df: DataFrame, columns: Sequence[str], directions: Sequence[int], limits: Sequence[tuple] | None = None
) -> list[Column]:
    """Each column scaled to 0..1 over all rows of ``df``.

    Direction 1 means high is good, 0 means low is good. A constant column scales to 0
    in direction 1 and to 1 in direction 0. Least and greatest values come from one
    aggregation over all columns, used as a scalar sub-query: nothing is joined and
    nothing passes through the driver. ``df`` is read twice, so pass a written table
    if it is expensive. For a table as it lies in Parquet files, ``limits`` from
    :func:`~trendspark.sources.files.parquet_limits` spare the first reading.
    """
    if len(columns) != len(directions):
        raise ValueError(f"{len(columns)} columns but {len(directions)} directions")
    for direction in directions:
        if direction not in (0, 1):
            raise ValueError(f"direction is 0 or 1, not {direction}")
    if limits is not None and len(limits) != len(columns):
        raise ValueError(f"{len(columns)} columns but {len(limits)} limits")
    values = [F.col(c).cast("double") for c in columns]
    if limits is None:
        found = df.agg(
            F.struct(
                *(F.min(v).alias(f"low{i}") for i, v in enumerate(values)),
                *(F.max(v).alias(f"high{i}") for i, v in enumerate(values)),
            )
        ).scalar()
        ends = [(found.getField(f"low{i}"), found.getField(f"high{i}")) for i in range(len(values))]
    else:
        ends = [tuple(F.lit(end).cast("double") for end in pair) for pair in limits]

    def scaled(i: int, value: Column, direction: int) -> Column:
        low, high = ends[i]
        part = (value - low) / (high - low)
        return F.when(high == low, F.lit(0.0 if direction else 1.0)).otherwise(
            part if direction else F.lit(1.0) - part
        )

    return [scaled(i, v, d) for i, (v, d) in enumerate(zip(values, directions))]


def minmax_scale(
    df: DataFrame,
    columns: Sequence[str] = SCORING_COLUMNS,
    directions: Sequence[int] = SCORING_DIRECTIONS,
    suffix: str = "_SCALED",
    limits: Sequence[tuple] | None = None,
) -> DataFrame:
    """Add the scaled form of every column as ``<column><suffix>``."""
    scaled = scaled_columns(df, columns, directions, limits)
    return df.select("*", *(s.alias(c + suffix) for c, s in zip(columns, scaled)))


def proximity_score(
    df: DataFrame,
    columns: Sequence[str] = SCORING_COLUMNS,
    directions: Sequence[int] = SCORING_DIRECTIONS,
) -> DataFrame:
    """Add ``SCORE``, the sum of the scaled columns."""
    return df.select("*", reduce(add, scaled_columns(df, columns, directions)).alias("SCORE"))


def weighted_sum(
    df: DataFrame,
    columns: Sequence[str] = SCORING_COLUMNS,
    weights: Sequence[float] = SUM_WEIGHTS,
) -> DataFrame:
    """Add ``WEIGHTED_SUM`` of the unscaled columns, two places, halves to even."""
    return df.withColumn("WEIGHTED_SUM", half_even(weighted_total(columns, weights), 2))


def scoring_report(
    merged: DataFrame,
    columns: Sequence[str] = SCORING_COLUMNS,
    directions: Sequence[int] = SCORING_DIRECTIONS,
    weights: Sequence[float] = SUM_WEIGHTS,
    report_columns: Sequence[str] = REPORT_COLUMNS,
) -> DataFrame:
    """Scored columns, score, weighted sum and merchant columns; equal rows once."""
    scored = weighted_sum(proximity_score(merged, columns, directions), columns, weights)
    return scored.select(*columns, "SCORE", *report_columns).distinct()

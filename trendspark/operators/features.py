"""Per-merchant features, key columns, row cleaning and row limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions import relative_change, row_mean, weighted_total, zip_text
from trendspark.operators.ranges import default_buckets, value_groups
from trendspark.settings import COUNT_COLUMNS, COUNT_TREND_WEIGHTS, SALES_COLUMNS, SALES_TREND_WEIGHTS


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop by name, whatever the case; names that do not exist are ignored."""
    return df.drop(*names)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows in which any column is null or NaN."""
    return df.na.drop("any")


def average_columns() -> dict[str, Column]:
    return {
        "AVG_SALES": row_mean(SALES_COLUMNS),
        "AVG_SALES_CNT": F.round(row_mean(COUNT_COLUMNS), 0),
    }


def sales_trend_columns(first_base: str = "current") -> dict[str, Column]:
    """Year-over-year change of the amounts.

    ``first_base="current"`` divides the first change by the later of its two years,
    as existing reports do; ``"previous"`` divides by the earlier one, as the other
    two changes do.
    """
    if first_base not in ("current", "previous"):
        raise ValueError("first_base is 'current' or 'previous'")
    y0, y1, y2, y3 = SALES_COLUMNS
    return {
        "SALES_TREND_1": relative_change(y1, y0, y1 if first_base == "current" else y0),
        "SALES_TREND_2": relative_change(y2, y1, y1),
        "SALES_TREND_3": relative_change(y3, y2, y2),
    }


def count_trend_columns() -> dict[str, Column]:
    """Year-over-year change of the numbers of sales."""
    pairs = zip(COUNT_COLUMNS, COUNT_COLUMNS[1:])
    return {
        f"SALES_CNT_TREND_{i}": relative_change(later, earlier, earlier)
        for i, (earlier, later) in enumerate(pairs, start=1)
    }


def merchant_features(merchants: DataFrame, first_base: str = "current") -> DataFrame:
    """Add means and trends, then keep complete rows only. No shuffle."""
    return drop_incomplete(
        merchants.withColumns({**average_columns(), **sales_trend_columns(first_base), **count_trend_columns()})
    )


def weighted_trends(
    features: DataFrame,
    sales_weights: Sequence[float] = SALES_TREND_WEIGHTS,
    count_weights: Sequence[float] = COUNT_TREND_WEIGHTS,
) -> DataFrame:
    """Weighted change of amounts and of counts (first two changes), and their mean."""
    sales = weighted_total(["SALES_TREND_1", "SALES_TREND_2"], sales_weights)
    counts = weighted_total(["SALES_CNT_TREND_1", "SALES_CNT_TREND_2"], count_weights)
    return features.withColumns(
        {
            "SALES_TREND_WEIGHTED": sales,
            "SALE_CNT_TREND_WEIGHTED": counts,
            "TREND_WEIGHTED": (sales + counts) / F.lit(2.0),
        }
    )


def zip_keys(merchants: DataFrame, column: str = "ZIPCODE") -> DataFrame:
    """Distinct ZIP codes as text, in column ``zipcode``."""
    return merchants.select(zip_text(column).alias("zipcode")).distinct()


def limit_rows(
    df: DataFrame, n: int, order_by: str | None = None, max_candidates: int = 100_000, buckets: int | None = None
) -> DataFrame:
    """The first ``n`` rows by ``order_by`` (repeatable), or any ``n`` rows without it.

    Spark takes the first ``n`` of every partition and merges those in one task. Where
    ``n`` is above ``max_candidates``, whole value ranges are taken instead: the rows are cut by ``order_by`` into
    groups of bounded size (see :func:`~trendspark.operators.ranges.value_groups`, which reads ``df`` twice or more),
    groups that lie within the first ``n`` are kept as they are, and only the one in which the ``n``-th row lies is
    sorted. If that one is a value that many rows share, those of the least hash are taken. No task holds
    more than a range, and the result is sorted by ranges, too. Pass a written table: equal rows are
    told apart by their place in it.
    """
    if order_by is None:
        return df.limit(n)
    if n <= max_candidates:
        return df.orderBy(order_by).limit(n)
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    ties = [F.xxhash64(*hashable), F.xxhash64(F.monotonically_increasing_id())]
    first = _take_ranges(df, n, order_by, default_buckets(df) if buckets is None else buckets, ties)
    return first.select(*df.columns).orderBy(order_by)


def _take_ranges(df: DataFrame, n: int, column: str, buckets: int, ties: Sequence[Column]) -> DataFrame:
    groups = value_groups(df, column, buckets, f"first{len(ties)}")
    within, seen, last = [], 0, None
    for at, group, rows in groups.counts:
        if seen + rows > n:
            last = at, group
            break
        within.append((at, group))
        seen += rows
    if last is None:
        return groups.rows
    kept = groups.rows.where(groups.among(within))
    if n == seen:
        return kept
    rest = groups.rows.where(groups.among([last]))
    if last in groups.tied and ties:
        hashed = f"_tie{len(ties)}"
        rest = _take_ranges(rest.withColumn(hashed, ties[0]), n - seen, hashed, buckets, ties[1:])
        return kept.unionByName(rest.select(*kept.columns))
    return kept.unionByName(rest.orderBy(column).limit(n - seen))

"""Exact global rank without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.functions import literal_array
from trendspark.operators.features import weighted_trends
from trendspark.operators.ranges import default_buckets, value_groups
from trendspark.settings import COUNT_TREND_WEIGHTS, SALES_TREND_WEIGHTS


def global_rank(
    df: DataFrame,
    column: str,
    output: str,
    *,
    ascending: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """``rank() over (order by column)`` as bigint, in parallel and exact.

    The rows are cut into groups of bounded size by their values (see :func:`~trendspark.operators.ranges.value_groups`).
    Added up in order, the groups' counts say how many rows come before each. Tied rows of a large group
    share the rank that follows from that; rows of all other groups are sorted, group by group.

    ``df`` is read three times (twice for one column), and once or twice more for each finer cut: pass
    a written table if it is expensive. Null sorts as the least value and NaN as the greatest, as in
    Spark's own ordering.
    """
    groups = value_groups(df, column, default_buckets(df) if buckets is None else buckets, output)
    before: dict[int, dict[int, int]] = {}
    seen = 0
    for at, group, rows in groups.counts if ascending else reversed(groups.counts):
        before.setdefault(at, {})[group] = seen
        seen += rows

    order = F.col(column).asc() if ascending else F.col(column).desc()
    in_group = F.rank().over(Window.partitionBy(groups.level, groups.group).orderBy(order)).cast("bigint")
    if groups.tied:
        # tied rows are all first in their group and skip the shuffle
        is_tied = groups.among(list(groups.tied))
        ranked = groups.rows.where(~is_tied).withColumn(output, in_group).unionByName(
            groups.rows.where(is_tied).withColumn(output, F.lit(1).cast("bigint"))
        )
    else:
        ranked = groups.rows.withColumn(output, in_group)
    offset = F.lit(0).cast("bigint")
    for at, found in before.items():
        places = [found.get(g, 0) for g in range(max(found) + 1)]
        here = F.element_at(literal_array(places, "bigint"), F.col(groups.group) + 1)
        offset = F.when(F.col(groups.level) == at, here).otherwise(offset)
    return groups.drop_names(ranked.withColumn(output, F.col(output) + offset))


def trend_ranking(
    features: DataFrame,
    sales_weights: Sequence[float] = SALES_TREND_WEIGHTS,
    count_weights: Sequence[float] = COUNT_TREND_WEIGHTS,
    *,
    ascending: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """Weighted trends and their rank ``TREND_RANKING``; rank 1 is the lowest trend."""
    weighted = weighted_trends(features, sales_weights, count_weights)
    return global_rank(weighted, "TREND_WEIGHTED", "TREND_RANKING", ascending=ascending, buckets=buckets)

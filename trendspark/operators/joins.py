"""Joins of a large table with a lookup table, and the merge of all merchant data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.functions import zip_text
from trendspark.operators.features import drop_columns, drop_incomplete, zip_keys
from trendspark.staging import stage, stage_bucketed

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1e-4
MIN_HOT_ROWS = 1_000_000
SAMPLE_ROWS = 1_000_000
CITY_KEYS = ("BILLING_STATE", "CITY")


def fits(df: DataFrame, limit: int) -> bool:
    """Whether a table of plain columns is at most ``limit`` bytes.

    Measured in one aggregation, as text plus one word per cell.
    """
    words = 8 * len(df.columns)
    cells = F.concat_ws(",", *(F.col(f"`{c}`").cast("string") for c in df.columns))
    size = df.agg(F.sum(F.octet_length(cells).cast("bigint") + words)).first()[0]
    return (size or 0) <= limit


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Equi-join (USING ``keys``) that holds when ``fact`` is skewed on the keys.

    ``lookup`` is measured: up to ``broadcast_bytes`` it is broadcast and ``fact`` is
    not shuffled. Beyond that both are shuffled but for the rows of hot keys (see
    :func:`split_join`). ``lookup`` is read more than once, so pass a written table if
    it is expensive. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    if fits(lookup, broadcast_bytes):
        return fact.join(F.broadcast(lookup), list(keys), how)
    return split_join(fact, lookup, keys, how, hot_share=hot_share, min_hot_rows=min_hot_rows)


def split_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Join in which the rows of hot keys are not shuffled.

    A key with more rows than ``max(min_hot_rows, hot_share * all rows)`` is hot. At
    most about ``1 / hot_share`` keys can be. Their counts are estimated from a sample: they
    decide how the work is done, not what comes out. Rows of hot keys, and rows with a null
    key, which match nothing, meet the lookup rows of the hot keys by broadcast; all
    other rows are joined by a plain shuffle. Nothing is written but the list of hot keys
    and their lookup rows. Without hot keys, or if those lookup rows take more than
    ``broadcast_bytes``, this is the plain join, whose skew adaptive execution splits.
    """
    keys = list(keys)
    total = fact.count()
    chunk = max(float(min_hot_rows), hot_share * total)
    if total <= chunk:
        return fact.join(lookup, keys, how)
    complete = reduce(and_, (F.col(k).isNotNull() for k in keys))
    share = min(1.0, SAMPLE_ROWS / total)
    seen = fact.select(*keys).sample(share, seed=1) if share < 1 else fact
    counts = seen.groupBy(*keys).agg((F.count("*") / share).alias("_n")).where(F.col("_n") > chunk)
    hot = stage(counts.select(*keys, F.lit(True).alias("_hot")), "hot-keys")
    if hot.isEmpty():
        return fact.join(lookup, keys, how)
    hot_lookup = stage(lookup.join(F.broadcast(hot.drop("_hot")), keys, "left_semi"), "hot-lookup")
    if not fits(hot_lookup, broadcast_bytes):
        return fact.join(lookup, keys, how)
    marked = fact.join(F.broadcast(hot.where(complete)), keys, "left")
    kept = F.coalesce("_hot", ~complete)
    by_broadcast = marked.where(kept).drop("_hot").join(F.broadcast(hot_lookup), keys, how)
    return by_broadcast.union(marked.where(~kept).drop("_hot").join(lookup, keys, how))


def census_enrich(merchants: DataFrame, census: DataFrame, column: str = "ZIPCODE") -> DataFrame:
    """Each ZIP code of the merchants once, with its census columns or nulls."""
    return zip_keys(merchants, column).join(census, ["zipcode"], "left")


def join_city(merchants: DataFrame, totals: DataFrame, **join_options) -> DataFrame:
    """Add the totals of the merchant's city; keys match without surrounding blanks."""
    trimmed = merchants.withColumns({k: F.trim(k) for k in CITY_KEYS})
    return lookup_join(trimmed, drop_columns(totals, "mcc", "population"), CITY_KEYS, **join_options)


def join_census(merchants: DataFrame, census: DataFrame, **join_options) -> DataFrame:
    """Add the census columns of the merchant's ZIP code."""
    with_zip = merchants.withColumn("ZIPCODE", zip_text("ZIPCODE"))
    return lookup_join(with_zip, census, ["ZIPCODE"], **join_options)


def merge_bucketed(merchants: DataFrame, totals: DataFrame, census: DataFrame, buckets: int | None = None) -> DataFrame:
    """:func:`merge_all` for lookups too large to broadcast: every merchant row is moved once, when it is written.

    Merchants are staged in buckets of city and ZIP code. Totals and census are joined to the distinct pairs of these,
    which are far fewer, and staged in the same buckets; the join of the merchants then moves nothing.
    """
    keys = [*CITY_KEYS, "ZIPCODE"]
    trimmed = merchants.withColumns({**{k: F.trim(k) for k in CITY_KEYS}, "ZIPCODE": zip_text("ZIPCODE")})
    fact = stage_bucketed(trimmed, "merchants-by-place", keys, buckets)
    added = drop_columns(totals, "mcc", "population")
    by_place = fact.select(*keys).distinct().join(added, list(CITY_KEYS)).join(census.withColumnRenamed("zipcode", "ZIPCODE"), "ZIPCODE")
    lookup = stage_bucketed(drop_incomplete(by_place), "lookup-by-place", keys, buckets)
    joined = fact.join(lookup, keys)
    return drop_incomplete(joined.select("ZIPCODE", *CITY_KEYS, *(c for c in joined.columns if c not in keys)))


def merge_all(merchants: DataFrame, totals: DataFrame, census: DataFrame, **join_options) -> DataFrame:
    """Merchants with city totals and census columns; complete rows only.

    Pass written tables: a chain of many computed columns right below two joins costs
    the optimizer more time than the join takes.
    """
    return drop_incomplete(join_census(join_city(merchants, totals, **join_options), census, **join_options))

"""Value ranges of bounded size: the rows of a table cut by a column of any orderable type.

Global ranks and ordered limits both start from here.
"""

from __future__ import annotations

import bisect
import math
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions import literal_array

_EXACT_AS_DOUBLE = (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType)
_BY_WORDS = (
    T.LongType, T.DecimalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType,
)
# a refined key is the number of its group times this, and a word below it
_WORD = 2**40
_TEXT_BYTES = 4
_MICROS_A_DAY = 86_400_000_000


@dataclass
class ValueGroups:
    """The rows with their group, named by the columns ``level`` and ``group``."""

    rows: DataFrame
    level: str
    group: str
    helper: str
    counts: list[tuple[int, int, int]]  # level, group and rows, in value order
    tied: set[tuple[int, int]]  # groups of one value that are larger than two shares

    def among(self, groups: Sequence[tuple[int, int]]) -> Column:
        """Whether a row's group is one of ``groups``."""
        found = F.lit(False)
        for at in sorted({at for at, _ in groups}):
            found |= (F.col(self.level) == at) & F.col(self.group).isin([g for a, g in groups if a == at])
        return found

    def drop_names(self, rows: DataFrame) -> DataFrame:
        return rows.drop(self.level, self.group, self.helper)


def value_groups(df: DataFrame, column: str, buckets: int, prefix: str) -> ValueGroups:
    """Cut the rows of ``df`` by ``column`` into groups in value order.

    1. Every value has a key, a double that never falls as values rise. Quantiles of the keys cut
       them into ``buckets`` open ranges; each cut is a group of its own. The cuts are one
       sorted constant, searched by halves.
    2. One aggregation counts the rows of every group.
    3. A group of more than two shares of the rows is one key. If it is one value, its rows are tied. If not,
       its values get finer keys, and the group is cut again, until no large group holds two values.

    Numbers that are exact as doubles are their own keys. bigint, decimal, dates and times are first
    compared as doubles, and then by their distance from the least value of the group. Texts
    are compared by the bytes that follow what the least and the greatest of the group have in common, so a
    common start of any length costs one step.

    The sketch error is below a quarter of a range, so a group that is not tied holds at most about two shares of the
    rows, whatever the values are. Groups depend on the values alone, so running a task again
    changes nothing. Null is the least value and NaN the greatest, as in Spark's own ordering. Texts
    compare by their bytes; other collations are refused.
    """
    kind = df.schema[column].dataType
    binary_text = not isinstance(kind, T.StringType) or kind == T.StringType()
    if not isinstance(kind, _EXACT_AS_DOUBLE + _BY_WORDS) or not binary_text:
        raise TypeError(f"{column} is {kind.simpleString()}, whose values cannot be ranked")
    if buckets < 2:
        raise ValueError("at least two buckets")
    key, group, level = (f"_{prefix}_{name}" for name in ("key", "group", "level"))
    value = _comparable(F.col(column), kind)
    grouped, counts = _count_groups(df.withColumn(key, _first_key(value, kind, df, column)), key, group, buckets)
    total = sum(counts.values())
    largest = 2 * total / buckets
    grouped = grouped.withColumn(level, F.lit(0))

    # leaves[level][group] is the number of rows in a group that is not cut again
    leaves, paths, tied = [counts], [[(g,) for g in sorted(counts)]], []
    large = {g: n for g, n in counts.items() if n > largest}
    while large:
        here = len(leaves) - 1
        spans = _spans(grouped.where((F.col(level) == here) & F.col(group).isin(list(large))), group, value, kind)
        tied += [(here, g) for g in large if spans[g] is None]
        again = [g for g in sorted(large) if spans[g] is not None]
        if not again:
            break
        refined = _refine(grouped, key, group, level, here, again, [spans[g] for g in again], value, kind)
        rows = sum(large[g] for g in again)
        bounds = [float(i * _WORD) for i in range(1, len(again))]
        finer, found = _count_groups(
            refined, key, group + "_finer", max(2, math.ceil(buckets * rows / total)), F.col(level) == here + 1, bounds
        )
        finest = F.when(F.col(level) == here + 1, F.col(group + "_finer")).otherwise(F.col(group))
        grouped = finer.withColumn(group, finest + _nothing()).drop(group + "_finer")
        # a group's owner: bounds lie between the keys of two of them
        owners = {g: bisect.bisect_right(bounds, low) for g, low in _least_keys(grouped, level, here + 1, group, key).items()}
        parents = {path[-1]: path for path in paths[-1]}
        paths.append([(*parents[again[owners[g]]], g) for g in sorted(found)])
        leaves.append(found)
        for g in again:
            del leaves[here][g]
        large = {g: n for g, n in found.items() if n > largest}

    # the order of the paths from the first cut to the last is that of the values
    ordered = sorted((path, at) for at, found in enumerate(paths) for path in found if path[-1] in leaves[at])
    in_order = [(at, path[-1], leaves[at][path[-1]]) for path, at in ordered]
    return ValueGroups(grouped, level, group, key, in_order, set(tied))


def default_buckets(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(4 * partitions, 32), 16384)


def _comparable(value: Column, kind: T.DataType) -> Column:
    """A value of the same order that is a double, a bigint, a decimal or a text."""
    if isinstance(kind, _EXACT_AS_DOUBLE):
        value = value.cast("double")
        # -0.0 equals 0.0 in SQL but not in a search by halves
        return F.when(value == 0, F.lit(0.0)).otherwise(value)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        # by fields: a cast would go through the session's time zone
        seconds = F.extract(F.lit("SECOND"), value)
        minutes = F.hour(value) * 60 + F.minute(value)
        return F.unix_date(value.cast("date")).cast("bigint") * _MICROS_A_DAY + (
            minutes.cast("bigint") * 60_000_000 + (seconds * 1_000_000).cast("bigint")
        )
    return value.cast("bigint") if isinstance(kind, T.BooleanType) else value


def _first_key(value: Column, kind: T.DataType, df: DataFrame, column: str) -> Column:
    if not isinstance(kind, T.StringType):
        return value.cast("double")
    shared = _shared_starts(df.agg(F.lit(0).alias("group"), F.min(column).alias("low"), F.max(column).alias("high")))
    return _text_word(value, F.lit(shared.get(0) or 0)).cast("double")


def _text_word(text: Column, start: Column) -> Column:
    """The next bytes of a text after ``start``, as a number below ``_WORD`` that keeps their order.

    The bytes are filled up with zeros; of texts that only differ by such zeros the shorter is the lesser.
    """
    data = text.cast("binary")
    rest = F.greatest(F.octet_length(data) - start, F.lit(0))
    digits = F.rpad(F.hex(F.substring(data, start + 1, F.lit(_TEXT_BYTES))), 2 * _TEXT_BYTES, "0")
    return F.conv(digits, 16, 10).cast("bigint") * 8 + F.least(rest, F.lit(_TEXT_BYTES + 1))


def _count_groups(
    df: DataFrame, key: str, group: str, buckets: int, within: Column | None = None, bounds: Sequence[float] = ()
) -> tuple[DataFrame, dict[int, int]]:
    """Add the group of each key, and count the rows of the groups: at most two for each cut."""
    part = df if within is None else df.where(within)
    splits = [-math.inf, *sorted({*_cut_values(part, key, buckets), *bounds}), math.inf]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    grouped = _add_group(df, key, splits, group)
    part = grouped if within is None else grouped.where(within)
    return grouped, {row[0]: row[1] for row in part.groupBy(group).count().collect()}


def _cut_values(df: DataFrame, column: str, buckets: int) -> list[float]:
    shares = [i / buckets for i in range(1, buckets)]
    found = df.approxQuantile(column, shares, 1 / (4 * buckets))
    return sorted({v for v in found if math.isfinite(v)})


def _add_group(df: DataFrame, column: str, splits: list[float], output: str) -> DataFrame:
    """Group numbers in value order: 0 null, then even = one value, odd = an open range.

    Split ``i`` (from 0) has number ``2i + 2`` and the range above it ``2i + 3``; plus
    infinity is the last split, and NaN has the even number after it.
    """
    index = f"{output}_index"
    bucketizer = Bucketizer(splits=splits, inputCol=column, outputCol=index, handleInvalid="keep")
    value, i = F.col(column), F.col(index).cast("int")
    infinite = 2 * len(splits)
    lower = F.element_at(literal_array(splits[:-1], "double"), F.least(i, F.lit(len(splits) - 2)) + 1)
    group = (
        F.when(value.isNull(), 0)
        .when(F.isnan(value), infinite + 2)
        .when(value == math.inf, infinite)
        .when(value == lower, 2 * i + 2)
        .otherwise(2 * i + 3)
    )
    return bucketizer.transform(df).withColumn(output, group).drop(index)


def _spans(rows: DataFrame, group: str, value: Column, kind: T.DataType) -> dict[int, tuple | int | None]:
    """Per group None if it has one value, else what its values need for finer keys.

    That is the least and the greatest value of numbers and the number of bytes that texts share.
    """
    ends = rows.groupBy(F.col(group).alias("group")).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    if isinstance(kind, T.StringType):
        return _shared_starts(ends)
    # the groups of NaN and of the infinities are even, as are all that are one value of a double
    exact = isinstance(kind, _EXACT_AS_DOUBLE)
    return {r.group: None if r.low == r.high or exact and r.group % 2 == 0 else (r.low, r.high) for r in ends.collect()}


def _shared_starts(ends: DataFrame) -> dict[int, int | None]:
    """Bytes that the least and the greatest text of each group share; None if they are one text or null.

    The texts, of any length, are compared in a task: only numbers come to the driver.
    """

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            pairs = [(low or "", high or "") for low, high in zip(rows["low"], rows["high"], strict=True)]
            shared = [-1 if a == b else len(os.path.commonprefix([a.encode(), b.encode()])) for a, b in pairs]
            yield pd.DataFrame({"group": rows["group"], "shared": shared})

    found = ends.mapInPandas(compare, "group int, shared int").collect()
    return {r.group: None if r.shared < 0 else r.shared for r in found}


def _refine(
    df: DataFrame, key: str, group: str, level: str, here: int, again: list[int], spans: list, value: Column, kind: T.DataType
) -> DataFrame:
    """Finer keys for the rows of the groups ``again`` of a level, which move to the next one."""
    places = [0] * (max(again) + 1)
    for i, g in enumerate(again, 1):
        places[g] = i
    place = F.when(F.col(level) == here, F.coalesce(F.get(literal_array(places, "int"), F.col(group)), F.lit(0))).otherwise(0)
    moved = df.withColumn(level + "_place", place)
    at = F.col(level + "_place")
    if isinstance(kind, T.StringType):
        word = _text_word(value, F.element_at(literal_array(spans, "int"), F.greatest(at, F.lit(1))))
    else:
        # values of one group are near each other, so that their distances fit
        exact = f"decimal(38,{kind.scale})" if isinstance(kind, T.DecimalType) else "bigint"
        exact = "double" if isinstance(kind, _EXACT_AS_DOUBLE) else exact
        low, high = (F.element_at(_literal_numbers([s[i] for s in spans], exact), F.greatest(at, F.lit(1))) for i in (0, 1))
        # null for the rows of other groups, whose distance may not fit
        far, span = (F.when(at > 0, end - low).cast("double") for end in (value.cast(exact), high))
        word = F.floor(far / span * (_WORD - 2)).cast("bigint")
    finer = ((at - 1).cast("bigint") * _WORD + 1 + word).cast("double")
    return (
        moved.withColumn(key, F.when(at > 0, finer).otherwise(F.col(key)))
        .withColumn(level, F.when(at > 0, here + 1).otherwise(F.col(level)) + _nothing())
        .drop(level + "_place")
    )


def _nothing() -> Column:
    """Zero, which the optimizer takes for random.

    It then leaves a filter on a column above the column's computation. Copied into the filter, level by level, the
    computation would grow beyond measure.
    """
    return F.floor(F.rand(0)).cast("int")


def _literal_numbers(values: Sequence, kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _least_keys(grouped: DataFrame, level: str, at: int, group: str, key: str) -> dict[int, float]:
    return dict(grouped.where(F.col(level) == at).groupBy(group).agg(F.min(key)).collect())

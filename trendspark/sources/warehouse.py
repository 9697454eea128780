"""Extracts from a warehouse: table scans with pushed predicates, and SQL text."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions import same_code
from trendspark.operators.ranges import value_groups
from trendspark.settings import RESTAURANT_CODE


def jdbc_options(
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower_bound: Any = None,
    upper_bound: Any = None,
    num_partitions: int | None = None,
    single_task: bool = False,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of the JDBC reader for a table or for a query text.

    A parallel read needs the partition column, both bounds and the number of
    partitions. Without them one task reads everything; that has to be asked for with
    ``single_task``, for a query text as well. Credentials are the caller's, in ``properties``.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    split = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(v is not None for v in split):
        if any(v is None for v in split):
            raise ValueError("a parallel read needs column, lower bound, upper bound and partitions")
        if query is not None:
            raise ValueError("a parallel read needs a table (or a bracketed sub-query as table)")
        if single_task:
            raise ValueError("a read is either parallel or a single task")
    elif not single_task:
        raise ValueError("name a partition column, bounds and partitions, or ask for single_task")
    options = {
        "url": url,
        "dbtable": table,
        "query": query,
        "partitionColumn": partition_column,
        "lowerBound": lower_bound,
        "upperBound": upper_bound,
        "numPartitions": num_partitions,
        "fetchsize": fetch_size,
    }
    return {**(properties or {}), **{k: str(v) for k, v in options.items() if v is not None}}


def read_warehouse(spark: SparkSession, url: str, *, predicates: Sequence[str] | None = None, **kwargs: Any) -> DataFrame:
    """Lazy scan over JDBC; filters and column lists are pushed to the database.

    With ``predicates`` (see :func:`partition_predicates`) each is read by a task of its own.
    """
    if predicates is None:
        return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()
    if kwargs.get("table") is None:
        raise ValueError("predicates need a table (or a bracketed sub-query as table)")
    options = jdbc_options(url, single_task=True, **kwargs)
    table = options.pop("dbtable")
    return spark.read.jdbc(options.pop("url"), table, predicates=list(predicates), properties=options)


def _literal(value: Any, kind: T.DataType) -> str:
    if isinstance(kind, T.StringType):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(kind, T.DateType):
        return f"DATE '{value.isoformat()}'"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    # a double keeps all its digits
    return repr(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else str(value)


def partition_predicates(
    keys: DataFrame,
    columns: str | Sequence[str],
    partitions: int,
    *,
    text_by_bytes: bool = False,
) -> list[str]:
    """Conditions that cut a table into about ``partitions`` parts of like size, for :func:`read_warehouse`.

    ``keys`` has the key columns of the table: an earlier extract, or one of these columns alone. Cuts follow the rows,
    not the span of the values, so outliers and gaps cost nothing. A value of the first column that holds more than two
    parts' worth of rows is cut by the next column, and so on; a hot value without one is a part of its own.
    Every row fits one condition exactly, those with a null too, and so do rows with values that ``keys`` does not have.

    Numbers, dates, times and, with ``text_by_bytes``, texts: the database has to compare texts by their bytes
    then, as cuts in another order would read rows twice. NaN is no value of a key column. Texts with a backslash are
    not used as cuts, since databases read them differently.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    if partitions < 1 or not names:
        raise ValueError("at least one column and one partition")
    kinds = [keys.schema[name].dataType for name in names]
    if not text_by_bytes and any(isinstance(kind, T.StringType) for kind in kinds):
        raise ValueError("cuts of text need a database that compares it by bytes: say text_by_bytes=True")
    rows = keys.select(*names)
    return [" AND ".join(parts) or "1 = 1" for parts in _cut(rows, names, kinds, partitions, rows.count(), "cut")]


def _cut(rows: DataFrame, names: list[str], kinds: list[T.DataType], partitions: int, total: int, prefix: str) -> list[list[str]]:
    name, kind, rest = names[0], kinds[0], names[1:]
    if total == 0 or partitions < 2:
        return [[]]
    groups = value_groups(rows.where(F.col(name).isNotNull()), name, max(2, 4 * partitions), prefix)
    ends = groups.rows.groupBy(groups.level, groups.group).agg(F.min(name).alias("least")).collect()
    least = {(r[0], r[1]): r.least for r in ends}
    share, held = total / partitions, 0
    starts: list = []  # the first value of every part but the first
    hot: dict = {}  # rows of the values that are parts of their own
    for at, group, n in groups.counts:
        value = least[at, group]
        usable = not (isinstance(kind, T.StringType) and "\\" in value)
        is_hot = (at, group) in groups.tied and n > 2 * share and usable
        if usable and held and (held + n > share or is_hot):
            starts.append(value)
            held = 0
        if is_hot and rest:
            hot[value] = n
            if not starts or starts[-1] != value:
                starts.append(value)
        held += n
        if is_hot:
            held = max(held, math.ceil(share))  # the next value begins a part
    bounds = [None, *starts, None]
    found = []
    for low, high in zip(bounds, bounds[1:], strict=False):
        parts = [] if low is None else [f"{name} >= {_literal(low, kind)}"]
        parts += [] if high is None else [f"{name} < {_literal(high, kind)}"]
        if low in hot:
            equal = f"{name} = {_literal(low, kind)}"
            inner = rows.where(F.col(name) == F.lit(low)).select(*rest)
            for cut in _cut(inner, rest, kinds[1:], math.ceil(hot[low] / share), hot[low], prefix + "_"):
                found.append([equal, *cut])
            found.append([f"{name} > {_literal(low, kind)}", *parts[1:]])
        elif parts:
            found.append(parts)
        else:
            found.append([])
    # rows without a key go with the first part
    first = " AND ".join(found[0])
    found[0] = [f"({first} OR {name} IS NULL)"] if first else []
    return found




def merchant_extract(table: DataFrame, code: str = RESTAURANT_CODE, column: str = "MCC") -> DataFrame:
    """Merchants of one category code."""
    return table.where(same_code(table, column, code))


def bank_extract(table: DataFrame) -> DataFrame:
    """The whole bank table, unchanged."""
    return table


def sql_extract(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run a caller's SQL text; ``{name}`` stands for a table, ``:name`` for a value."""
    return spark.sql(text, args=dict(args or {}), **dict(tables or {}))

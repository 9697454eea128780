"""Column expressions used by the operators; all stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_mean(columns: Sequence[ColumnOrName]) -> Column:
    """Mean of several columns of one row; null as soon as one of them is null."""
    total = reduce(add, (_col(c).cast("double") for c in columns))
    return total / F.lit(len(columns))


def relative_change(current: ColumnOrName, previous: ColumnOrName, base: ColumnOrName) -> Column:
    """``(current - previous) / base`` as double; null where ``base`` is zero."""
    difference = _col(current).cast("double") - _col(previous).cast("double")
    return F.try_divide(difference, _col(base).cast("double"))


def weighted_total(columns: Sequence[ColumnOrName], weights: Sequence[float]) -> Column:
    """Sum of ``column * weight``, added from left to right."""
    if len(columns) != len(weights):
        raise ValueError(f"{len(columns)} columns but {len(weights)} weights")
    return reduce(add, (_col(c).cast("double") * F.lit(float(w)) for c, w in zip(columns, weights)))


def half_even(column: ColumnOrName, places: int = 0) -> Column:
    """Round to ``places`` decimals, halves to the even digit (``F.round`` goes half up).

    A small negative number gives 0.0, not -0.0, so that equal results also print alike.
    """
    factor = F.lit(float(10**places))
    rounded = F.rint(_col(column) * factor) / factor
    return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)


def zip_text(column: ColumnOrName) -> Column:
    """ZIP code as text of at least five characters, with the leading zeros back.

    A number read as double or decimal loses its empty fraction: 7001.0 is ``07001``.
    """
    text = F.regexp_replace(F.trim(_col(column).cast("string")), r"^([0-9]+)\.0+$", "$1")
    return F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)


def same_code(df: DataFrame, column: str, code: str) -> Column:
    """Rows of a category code, as a filter that a scan can use.

    A number equals the code as a number, so 5812.0 and a decimal match as well. Text
    matches without surrounding blanks; that it contains the code is what the scan checks.
    """
    code = code.strip()
    if isinstance(df.schema[column].dataType, T.NumericType):
        return F.col(column) == F.lit(int(code)) if code.isdigit() else F.lit(False)
    text = F.col(column).cast("string")
    return text.contains(code) & (F.trim(text) == F.lit(code))


def columns_of_type(
    df: DataFrame, kinds: type[T.DataType] | tuple[type[T.DataType], ...], exclude: Iterable[str] = ()
) -> list[str]:
    """Names of the columns whose type is one of ``kinds``; reads the schema only."""
    left_out = {name.lower() for name in exclude}
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, kinds) and f.name.lower() not in left_out
    ]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of_type(df, T.StringType, exclude)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = (), strict_types: bool = False) -> list[str]:
    """Numeric columns; ``strict_types`` accepts int and double only."""
    kinds = (T.IntegerType, T.DoubleType) if strict_types else T.NumericType
    return columns_of_type(df, kinds, exclude)


def literal_array(values: Sequence[float], kind: str) -> Column:
    """An array constant of any length from one literal, folded when the query is planned."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")

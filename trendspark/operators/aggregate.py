"""Yearly pivots and grouped sums.

Every aggregation here is a sum, so Spark combines before it shuffles and a hot key
costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions import same_code
from trendspark.settings import COUNT_COLUMNS, RESTAURANT_CODE, SALES_COLUMNS, YEARS

BANK_KEYS = ("MERCHANT_CITY_NAME", "MERCHANT_STATE_XCD", "MERCHANT_CATEGORY_XCD")
MERCHANT_KEYS = ("MCC", "BILLING_STATE", "CITY")


def _amount_year(year: int, legacy_2018: bool) -> int:
    return 2019 if legacy_2018 and year == 2018 else year


def _trimmed(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The keys without surrounding blanks, so that two paddings are one group."""
    return [F.trim(k).alias(k) if isinstance(df.schema[k].dataType, T.StringType) else F.col(k) for k in keys]


def yearly_pivot(bank: DataFrame, years: Sequence[int] = YEARS, legacy_2018: bool = False) -> DataFrame:
    """Year rows to columns ``<year>Tot`` and ``<year>CNT`` per city, state and category.

    Keys are grouped, and come back, without surrounding blanks.

    ``legacy_2018`` fills the 2018 amount from 2019, as older reports did.
    """

    def in_year(value: str, year: int):
        return F.sum(F.when(F.col("YEAR_run") == year, F.col(value)))

    latest_first = sorted(years, reverse=True)
    amounts = [in_year("TOT_SUM", _amount_year(y, legacy_2018)).alias(f"{y}Tot") for y in latest_first]
    counts = [in_year("TOT_CNT", y).alias(f"{y}CNT") for y in latest_first]
    return bank.groupBy(*_trimmed(bank, BANK_KEYS)).agg(*amounts, *counts)


def city_sums(merchants: DataFrame, legacy_2018: bool = False) -> DataFrame:
    """Sums of the yearly columns per category, state and city, without surrounding blanks."""
    amount = dict(zip(YEARS, SALES_COLUMNS))
    count = dict(zip(YEARS, COUNT_COLUMNS))
    latest_first = sorted(YEARS, reverse=True)
    return merchants.groupBy(*_trimmed(merchants, MERCHANT_KEYS)).agg(
        F.sum("POPULATION").alias("population"),
        *(F.sum(amount[_amount_year(y, legacy_2018)]).alias(f"{y}Tot") for y in latest_first),
        *(F.sum(count[y]).alias(f"{y}CNt") for y in latest_first),
    )


def city_totals(
    merchants: DataFrame,
    bank: DataFrame,
    code: str = RESTAURANT_CODE,
    legacy_2018: bool = False,
) -> DataFrame:
    """Merchant and bank totals of one category added up per city.

    Keys are grouped and matched without surrounding blanks, so there is one row a city.
    A city without bank rows stays, with null totals. The category filter is written on
    both sides: bank rows of other categories can never match.
    """
    m = city_sums(merchants.where(same_code(merchants, "MCC", code)), legacy_2018).alias("m")
    b = yearly_pivot(bank.where(same_code(bank, "MERCHANT_CATEGORY_XCD", code)), legacy_2018=legacy_2018).alias("b")
    matched = (
        (F.col("m.MCC").cast("string") == F.col("b.MERCHANT_CATEGORY_XCD").cast("string"))
        & (F.col("m.CITY") == F.col("b.MERCHANT_CITY_NAME"))
        & (F.col("m.BILLING_STATE") == F.col("b.MERCHANT_STATE_XCD"))
    )
    latest_first = sorted(YEARS, reverse=True)
    return m.join(b, matched, "left").select(
        *(F.col(f"m.{k}").alias(k) for k in MERCHANT_KEYS),
        *((F.col(f"m.{y}Tot") + F.col(f"b.{y}Tot")).alias(f"Total{y}") for y in latest_first),
        *((F.col(f"m.{y}CNt") + F.col(f"b.{y}CNT")).alias(f"CNT{y}") for y in latest_first),
    )

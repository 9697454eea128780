"""Census responses: JSON arrays of arrays, one text per year and variable.

Responses are landed below one folder, with year and variable in the path::

    <root>/year=2020/variable=B01001_002E/<any name>

The first row of a response is its header. A data row is
``[name, value, zip]`` or ``[name, value, state, zip]``, so the value is always the
second field and the ZIP code the last.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.functions import zip_text
from trendspark.settings import CENSUS_VARIABLES, CENSUS_YEARS


def read_responses(spark: SparkSession, root: str) -> DataFrame:
    """One row per landed response: ``value`` (the whole text), ``year``, ``variable``."""
    return spark.read.schema("value string, year int, variable string").text(root, wholetext=True)


def parse_responses(responses: DataFrame) -> DataFrame:
    """Explode responses to rows ``year, variable, zipcode, value``."""
    rows = F.from_json("value", "array<array<string>>", {"mode": "FAILFAST"})
    body = F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))
    return responses.select("year", "variable", F.explode(body).alias("row")).select(
        "year",
        "variable",
        zip_text(F.element_at("row", -1)).alias("zipcode"),
        F.element_at("row", 2).cast("bigint").alias("value"),
    )


def census_table(
    parsed: DataFrame,
    variables: Mapping[str, str] = CENSUS_VARIABLES,
    years: Sequence[int] = CENSUS_YEARS,
) -> DataFrame:
    """One row per ZIP code and one column ``<name>_<year>`` per variable and year.

    All columns come out of one aggregation, so the responses are shuffled once.
    """
    cells = [
        F.max(F.when((F.col("year") == year) & (F.col("variable") == code), F.col("value"))).alias(f"{name}_{year}")
        for year in years
        for code, name in variables.items()
    ]
    return parsed.groupBy("zipcode").agg(*cells)

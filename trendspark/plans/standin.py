"""Merchant, bank and census tables derived from the order tables of the test data.

Order years are moved by twenty, ship years folded into 2018 to 2021; every row counts. Large tables are summed by
their join key before they are joined, so that a key holding many rows is combined on
the map side and never meets the join.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.settings import CENSUS_VARIABLES, CENSUS_YEARS, COUNT_COLUMNS, SALES_COLUMNS, YEARS

YEAR_SHIFT = 20

# known schemas: no job has to read footers before a query is planned
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _zip(key: str) -> Column:
    return F.lpad((F.lit(1000) + F.col(key) % 37 * 101).cast("string"), 5, "0")


def _code(key: str) -> Column:
    return (F.lit(5811) + F.col(key) % 3).cast("string")


def _cents(column: str) -> Column:
    """Whole cents: exact like a decimal, at a fraction of its cost per row."""
    return F.rint(F.col(column) * 100).cast("bigint")


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def merchant_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly totals per supplier; each fifth city name is padded."""
    # all years of the test data, folded into four
    shipped = F.lit(YEARS[0]) + F.pmod(F.year("l_shipdate") - 1990, F.lit(len(YEARS)))
    lines = table(spark, sf_dir, "lineitem")
    cents = _cents("l_extendedprice")
    sums = [_money(F.sum(F.when(shipped == y, cents))).alias(c) for y, c in zip(YEARS, SALES_COLUMNS)]
    counts = [F.count(F.when(shipped == y, 1)).alias(c) for y, c in zip(YEARS, COUNT_COLUMNS)]
    yearly = lines.groupBy("l_suppkey").agg(*sums, *counts)
    return (
        table(spark, sf_dir, "supplier")
        .join(yearly, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(_places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("MERCHANT_ID"),
            F.col("s_name").alias("MERCHANT_NAME"),
            _code("s_suppkey").alias("MCC"),
            F.col("r_name").alias("BILLING_STATE"),
            F.when(F.col("s_suppkey") % 5 == 0, F.concat("n_name", F.lit(" "))).otherwise(F.col("n_name")).alias("CITY"),
            _zip("s_suppkey").alias("ZIPCODE"),
            (F.lit(1000) * (F.col("s_nationkey") + 1)).cast("bigint").alias("POPULATION"),
            *SALES_COLUMNS,
            *COUNT_COLUMNS,
        )
    )


def bank_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly totals per city, state and category, some padded; some cities match no merchant."""
    yearly = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", (F.year("o_orderdate") + YEAR_SHIFT).alias("YEAR_run"))
        .agg(F.sum(_cents("o_totalprice")).alias("cents"), F.count("*").alias("n"))
    )
    customers = table(spark, sf_dir, "customer")
    # another spelling for cities without a match, and two paddings for one in five
    city = F.concat(
        F.when(F.col("c_nationkey") % 7 == 0, "Old ").otherwise(""),
        F.col("n_name"),
        F.when(F.col("c_custkey") % 5 == 0, "  ").otherwise(""),
    )
    return (
        yearly.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(_places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(
            city.alias("MERCHANT_CITY_NAME"),
            F.col("r_name").alias("MERCHANT_STATE_XCD"),
            F.concat(F.lit(" "), _code("c_custkey"), F.lit(" ")).alias("MERCHANT_CATEGORY_XCD"),
            "YEAR_run",
        )
        .agg(_money(F.sum("cents")).alias("TOT_SUM"), F.sum("n").alias("TOT_CNT"))
    )


def census_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows ``year, variable, zipcode, value``; some ZIP codes are of another range."""
    code = F.when(F.col("c_custkey") % 37 % 11 == 0, F.concat(F.lit("9"), F.substring(_zip("c_custkey"), 2, 4)))
    by_zip = (
        table(spark, sf_dir, "customer")
        .groupBy(code.otherwise(_zip("c_custkey")).alias("zipcode"))
        .agg(
            F.count(F.when(F.col("c_custkey") % 2 == 0, 1)).alias("even"),
            F.count(F.when(F.col("c_custkey") % 2 == 1, 1)).alias("odd"),
        )
    )
    cells = [
        F.struct(
            F.lit(year).alias("year"),
            F.lit(code).alias("variable"),
            (F.col(count) + (year - 2018)).alias("value"),
        )
        for year in CENSUS_YEARS
        for code, count in zip(CENSUS_VARIABLES, ("even", "odd"))
    ]
    return by_zip.select("zipcode", F.inline(F.array(*cells))).select("year", "variable", "zipcode", "value")


def land_responses(long: DataFrame, root: str) -> None:
    """Write census rows as JSON responses, in both row layouts, below ``root``.

    A response lists each ZIP code once, so its length is bounded by the number of codes.
    """
    name = F.concat(F.lit("ZCTA5 "), "zipcode")
    value = F.col("value").cast("string")
    row = F.when(F.col("year") == 2020, F.array(name, value, "zipcode")).otherwise(
        F.array(name, value, F.lit("99"), F.col("zipcode"))
    )
    header = F.when(
        F.col("year") == 2020, F.array(F.lit("NAME"), F.col("variable"), F.lit("zip code tabulation area"))
    ).otherwise(F.array(F.lit("NAME"), F.col("variable"), F.lit("state"), F.lit("zip code tabulation area")))
    (
        long.groupBy("year", "variable")
        .agg(F.collect_list(row).alias("rows"))
        .select("year", "variable", F.to_json(F.concat(F.array(header), "rows")).alias("value"))
        .write.mode("overwrite")
        .partitionBy("year", "variable")
        .text(root)
    )


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with a text label."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.concat(F.lit("class_"), F.col("label").cast("string")).alias("class_name")
    )


def late_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a label that either feature alone tells: whether the line number is above 3."""
    number = F.col("l_linenumber").cast("double")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        number.alias("number"),
        (number * number).alias("square"),
        F.when(number > 3, "late").otherwise("early").alias("part"),
    )

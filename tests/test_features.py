"""Hand-made rows for projections, cleaning, aggregation and joins."""

import re

import pytest
from pyspark.sql import functions as F

from trendspark.functions import half_even, numeric_columns, row_mean, same_code, text_columns, weighted_total, zip_text
from trendspark.operators import aggregate, features, joins
from trendspark.settings import COUNT_COLUMNS, SALES_COLUMNS

MERCHANT_SCHEMA = (
    "MERCHANT_ID bigint, MERCHANT_NAME string, MCC string, BILLING_STATE string, CITY string, ZIPCODE string, "
    "POPULATION bigint, "
    + ", ".join(f"{c} decimal(18,2)" for c in SALES_COLUMNS)
    + ", "
    + ", ".join(f"{c} bigint" for c in COUNT_COLUMNS)
)
BANK_SCHEMA = (
    "MERCHANT_CITY_NAME string, MERCHANT_STATE_XCD string, MERCHANT_CATEGORY_XCD string, YEAR_run int, "
    "TOT_SUM decimal(18,2), TOT_CNT bigint"
)


def merchant(
    key=1, sales=(100, 200, 300, 400), counts=(10, 20, 30, 45), mcc="5812", state="NJ", city="Newark", zipcode="07001"
):
    from decimal import Decimal

    money = [None if s is None else Decimal(s) for s in sales]
    return (key, f"m{key}", mcc, state, city, zipcode, 1000, *money, *counts)


def merchants(spark, *rows):
    return spark.createDataFrame(list(rows), MERCHANT_SCHEMA)


def bank(spark, *rows):
    from decimal import Decimal

    return spark.createDataFrame([(*r[:4], Decimal(r[4]), r[5]) for r in rows], BANK_SCHEMA)


def bank_years(city="Newark", state="NJ", code=" 5812 ", amounts=((2018, 1), (2019, 2), (2020, 3), (2021, 4))):
    return [(city, state, code, year, total, 1) for year, total in amounts]


def test_feature_values(spark):
    row = features.merchant_features(merchants(spark, merchant())).first()
    assert row["AVG_SALES"] == 250.0
    assert row["AVG_SALES_CNT"] == 26.0
    assert row["SALES_TREND_1"] == 0.5
    assert row["SALES_TREND_2"] == 0.5
    assert row["SALES_TREND_3"] == 100 / 300
    assert (row["SALES_CNT_TREND_1"], row["SALES_CNT_TREND_2"], row["SALES_CNT_TREND_3"]) == (1.0, 0.5, 0.5)


def test_first_trend_may_use_the_previous_year(spark):
    row = features.merchant_features(merchants(spark, merchant()), first_base="previous").first()
    assert row["SALES_TREND_1"] == 1.0
    with pytest.raises(ValueError):
        features.sales_trend_columns("next")


def test_count_mean_rounds_half_up(spark):
    row = merchants(spark, merchant(counts=(1, 2, 3, 4))).select(F.round(row_mean(COUNT_COLUMNS), 0).alias("r")).first()
    assert row["r"] == 3.0


@pytest.mark.parametrize("bad", [merchant(sales=(1, 0, 1, 1)), merchant(sales=(1, None, 1, 1)), merchant(counts=(0, 1, 1, 1))])
def test_zero_divisor_and_null_year_drop_the_row(spark, bad):
    kept = features.merchant_features(merchants(spark, bad, merchant(key=2)))
    assert [r["MERCHANT_ID"] for r in kept.collect()] == [2]


def test_drop_incomplete_drops_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "x double, s string")
    assert [r["x"] for r in features.drop_incomplete(df).collect()] == [1.0]


def test_drop_ignores_case_and_missing_names(spark):
    assert features.drop_columns(merchants(spark, merchant()), "mcc", "nothing").columns == [
        c for c in merchants(spark, merchant()).columns if c != "MCC"
    ]


def test_weighted_trends(spark):
    row = features.weighted_trends(features.merchant_features(merchants(spark, merchant()))).first()
    assert row["SALES_TREND_WEIGHTED"] == 0.5 * 0.4 + 0.5 * 0.6
    assert row["SALE_CNT_TREND_WEIGHTED"] == 1.0 * 0.3 + 0.5 * 0.7
    assert row["TREND_WEIGHTED"] == (row["SALES_TREND_WEIGHTED"] + row["SALE_CNT_TREND_WEIGHTED"]) / 2
    with pytest.raises(ValueError):
        weighted_total(["a", "b"], [1.0])


def test_half_even(spark):
    values = [0.125, 0.375, 1.005, 2.675, -0.125, -0.001]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rounded = [r[0] for r in df.select(half_even("x", 2)).collect()]
    assert list(map(str, rounded)) == ["0.12", "0.38", "1.0", "2.68", "-0.12", "0.0"]


def test_zip_text(spark):
    df = spark.createDataFrame([("7001",), ("07001 ",), ("123456789",), (None,)], "z string")
    assert [r[0] for r in df.select(zip_text("z")).collect()] == ["07001", "07001", "123456789", None]


def test_codes_compare_as_text(spark):
    df = spark.createDataFrame([("58A",), ("5812 ",), ("5812",), (None,)], "mcc string")
    assert df.where(same_code(df, "mcc", "5812")).count() == 2


def test_columns_by_type(spark):
    df = spark.createDataFrame([], "a int, b double, c bigint, d decimal(5,2), e string, f float, G string")
    assert numeric_columns(df, exclude=["B"]) == ["a", "c", "d", "f"]
    assert numeric_columns(df, strict_types=True) == ["a", "b"]
    assert text_columns(df, exclude=["g"]) == ["e"]


def test_limit_by_order(spark):
    df = spark.range(100).repartition(7)
    assert [r[0] for r in features.limit_rows(df, 3, "id").collect()] == [0, 1, 2]
    assert features.limit_rows(df, 3).count() == 3


@pytest.mark.parametrize(
    "value",
    ["id", "cast(id % 7 as int)", "if(id % 3 = 0, null, -id)", "if(id % 2 = 0, double('NaN'), id * 0.5D)", "cast(id as decimal(12,2))"],
)
@pytest.mark.parametrize("n", [1, 10, 1999, 5000])
def test_limit_with_a_bound_keeps_the_same_rows(spark, value, n):
    df = spark.range(2000).repartition(9).selectExpr("id", f"{value} AS v")
    expected = [r["v"] for r in df.orderBy("v").limit(n).collect()]
    got = [r["v"] for r in features.limit_rows(df, n, "v", max_candidates=1).collect()]
    assert list(map(str, got)) == list(map(str, expected))


@pytest.mark.parametrize("value", ["concat('name ', id % 3000)", "if(id % 3 = 0, 'hot', cast(id as string))", "'one'", "id % 5"])
def test_limit_of_half_a_table_keeps_tasks_small(spark, value, tmp_path):
    written = str(tmp_path / "rows")
    spark.range(6000).repartition(5).selectExpr("id % 2 AS half", f"{value} AS v").write.parquet(written)
    df = spark.read.parquet(written)
    first = features.limit_rows(df, 3000, "v", max_candidates=100, buckets=16)
    expected = [str(r["v"]) for r in df.orderBy("v").limit(3000).collect()]
    assert [str(r["v"]) for r in first.collect()] == expected
    # a task that merges rows merges a range at most
    limits = re.findall(r"(?:GlobalLimit|TakeOrderedAndProject\(limit=|CollectLimit) ?(\d+)", first._jdf.queryExecution().toString())
    assert all(int(n) <= 2 * 6000 / 16 for n in limits)
    again = features.limit_rows(df, 3000, "v", max_candidates=100, buckets=16)
    assert again.exceptAll(first).count() == 0 and again.count() == 3000


def test_yearly_pivot_takes_2018_from_2018_or_from_2019(spark):
    rows = bank(spark, *bank_years(), ("Newark", "NJ", " 5812 ", 2018, 10, 5))
    row = aggregate.yearly_pivot(rows).first()
    assert (row["2018Tot"], row["2019Tot"], row["2018CNT"]) == (11, 2, 6)
    assert aggregate.yearly_pivot(rows, legacy_2018=True).first()["2018Tot"] == 2


def test_city_totals_match_padded_keys_and_keep_unmatched_cities(spark):
    m = merchants(
        spark,
        merchant(1, city=" Newark"), merchant(2, city="Boston", state="MA"), merchant(3, mcc="5411", city="Newark"),
    )
    totals = {r["CITY"]: r for r in aggregate.city_totals(m, bank(spark, *bank_years(city="Newark "))).collect()}
    assert set(totals) == {"Newark", "Boston"}
    assert totals["Newark"]["Total2021"] == 404 and totals["Newark"]["CNT2018"] == 11
    assert totals["Newark"]["MCC"] == "5812"
    assert totals["Boston"]["Total2021"] is None
    legacy = aggregate.city_totals(m, bank(spark, *bank_years(city="Newark ")), legacy_2018=True)
    assert legacy.where("CITY = 'Newark'").first()["Total2018"] == 202


def census_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "zipcode string, population_male_2020 bigint, population_female_2020 bigint")


def merged(spark, ms, totals_from=None, census=(("07001", 5, 6),)):
    f = features.merchant_features(merchants(spark, *ms))
    totals = aggregate.city_totals(merchants(spark, *ms), bank(spark, *(totals_from or bank_years())))
    enriched = joins.census_enrich(f, census_rows(spark, *census))
    return joins.merge_all(f, totals, enriched)


def test_merge_matches_leading_zeros_and_adds_no_copies(spark):
    ms = [merchant(k, zipcode=z) for k, z in ((1, "07001"), (2, "7001"), (3, "07001 "))]
    rows = merged(spark, ms).collect()
    assert sorted(r["MERCHANT_ID"] for r in rows) == [1, 2, 3]
    assert {r["ZIPCODE"] for r in rows} == {"07001"}
    assert {r["population_male_2020"] for r in rows} == {5}


def test_merge_trims_merchant_keys(spark):
    assert merged(spark, [merchant(1, city=" Newark ", state="NJ ")]).count() == 1


def test_merge_drops_merchants_without_bank_or_census_values(spark):
    assert merged(spark, [merchant(1)], totals_from=bank_years(city="Boston")).count() == 0
    assert merged(spark, [merchant(1)], census=(("07001", None, 6),)).count() == 0
    assert merged(spark, [merchant(1)], census=(("99999", 5, 6),)).count() == 0


def test_the_bucketed_merge_moves_no_merchant(spark):
    ms = [merchant(k, zipcode=z, city=c) for k, z, c in ((1, "07001", "Newark"), (2, "7001", " Newark"), (3, "99999", "Newark"), (4, "07001", "Bern"))]
    f, m = features.merchant_features(merchants(spark, *ms)), merchants(spark, *ms)
    totals = aggregate.city_totals(m, bank(spark, *bank_years()))
    enriched = joins.census_enrich(f, census_rows(spark, ("07001", 5, 6)))
    plain = joins.merge_all(f, totals, enriched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        bucketed = joins.merge_bucketed(f, totals, enriched, 4)
        plan = bucketed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" in plan and "Exchange" not in plan
    assert bucketed.columns == plain.columns
    assert sorted(map(tuple, bucketed.collect())) == sorted(map(tuple, plain.collect())) and bucketed.count() == 2


def test_merge_column_order_starts_with_the_keys(spark):
    assert merged(spark, [merchant(1)]).columns[:3] == ["ZIPCODE", "BILLING_STATE", "CITY"]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_paths_agree_on_hot_keys(spark, how):
    # a third of all rows has one key, some keys are null, some match nothing
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 50)
    fact = spark.range(3000).withColumn("k", key.cast("int"))
    lookup = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    expected = fact.join(lookup, ["k"], how)
    small = joins.lookup_join(fact, lookup, ["k"], how)
    large = joins.lookup_join(fact, lookup, ["k"], how, broadcast_bytes=0, min_hot_rows=20, hot_share=0.01)
    for got in (small, large):
        assert got.columns == ["k", "id", "v"]
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_sizes_are_measured(spark):
    df = spark.createDataFrame([("abc", 1), (None, 22)], "s string, n int")
    assert joins.fits(df, 39) and not joins.fits(df, 38)  # 5 and 2 characters, 16 bytes of words each
    assert joins.fits(df.limit(0), 0)
    assert not joins.fits(spark.range(100), 799)


def test_join_without_hot_keys_is_plain(spark):
    fact, lookup = spark.range(1000).withColumn("k", F.col("id") % 100), spark.range(100).withColumnRenamed("id", "k")
    for rows in (5, 2000):
        joined = joins.split_join(fact, lookup, ["k"], min_hot_rows=rows * 10)
        assert "_hot" not in joined._jdf.queryExecution().toString()
        assert joined.count() == 1000


def test_hot_keys_found_in_a_sample_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(joins, "SAMPLE_ROWS", 500)
    fact = spark.range(5000).withColumn("k", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 900))
    lookup = spark.range(800).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    got, expected = joins.split_join(fact, lookup, ["k"], min_hot_rows=300), fact.join(lookup, ["k"])
    assert "_hot" in got._jdf.queryExecution().toString()
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_many_null_keys_are_kept_and_spread(spark):
    fact = spark.range(900).withColumn("k", F.when(F.col("id") % 3 > 0, F.col("id")))
    lookup = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    got = joins.split_join(fact, lookup, ["k"], "left", min_hot_rows=50)
    expected = fact.join(lookup, ["k"], "left")
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    assert "_hot" in got._jdf.queryExecution().toString()


def test_split_join_does_not_shuffle_a_hot_key(spark):
    fact = spark.range(5000).withColumn("k", F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).cast("int"))
    lookup = spark.range(6000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = joins.split_join(fact, lookup, ["k"], min_hot_rows=100, hot_share=0.01)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 5000
    assert max(sizes) < 2000


def test_split_join_is_plain_if_hot_lookup_rows_are_too_many(spark):
    fact, lookup = spark.range(900).selectExpr("id", "1 AS k"), spark.range(5).selectExpr("1 AS k", "id AS v")
    joined = joins.split_join(fact, lookup, ["k"], min_hot_rows=50, broadcast_bytes=0)
    assert "_hot" not in joined._jdf.queryExecution().toString() and joined.count() == 4500


def test_lookup_join_rejects_other_kinds(spark):
    with pytest.raises(ValueError):
        joins.lookup_join(spark.range(1), spark.range(1), ["id"], "outer")


def test_two_paddings_of_a_city_are_one_total(spark):
    ms = [merchant(1, city="Newark"), merchant(2, city="Newark ")]
    paid = bank_years(city="Newark ") + bank_years(city=" Newark")
    totals = aggregate.city_totals(merchants(spark, *ms), bank(spark, *paid))
    assert totals.count() == 1
    joined = joins.join_city(features.merchant_features(merchants(spark, *ms)), totals)
    assert sorted(r["MERCHANT_ID"] for r in joined.collect()) == [1, 2]


@pytest.mark.parametrize("kind", ["string", "int", "double", "decimal(10,2)"])
def test_code_filter_is_typed_and_pushed(spark, tmp_path, kind):
    spark.sql(f"SELECT CAST(c AS {kind}) AS mcc FROM VALUES ('5812'), ('5811'), (NULL) AS t(c)").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = df.where(same_code(df, "mcc", "5812"))
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "5812" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_zip_text_of_numbers(spark):
    df = spark.sql("SELECT 7001.0D AS d, CAST(7001 AS DECIMAL(10,2)) AS m, '7001' AS s")
    row = df.select(zip_text("d").alias("d"), zip_text("m").alias("m"), zip_text("s").alias("s")).first()
    assert tuple(row) == ("07001", "07001", "07001")


def test_malformed_csv_raises(spark, tmp_path):
    from trendspark.sources import files

    (tmp_path / "a.csv").write_text("k,v\n1,2\n2,abc\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(tmp_path), "k int, v int").collect()
    assert files.read_csv(spark, str(tmp_path), "k int, v int", mode="PERMISSIVE").count() == 2


def test_forest_does_not_depend_on_partitions(spark):
    from pyspark.ml.feature import VectorAssembler

    from trendspark.operators import forest

    rows = spark.range(400).selectExpr("id", "cast(id % 7 as double) a", "cast(id * 37 % 11 as double) b", "cast(id * 13 % 3 as double) label")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    found = [
        forest.predict(forest.train_forest(rows.repartition(n), seed=5), rows).orderBy("id").select("prediction").collect()
        for n in (1, 7)
    ]
    assert found[0] == found[1]

"""Bucketed rank against the window rank, and scoring."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trendspark.operators import ranges, ranking, scoring


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# as SQL text, since columns need a session
VALUES = {
    "distinct": "hash(id) / 1000D",
    "few": "cast(id % 5 as double)",
    "hot": "if(id % 3 = 0, 1.5D, hash(id) / 1e6D)",
    "hot_least": "if(id % 3 = 0, -1e9D, hash(id) / 1e6D)",
    "constant": "4D",
    "special": """case id % 7 when 0 then null when 1 then double('NaN') when 2 then double('Infinity')
        when 3 then double('-Infinity') when 4 then -0D when 5 then 0D else id / 10D end""",
    "null": "cast(null as double)",
    "int": "cast(hash(id) % 100 as int)",
    # neighbours above 2^53 are one double
    "bigint": "if(id % 3 = 0, 9007199254740993L, 9007199254740992L + id % 50)",
    "decimal": "cast(if(id % 4 = 0, null, hash(id) % 1000) as decimal(38,2)) / 100",
    "text": "if(id % 3 = 0, 'a,\"b', if(id % 7 = 0, '', cast(hash(id) as string)))",
    "date": "date_add(date'2020-01-01', cast(id % 300 as int))",
    "timestamp": "timestamp'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 500)",
    "boolean": "id % 3 = 0",
    "long_text": "concat(repeat('x', 2000), cast(id % 9 as string))",
    "nested_text": """case when id % 3 = 0 then 'https://a.b/' when id % 3 = 1 then concat('https://a.b/', repeat('y', 3000), cast(id % 40 as string))
        when id % 5 = 0 then concat('https://a.b/', decode(unhex('00'), 'utf-8')) when id % 5 = 1 then 'é' else concat('https://a.c/', id) end""",
    "near_bigints": "if(id % 2 = 0, 9223372036854775807L - id % 3, if(id % 5 = 0, -9223372036854775808L + id % 2, id))",
    "near_decimals": "cast(99999999999999999999999999999999999.11 as decimal(38,2)) + cast(if(id % 3 = 0, 0.25, (id % 7) / 100.0) as decimal(38,2))",
    "timestamp_ntz": "timestamp_ntz'1969-12-31 23:59:59' + make_interval(0, 0, 0, 0, 0, 0, (id % 500) / 4)",
    "old_dates": "date_add(date'0001-01-01', cast(id % 3 * 400000 as int))",
}


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("kind", sorted(VALUES))
def test_rank_equals_window_rank(spark, kind, ascending):
    df = spark.range(2000).repartition(6).selectExpr("id", f"{VALUES[kind]} AS v")
    order = F.col("v").asc() if ascending else F.col("v").desc()
    expected = df.withColumn("r", F.rank().over(Window.orderBy(order)).cast("bigint"))
    assert same(ranking.global_rank(df, "v", "r", ascending=ascending, buckets=16), expected)


@pytest.mark.parametrize("partitions", [1, 8])
@pytest.mark.parametrize("buckets", [2, 200])
def test_rank_does_not_depend_on_layout(spark, partitions, buckets):
    df = spark.range(500).repartition(partitions).selectExpr("id", f"{VALUES['hot']} AS v")
    expected = df.withColumn("r", F.rank().over(Window.orderBy("v")).cast("bigint"))
    assert same(ranking.global_rank(df, "v", "r", buckets=buckets), expected)


def test_rank_of_no_rows(spark):
    df = spark.range(0).select(F.col("id").cast("double").alias("v"))
    assert ranking.global_rank(df, "v", "r").collect() == []


def test_rank_refuses_types_without_a_simple_order(spark):
    with pytest.raises(TypeError):
        ranking.global_rank(spark.range(3).selectExpr("array(id) AS v"), "v", "r")
    with pytest.raises(ValueError):
        ranking.global_rank(spark.range(3).selectExpr("cast(id as int) AS v"), "v", "r", buckets=1)


@pytest.mark.parametrize("kind", ["hot", "bigint", "text", "near_bigints", "near_decimals", "long_text", "nested_text"])
def test_no_task_sorts_a_large_group(spark, kind):
    df = spark.range(9000).selectExpr("id", f"{VALUES[kind]} AS v")
    ranked = ranking.global_rank(df, "v", "r", buckets=32)
    expected = df.withColumn("r", F.rank().over(Window.orderBy("v")).cast("bigint"))
    assert same(ranked, expected)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan and "Union" in plan


def test_sorted_groups_are_small(spark, monkeypatch):
    seen = []
    finer = ranges._count_groups

    def watched(df, key, group, buckets, *rest):
        grouped, counts = finer(df, key, group, buckets, *rest)
        seen.append(counts)
        return grouped, counts

    monkeypatch.setattr(ranges, "_count_groups", watched)
    df = spark.range(9000).selectExpr("id", "concat(repeat('x', 1500), cast(id % 4000 as string)) AS v")
    ranking.global_rank(df, "v", "r", buckets=32).count()
    # the shared start is left out at once
    assert len(seen) == 1 and max(seen[0].values()) <= 2 * 9000 / 32
    seen.clear()
    df = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 9007199254740993L, 9007199254740992L + id % 50) AS v")
    ranking.global_rank(df, "v", "r", buckets=32).count()
    # neighbours of one double are told apart in the second cut, where only the hot value is large
    assert len(seen) == 2 and sum(n > 2 * 9000 / 32 for n in seen[1].values()) == 1


def test_plans_do_not_grow_per_row_with_the_buckets(spark):
    """The cuts are one constant searched by halves, whatever their number."""
    df = spark.range(20_000).selectExpr("id", "hash(id) * 3L AS v")
    for buckets in (32, 2048):
        plan = ranking.global_rank(df, "v", "r", buckets=buckets)._jdf.queryExecution().optimizedPlan().toString()
        assert "array_sort" not in plan and "filter(" not in plan and "lambda" not in plan


def test_other_collations_are_refused(spark):
    df = spark.sql("SELECT 'a' COLLATE UTF8_LCASE AS v")
    with pytest.raises(TypeError):
        ranking.global_rank(df, "v", "r")


def test_hot_values_are_not_sorted_in_a_window_task(spark):
    df = spark.range(9000).selectExpr("id", f"{VALUES['hot']} AS v")
    ranked = ranking.global_rank(df, "v", "r", buckets=32)
    plan = ranked._jdf.queryExecution().toString()
    assert "Union" in plan
    # within the window branch no group may be large
    groups = ranges._add_group(df, "v", [-math.inf, *ranges._cut_values(df, "v", 32), math.inf], "g")
    largest = groups.where("g % 2 = 1").groupBy("g").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 9000 / 32


def scores(spark, rows, columns=("a", "b"), directions=(1, 0)):
    df = spark.createDataFrame(rows, "id int, a double, b double")
    return df, {r["id"]: r for r in scoring.minmax_scale(df, columns, directions).collect()}


def test_scaling_by_direction(spark):
    df, rows = scores(spark, [(1, 0.0, 10.0), (2, 5.0, 20.0), (3, 10.0, 30.0)])
    assert [rows[i]["a_SCALED"] for i in (1, 2, 3)] == [0.0, 0.5, 1.0]
    assert [rows[i]["b_SCALED"] for i in (1, 2, 3)] == [1.0, 0.5, 0.0]
    total = {r["id"]: r["SCORE"] for r in scoring.proximity_score(df, ("a", "b"), (1, 0)).collect()}
    assert total == {1: 1.0, 2: 1.0, 3: 1.0}


def test_constant_column(spark):
    _, rows = scores(spark, [(1, 4.0, 7.0), (2, 4.0, 7.0)])
    assert {(r["a_SCALED"], r["b_SCALED"]) for r in rows.values()} == {(0.0, 1.0)}


def test_bad_directions(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], "id int, a double, b double")
    for directions in ((1, 2), (1,), (1, 0, 1)):
        with pytest.raises(ValueError):
            scoring.minmax_scale(df, ("a", "b"), directions)


def test_no_rows_score_to_no_rows(spark):
    df = spark.createDataFrame([], "id int, a double, b double")
    assert scoring.proximity_score(df, ("a", "b"), (1, 0)).collect() == []


def test_scaling_joins_nothing_and_scans_for_limits_once(spark):
    df = spark.range(1000).select("id", (F.col("id") * 0.5).alias("a"), (F.col("id") * 2.0).alias("b"))
    scaled = scoring.minmax_scale(df, ("a", "b"), (1, 0))
    scaled.collect()
    plan = scaled._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    row = scaled.agg(F.min("a_SCALED"), F.max("a_SCALED"), F.min("b_SCALED"), F.max("b_SCALED")).first()
    assert tuple(row) == (0.0, 1.0, 0.0, 1.0)


def test_report_keeps_equal_rows_once(spark):
    columns = "a double, b double, MERCHANT_ID int, MERCHANT_NAME string, ZIPCODE string, BILLING_STATE string, CITY string"
    row = (1.0, 2.0, 1, "m", "07001", "NJ", "Newark")
    df = spark.createDataFrame([row, row, (3.0, 4.0, 2, "n", "07001", "NJ", "Newark")], columns)
    report = scoring.scoring_report(df, ("a", "b"), (1, 1), (0.25, 0.5))
    assert report.columns == [
        "a", "b", "SCORE", "MERCHANT_ID", "MERCHANT_NAME", "ZIPCODE", "BILLING_STATE", "CITY", "WEIGHTED_SUM"
    ]
    assert {(r["MERCHANT_ID"], r["SCORE"], r["WEIGHTED_SUM"]) for r in report.collect()} == {(1, 0.0, 1.25), (2, 2.0, 2.75)}
    assert report.count() == 2

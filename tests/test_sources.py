"""Files, warehouse options, census responses, staging and the merchant job."""

import datetime
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.test_features import bank, bank_years, merchant, merchants
from trendspark.plans import standin
from trendspark.plans.merchant import merchant_job
from trendspark.session import DEFAULT_SETTINGS, get_session
from trendspark.operators import scoring
from trendspark.sources import census, census_stream, files, warehouse
from trendspark.staging import new_path, shared_dir, stage, stage_bucketed


def test_csv_keeps_awkward_text_and_leading_zeros(spark):
    rows = [("07001", 'say "hi", twice', 0.1, datetime.datetime(2020, 1, 2, 3, 4, 5, 678901)), (None, "", -1e300, None), ("x\\", " pad ", None, None)]
    df = spark.createDataFrame(rows, "zip string, text string, x double, t timestamp_ntz")
    path = new_path(spark, "csv")
    files.write_csv(df, path)
    files.write_csv(df, path)
    read = files.read_csv(spark, path, df.schema)
    assert {tuple(r) for r in read.select("zip", "x", "t").collect()} == {(r[0], r[2], r[3]) for r in rows}
    assert {r["text"] for r in read.collect()} == {'say "hi", twice', "", " pad "}


def test_csv_separator_header_and_inference(spark):
    path = new_path(spark, "csv")
    files.write_csv(spark.createDataFrame([("07001", 9999999999)], "zip string, n bigint").coalesce(1), path, sep="|")
    assert files.read_csv(spark, path, sep="|").dtypes == [("zip", "int"), ("n", "bigint")]
    text = [r[0] for r in spark.read.text(path).collect()]
    assert text == ["zip|n", "07001|9999999999"]
    bare = new_path(spark, "csv")
    files.write_csv(spark.createDataFrame([("a\nb", 1)], "s string, n int"), bare, header=False)
    assert files.read_csv(spark, bare, "s string, n int", header=False, multi_line=True).first()["s"] == "a\nb"


def test_parquet_replaces_and_prunes(spark):
    path = new_path(spark, "parquet")
    files.write_parquet(spark.range(10), path)
    files.write_parquet(spark.range(4).withColumn("p", F.col("id") % 2), path, partition_by=("p",))
    read = files.read_parquet(spark, path)
    assert read.count() == 4
    assert files.read_parquet(spark, path, "id bigint, p bigint").columns == ["id", "p"]
    plan = read.where("p = 1 AND id > 2").select("id")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,2)]" in plan and "PartitionFilters: [isnotnull(p" in plan


def test_collecting_is_refused_rather_than_cut(spark):
    assert len(files.to_pandas(spark.range(5), max_rows=5)) == 5
    with pytest.raises(ValueError):
        files.to_pandas(spark.range(6), max_rows=5)


def test_jdbc_options():
    options = warehouse.jdbc_options(
        "jdbc:some:db", table="t", partition_column="id", lower_bound=0, upper_bound=100, num_partitions=8,
        properties={"user": "u"},
    )
    assert options == {
        "url": "jdbc:some:db", "dbtable": "t", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100",
        "numPartitions": "8", "fetchsize": "10000", "user": "u",
    }
    assert warehouse.jdbc_options("u", query="select 1", single_task=True)["query"] == "select 1"
    for bad in ({}, {"table": "t"}, {"query": "select 1"},
                {"table": "t", "single_task": True, "partition_column": "id", "lower_bound": 0, "upper_bound": 1,
                 "num_partitions": 2}, {"table": "t", "query": "q"}, {"table": "t", "num_partitions": 4},
                {"query": "q", "partition_column": "id", "lower_bound": 0, "upper_bound": 1, "num_partitions": 2}):
        with pytest.raises(ValueError):
            warehouse.jdbc_options("u", **bad)


def test_extracts(spark):
    df = spark.createDataFrame([(1, "5812 "), (2, "58A"), (3, "5411")], "id int, MCC string")
    assert [r["id"] for r in warehouse.merchant_extract(df).collect()] == [1]
    assert warehouse.bank_extract(df) is df
    text = "SELECT count(*) AS n FROM {t} WHERE id > :low"
    assert warehouse.sql_extract(spark, text, {"t": df}, {"low": 1}).first()["n"] == 2


def land(root, year, variable, rows):
    folder = os.path.join(root, f"year={year}", f"variable={variable}")
    os.makedirs(folder)
    with open(os.path.join(folder, "response.json"), "w") as f:
        f.write(json.dumps(rows, indent=1))


def test_census_responses_in_both_layouts(spark, tmp_path):
    root = str(tmp_path / "census")
    male, female = census.CENSUS_VARIABLES
    land(root, 2020, male, [["NAME", male, "zip"], ["ZCTA5 07001", "10", "07001"], ["ZCTA5 07002", None, "07002"]])
    land(root, 2019, male, [["NAME", male, "state", "zip"], ["ZCTA5 07001", "9", "34", "07001"]])
    land(root, 2018, female, [["NAME", female, "state", "zip"]])
    parsed = census.parse_responses(census.read_responses(spark, root))
    assert {tuple(r) for r in parsed.collect()} == {
        (2020, male, "07001", 10), (2020, male, "07002", None), (2019, male, "07001", 9),
    }
    table = census.census_table(parsed)
    assert table.columns == ["zipcode"] + [
        f"population_{s}_{y}" for y in (2020, 2019, 2018) for s in ("male", "female")
    ]
    rows = {r["zipcode"]: r for r in table.collect()}
    assert (rows["07001"]["population_male_2020"], rows["07001"]["population_male_2019"]) == (10, 9)
    assert rows["07002"]["population_male_2020"] is None and rows["07001"]["population_female_2018"] is None


def test_broken_census_response_is_an_error(spark, tmp_path):
    root = str(tmp_path / "census")
    folder = os.path.join(root, "year=2020", "variable=B01001_002E")
    os.makedirs(folder)
    with open(os.path.join(folder, "r.json"), "w") as f:
        f.write("<html>error</html>")
    with pytest.raises(Exception):
        census.parse_responses(census.read_responses(spark, root)).collect()


def test_staged_table_is_below_the_shared_folder(spark):
    df = stage(spark.range(3), "three")
    assert df.count() == 3
    assert all(shared_dir(spark) in f for f in df.inputFiles())
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_shared_folder_has_to_be_named_on_a_cluster():
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class Context:
        master = "spark://somewhere"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        def __init__(self, value):
            self.conf = Conf(value)

    assert shared_dir(Session("hdfs://shared/dir/")) == "hdfs://shared/dir"
    with pytest.raises(ValueError):
        shared_dir(Session(None))


def test_small_tables_go_to_pandas_and_back(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, None)], "id bigint, s string, x double")
    back = spark.createDataFrame(files.to_pandas(df), df.schema)
    assert back.where("id = 1").first() == df.where("id = 1").first()
    assert back.count() == 2


def test_session_settings(spark):
    assert get_session("tests").conf.get("spark.sql.session.timeZone") == "UTC"
    assert DEFAULT_SETTINGS["spark.sql.adaptive.enabled"] == "true"


def test_merchant_job_end_to_end(spark):
    cities = ("Newark", "Trenton")
    ms = [
        merchant(k, sales=(100 + k, 200, 300 + k, 400), counts=(10, 20 + k, 30, 45), city=cities[k % 2], zipcode=str(7001 + k % 3))
        for k in range(12)
    ] + [merchant(50, mcc="5411"), merchant(51, sales=(1, 0, 1, 1))]
    by_zip = spark.createDataFrame(
        [(f"0700{i}", *(i * 10 + j for j in range(6))) for i in range(1, 4)],
        "zipcode string, " + ", ".join(f"population_{s}_{y} bigint" for y in (2020, 2019, 2018) for s in ("male", "female")),
    )
    banks = [r for c in cities for r in bank_years(city=c)]
    job = merchant_job(merchants(spark, *ms), bank(spark, *banks), by_zip, importance_exclude=["MERCHANT_NAME"])
    assert set(job) == {"features", "ranking", "city_totals", "census", "merged", "importance", "report"}
    assert job["merged"].count() == 12
    assert job["report"].count() == 12
    assert sorted(r["TREND_RANKING"] for r in job["ranking"].collect())[0] == 1
    names = {r["name"] for r in job["importance"].collect()}
    assert {"POPULATION", "Total2021", "OHE_CITY_Newark", "population_male_2020"} <= names
    assert not any(n.startswith("OHE_MERCHANT_NAME") for n in names)


@pytest.mark.parametrize("shuffle_partitions", [1, 8])
def test_results_do_not_depend_on_partitions(spark, sf_dir, shuffle_partitions):
    import __spark_entry__ as registry

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions)
    try:
        rows = sorted(tuple(r) for r in registry.merchant_report(spark, sf_dir).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    reference = sorted(tuple(r) for r in registry.merchant_report(spark, sf_dir).collect())
    assert rows == reference and len(rows) > 0


def test_large_tables_are_summed_before_they_are_joined(spark, sf_dir):
    plan = standin.merchant_yearly(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate [l_suppkey")


def test_limits_come_from_file_statistics(spark, sf_dir, tmp_path):
    path, columns = f"{sf_dir}/lineitem.parquet", ["l_quantity", "l_extendedprice", "l_orderkey"]
    plan = files._limits(files._statistics_session(spark).read.parquet(path), columns)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(l_quantity), MAX(l_quantity), MIN(l_extendedprice)" in plan
    plain = spark.read.parquet(path).selectExpr(*(f"{f}({c})" for c in columns for f in ("min", "max"))).first()
    assert files.parquet_limits(spark, path, columns) == [(plain[0], plain[1]), (plain[2], plain[3]), (plain[4], plain[5])]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_limits_without_statistics_are_read_from_the_rows(spark, tmp_path):
    values = (
        "if(id = 3, double('NaN'), id * 1D) AS odd", "cast(null as double) AS none", "cast(id AS string) AS text",
        "cast(id AS decimal(20,2)) AS money",
    )
    spark.range(10).repartition(3).selectExpr(*values).write.parquet(str(tmp_path / "rows"))
    (low, high), none, text, money = files.parquet_limits(spark, str(tmp_path / "rows"), ["odd", "none", "text", "money"])
    assert low == 0 and high != high and none == (None, None) and text == ("0", "9") and tuple(map(float, money)) == (0, 9)
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    assert files.parquet_limits(spark, str(tmp_path / "empty"), ["id"]) == [(None, None)]


def test_scaling_by_known_limits(spark):
    df = spark.range(11).selectExpr("id", "id * 1.5D AS a", "7D AS b")
    plain = scoring.minmax_scale(df, ("a", "b"), (0, 1))
    known = scoring.minmax_scale(df, ("a", "b"), (0, 1), limits=[(0.0, 15.0), (7.0, 7.0)])
    assert known.exceptAll(plain).count() == 0 and known.count() == 11
    with pytest.raises(ValueError):
        scoring.minmax_scale(df, ("a", "b"), (0, 1), limits=[(0.0, 15.0)])


def landed(spark):
    root = new_path(spark, "responses")
    rows = [
        (2020, "A", [["NAME", "A", "zip"], ["z \"1\", [x]", "5", "07001"], ["z", None, "7002"], ["z", "12", "10001"]]),
        (2019, "A", [["NAME", "A", "state", "zip"], ["z", "7", "34", "7001"]]),
        (2019, "B", [["NAME", "B", "state", "zip"]]),
        (2018, "B", []),
    ]
    texts = spark.createDataFrame([(y, v, json.dumps(r)) for y, v, r in rows], "year int, variable string, value string")
    texts.repartition(1).write.partitionBy("year", "variable").text(root)
    return root


def test_streamed_responses_equal_parsed_ones(spark):
    root = landed(spark)
    streamed = census_stream.read_response_rows(spark, root)
    plain = census.parse_responses(census.read_responses(spark, root))
    assert streamed.columns == plain.columns
    key = repr
    assert sorted(map(tuple, streamed.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
    assert streamed.count() == 4


def test_filters_prune_the_responses_that_are_opened(spark):
    root = landed(spark)
    rows = census_stream.read_response_rows(spark, root)
    for condition, files_read, found in (
        ("year = 2019", 2, 1), ("year = 2019 AND variable = 'A'", 1, 1), ("year >= 2019 AND value > 6", 3, 2),
        ("variable IN ('A', 'C')", 2, 4), ("year < 2000", 0, 0), ("2019 < year AND zipcode = '07002'", 1, 1),
    ):
        chosen = rows.where(condition)
        assert chosen.rdd.getNumPartitions() == max(files_read, 1)
        assert chosen.count() == found


@pytest.mark.parametrize("chunk", [1, 3, 64, 10_000])
def test_rows_of_a_response_come_one_after_the_other(chunk):
    rows = [["h", "v", "zip"], ["a]\"[,\\", None, "1"], ["é漢", "2", "3"]]
    for text in (json.dumps(rows), json.dumps(rows, indent=2, ensure_ascii=False), " [] ", "[[]]"):
        assert list(census_stream.stream_rows(io.BytesIO(text.encode()), chunk)) == json.loads(text)
    for broken in ("", "[[1]", "[[1],]", "{}", "[1]", "[[1]] x", '[["a" "b"]]', "[[1][2]]"):
        with pytest.raises(ValueError):
            list(census_stream.stream_rows(io.BytesIO(broken.encode()), chunk))


def hot_keys(spark):
    values = (
        "if(id % 3 = 0, 7, cast(id * id % 100003 as int)) AS k", "if(id % 50 = 0, null, id % 997) AS other",
        "if(id % 4 = 0, 'it''s', if(id % 11 = 0, null, concat('t', id % 300, '\\\\'))) AS name",
        "if(id % 3 = 1, date'2020-02-02', date_add(date'2000-01-01', cast(id as int))) AS day",
        "cast(id * 0.25 as double) AS x", "timestamp'2021-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id / 3) AS at",
        "if(id % 13 = 0, null, 5) AS same",
    )
    return stage(spark.range(6000).selectExpr("id", *values), "hot-keys")


@pytest.mark.parametrize("columns", ["k", "name", "day", "x", "at", "same", "other", ["k", "other"], ["same", "k", "id"], ["name", "k"]])
def test_every_row_is_in_one_part(spark, columns):
    rows = hot_keys(spark)
    # cuts from two thirds of the rows hold for all
    parts = warehouse.partition_predicates(rows.where("id % 3 < 2"), columns, 10, text_by_bytes=True)
    found = [rows.where(p).select("id").collect() for p in parts]
    assert sorted(r[0] for part in found for r in part) == list(range(6000))
    whole = warehouse.partition_predicates(rows, columns, 10, text_by_bytes=True)
    if columns in ("x", "at", ["same", "k", "id"]):
        assert 9 <= len(whole) <= 24 and max(rows.where(p).count() for p in whole) <= 3 * 600


def test_a_hot_key_is_cut_by_the_next_column(spark):
    rows = hot_keys(spark)
    one = max(rows.where(p).count() for p in warehouse.partition_predicates(rows, "k", 10))
    two = max(rows.where(p).count() for p in warehouse.partition_predicates(rows, ["k", "other"], 10))
    assert one >= 2000 and two <= 1200


def test_parts_of_odd_tables(spark):
    rows = hot_keys(spark)
    assert warehouse.partition_predicates(rows.limit(0), "k", 10) == ["1 = 1"] == warehouse.partition_predicates(rows, "k", 1)
    assert warehouse.partition_predicates(rows.selectExpr("cast(null as int) AS k"), "k", 10) == ["1 = 1"]
    for bad in (lambda: warehouse.partition_predicates(rows, "name", 4), lambda: warehouse.partition_predicates(rows, [], 4),
                lambda: warehouse.partition_predicates(rows, "k", 0),
                lambda: warehouse.read_warehouse(spark, "jdbc:x", predicates=["1 = 1"], query="SELECT 1")):
        with pytest.raises(ValueError):
            bad()


def test_bucketed_tables_are_joined_without_an_exchange(spark):
    left = stage_bucketed(spark.range(5000).selectExpr("id", "id % 700 AS k"), "left", ["k"], 6)
    right = stage_bucketed(spark.range(600).selectExpr("id AS k", "id * 2 AS v"), "right", ["k"], 6)
    joined = left.hint("merge").join(right, ["k"])
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == spark.range(5000).where("id % 700 < 600").count()


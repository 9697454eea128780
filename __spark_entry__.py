"""Registered queries: one per operator, over the whole tables of a data folder.

``entry`` is the flagship query, ``queries`` the registry, ``oracle_sql`` the same
results as SQL for an independent engine.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trendspark.functions import numeric_columns, text_columns  # noqa: E402
from trendspark.operators import aggregate, encode, features, forest, joins, neighbours, ranking, scoring, split  # noqa: E402
from trendspark.plans import oracles, standin  # noqa: E402
from trendspark.plans.classifier import classifier_job  # noqa: E402
from trendspark.plans.merchant import merchant_job, merge_job  # noqa: E402
from trendspark.settings import SCORING_COLUMNS  # noqa: E402
from trendspark.sources import census, census_stream, files, warehouse  # noqa: E402
from trendspark.staging import new_path, stage, stage_all  # noqa: E402

try:  # the one guard for a library without these operators
    import corpus_pipeline
    from trendspark.llm import oracles as llm_oracles
    from trendspark.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("trendspark.llm", "corpus_pipeline", "public_tokenizers")):
        raise
    llm_queries = llm_oracles = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TRENDS = ["SALES_TREND_1", "SALES_TREND_2", "SALES_TREND_3"]
COUNT_TRENDS = ["SALES_CNT_TREND_1", "SALES_CNT_TREND_2", "SALES_CNT_TREND_3"]


# --- inputs -----------------------------------------------------------------


def _merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.merchant_yearly(spark, sf_dir)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.merchant_features(_merchants(spark, sf_dir))


def _staged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(_features(spark, sf_dir), "features")


def _as_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for the comparison with other engines."""
    return df.select(*(F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes))


def _totals(spark: SparkSession, sf_dir: str, merchants: DataFrame | None = None) -> DataFrame:
    return aggregate.city_totals(merchants or _merchants(spark, sf_dir), standin.bank_yearly(spark, sf_dir))


def _landed_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "census-responses")
    standin.land_responses(standin.census_long(spark, sf_dir), root)
    return census.parse_responses(census.read_responses(spark, root))


def _census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.census_table(_landed_census(spark, sf_dir))


# --- sources and sinks ------------------------------------------------------


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders")
    path = new_path(spark, "orders-csv")
    files.write_csv(orders, path)
    return files.read_csv(spark, path, orders.schema).withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = standin.table(spark, sf_dir, "lineitem")
    path = new_path(spark, "lineitem-parquet")
    files.write_parquet(lines, path)
    return files.read_parquet(spark, path, lines.schema).withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


def scan_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(warehouse.bank_extract(standin.bank_yearly(spark, sf_dir)))


def filter_mcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(warehouse.merchant_extract(_merchants(spark, sf_dir)))


def sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.sql_extract(
        spark,
        """
        SELECT m.BILLING_STATE, count(*) AS merchants,
               CAST(sum(m.TOT_SALES2021) AS DOUBLE) AS sales, CAST(max(b.total) AS DOUBLE) AS bank_total
        FROM {merchants} m
        JOIN (SELECT MERCHANT_STATE_XCD AS state, sum(TOT_SUM) AS total FROM {bank}
              WHERE YEAR_run = :year GROUP BY MERCHANT_STATE_XCD) b
          ON m.BILLING_STATE = b.state
        GROUP BY m.BILLING_STATE
        """,
        tables={"merchants": _merchants(spark, sf_dir), "bank": standin.bank_yearly(spark, sf_dir)},
        args={"year": 2021},
    )


def extract_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines read part by part, cut by quantiles of a skewed key and by a second one below its hot values."""
    lines = standin.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, F.col("l_quantity").cast("int").alias("quantity"), "l_partkey")
    lines = lines.withColumn("quantity", F.when(F.col("quantity") <= 20, 1).otherwise(F.col("quantity")))
    parts = warehouse.partition_predicates(lines.select("quantity", "l_partkey"), ["quantity", "l_partkey"], 8)
    read = [lines.where(p).withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionAll, read).select(*LINE_KEYS, "quantity", "l_partkey")


# --- projections, filters, cleaning -----------------------------------------


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(features.drop_columns(_merchants(spark, sf_dir), "mcc", "population", "no_such_column"))


def avg_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    averaged = _merchants(spark, sf_dir).withColumns(features.average_columns())
    return averaged.select("MERCHANT_ID", "AVG_SALES", "AVG_SALES_CNT")


def sales_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merchants(spark, sf_dir).withColumns(features.sales_trend_columns()).select("MERCHANT_ID", *TRENDS)


def count_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merchants(spark, sf_dir).withColumns(features.count_trend_columns()).select("MERCHANT_ID", *COUNT_TRENDS)


def merchant_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(_features(spark, sf_dir))


def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City totals without the cities that have no bank rows."""
    return _as_doubles(features.drop_incomplete(_totals(spark, sf_dir)))


def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return features.limit_rows(orders, 5000, "o_orderkey")


def zip_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.zip_keys(_merchants(spark, sf_dir))


def typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric columns but the target beside the text columns, found by type."""
    merchants = _as_doubles(_merchants(spark, sf_dir))
    return merchants.select(
        *numeric_columns(merchants, exclude=["TOT_SALES2021"]), *text_columns(merchants, exclude=["MCC"])
    )


def trend_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.weighted_trends(_features(spark, sf_dir)).select(
        "MERCHANT_ID", "SALES_TREND_WEIGHTED", "SALE_CNT_TREND_WEIGHTED", "TREND_WEIGHTED"
    )


# --- scoring ----------------------------------------------------------------


def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = scoring.minmax_scale(_staged_features(spark, sf_dir), directions=(1, 0, 1, 0, 1, 0))
    return scaled.select("MERCHANT_ID", *(c + "_SCALED" for c in SCORING_COLUMNS))


def scale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scaling over the largest table, whose limits are in its files."""
    lines = standin.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *LINE_MEASURES)
    limits = files.parquet_limits(spark, f"{sf_dir}/lineitem.parquet", LINE_MEASURES)
    scaled = scoring.minmax_scale(lines, LINE_MEASURES, (1, 1, 0, 0), limits=limits)
    return scaled.select(*LINE_KEYS, *(c + "_SCALED" for c in LINE_MEASURES))


def proximity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.proximity_score(_staged_features(spark, sf_dir)).select("MERCHANT_ID", "SCORE")


def weighted_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.weighted_sum(_features(spark, sf_dir)).select("MERCHANT_ID", "WEIGHTED_SUM")


def scoring_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scoring_report(_staged_features(spark, sf_dir))


# --- aggregation ------------------------------------------------------------


def yearly_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(aggregate.yearly_pivot(standin.bank_yearly(spark, sf_dir)))


def yearly_pivot_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(aggregate.yearly_pivot(standin.bank_yearly(spark, sf_dir), legacy_2018=True))


def city_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(aggregate.city_sums(_merchants(spark, sf_dir)))


def agg_city_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(_totals(spark, sf_dir))


# --- census and joins -------------------------------------------------------


def census_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _census(spark, sf_dir)


def census_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same columns through the data source that reads responses as streams."""
    root = new_path(spark, "census-responses")
    standin.land_responses(standin.census_long(spark, sf_dir), root)
    return census.census_table(census_stream.read_response_rows(spark, root))


def census_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.census_enrich(_merchants(spark, sf_dir), _census(spark, sf_dir))


def join_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written once: both sides of the join start from it
    merchants = stage(_merchants(spark, sf_dir), "merchants")
    by_merchant, totals = stage_all(
        features=features.merchant_features(merchants), city_totals=_totals(spark, sf_dir, merchants)
    )
    return _as_doubles(joins.join_city(by_merchant, totals))


def join_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(joins.join_census(_merchants(spark, sf_dir), stage(_census(spark, sf_dir), "census")))


def merge_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    merchants = stage(_merchants(spark, sf_dir), "merchants")
    by_merchant, totals, by_zip = stage_all(
        features=features.merchant_features(merchants),
        city_totals=_totals(spark, sf_dir, merchants),
        census=_census(spark, sf_dir),
    )
    return _as_doubles(joins.merge_all(by_merchant, totals, by_zip))


def merge_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge by tables in buckets of the city."""
    merchants = stage(_merchants(spark, sf_dir), "merchants")
    by_merchant, totals, by_zip = stage_all(
        features=features.merchant_features(merchants),
        city_totals=_totals(spark, sf_dir, merchants),
        census=_census(spark, sf_dir),
    )
    return _as_doubles(joins.merge_bucketed(by_merchant, totals, by_zip))


def split_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their supplier, by the path for lookups too large to broadcast."""
    lines = standin.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, F.col("l_suppkey").alias("s_suppkey"))
    suppliers = standin.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return joins.split_join(lines, suppliers, ["s_suppkey"], min_hot_rows=500)


# --- ranking ----------------------------------------------------------------


def trend_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranking.trend_ranking(_staged_features(spark, sf_dir))
    return ranked.select("MERCHANT_ID", "TREND_WEIGHTED", "TREND_RANKING")


def rank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rank over the largest table."""
    lines = standin.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_extendedprice")
    return ranking.global_rank(lines, "l_extendedprice", "price_rank")


def rank_tied_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few distinct values: every one is hot. Highest first."""
    lines = standin.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_discount")
    return ranking.global_rank(lines, "l_discount", "discount_rank", ascending=False)


def rank_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank over bigint, with ties."""
    lines = standin.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, F.col("l_partkey").cast("bigint").alias("l_partkey"))
    return ranking.global_rank(lines, "l_partkey", "part_rank")


def rank_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank over exact cents, highest first."""
    cents = F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    orders = standin.table(spark, sf_dir, "orders").select("o_orderkey", cents)
    return ranking.global_rank(orders, "price", "price_rank", ascending=False).select("o_orderkey", "price_rank")


def rank_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank over text."""
    parts = standin.table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return ranking.global_rank(parts, "p_type", "type_rank")


# --- machine learning -------------------------------------------------------


def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = standin.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *LINE_MEASURES)
    vectors = encode.assemble_features(lines, LINE_MEASURES)
    return vectors.select(*LINE_KEYS, F.posexplode(vector_to_array("features")).alias("pos", "value"))


def index_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = standin.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return encode.index_labels(customers, "c_mktsegment")


def index_many_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More values than the driver is allowed to hold: numbered in parallel."""
    orders = standin.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return encode.index_labels(orders, "o_custkey", max_labels=50)


def index_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = standin.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return encode.index_columns(parts, ["p_brand", "p_type"])


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot that is set, per row and column."""
    parts = standin.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    encoded = encode.one_hot(parts, ["p_brand", "p_type"])
    slots = [
        F.struct(F.lit(c).alias("name"), vector_to_array("OHE_" + c).alias("slots")) for c in ("p_brand", "p_type")
    ]
    return (
        encoded.select("p_partkey", F.inline(F.array(*slots)))
        .select("p_partkey", "name", F.posexplode("slots").alias("slot", "set"))
        .where("set <> 0")
    )


def slot_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of each index and slot."""
    return encode.slot_labels(standin.table(spark, sf_dir, "part"), ["p_brand", "p_type"])


def transform_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = standin.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *LINE_MEASURES, "l_returnflag")
    transformed = encode.transform_features(lines, LINE_MEASURES, "l_returnflag")
    return transformed.select(*LINE_KEYS, "label", F.posexplode(vector_to_array("features")).alias("pos", "value"))


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = split.hash_split(orders, "o_orderkey")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


def split_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    parts = split.split_target(orders, "o_orderstatus", "o_orderkey")
    x_train, x_test, y_train, y_test = parts
    rows = [x.join(y, "o_orderkey").withColumn("part", F.lit(n)) for x, y, n in
            ((x_train, y_train, "train"), (x_test, y_test, "test"))]
    return rows[0].unionByName(rows[1])


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = standin.labelled_vectors(spark, sf_dir).select("vec_id", "embedding", "class_name")
    train, test = split.hash_split(vectors, "vec_id")
    found = neighbours.nearest_neighbour(train, test, label="class_name")
    return found.join(test.select(F.col("vec_id").alias("test_id"), F.col("class_name").alias("label")), "test_id")


def nearest_neighbour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _neighbours(spark, sf_dir)


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.accuracy(_neighbours(spark, sf_dir))


def _vector_classifier(spark: SparkSession, sf_dir: str) -> dict:
    vectors = standin.labelled_vectors(spark, sf_dir)
    vectors = vectors.withColumn("vector", array_to_vector(F.col("embedding").cast("array<double>"))).drop("embedding")
    return classifier_job(vectors, ["vector"], "class_name", key="vec_id", seed=17)


def _known(label: str) -> F.Column:
    """Whether a prediction is one of the labels, which is all that is fixed about it."""
    return F.col("prediction").isin([float(i) for i in range(100)]).alias(label)


def rf_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class for every test vector."""
    return _vector_classifier(spark, sf_dir)["predictions"].select("vec_id", "label", _known("has_class"))


def _share(job: dict) -> DataFrame:
    """Rows that were predicted, and whether the share of right ones is a share."""
    rows = job["testing"].agg(F.count("*").alias("test_rows"))
    share = job["accuracy"].select(F.col("accuracy").between(0, 1).alias("is_share"))
    return rows.withColumn("is_share", F.lit(share.first()[0]))


def rf_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _share(_vector_classifier(spark, sf_dir))


def rf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classifier over the largest table: four measures, three classes."""
    lines = standin.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *LINE_MEASURES, "l_returnflag")
    return _share(classifier_job(lines, LINE_MEASURES, "l_returnflag", key=LINE_KEYS, seed=17))


def _exact_classifier(spark: SparkSession, sf_dir: str) -> dict:
    lines = standin.late_lines(spark, sf_dir)
    return classifier_job(lines, ["number", "square"], "part", key=LINE_KEYS, seed=17)


def rf_exact_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target that trees learn exactly: the predictions are the labels."""
    return _exact_classifier(spark, sf_dir)["predictions"].select(*LINE_KEYS, "label", "prediction")


def rf_exact_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact_classifier(spark, sf_dir)["accuracy"]


def rf_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same predictions by a model that was saved and loaded, best class first."""
    job, path = _exact_classifier(spark, sf_dir), new_path(spark, "model")
    forest.save_model(job["model"], path)
    predictions = forest.predict(forest.load_model(spark, path), job["testing"])
    return predictions.orderBy(F.desc("prediction")).select(*LINE_KEYS, "label", "prediction")


def rf_exact_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column tells the target and the others are constant: scores 1 and 0, by slot."""
    lines = standin.late_lines(spark, sf_dir).select(
        F.concat_ws("|", *LINE_KEYS).alias("line"), "number", F.lit(7.0).alias("same"), F.lit("x").alias("text"),
        (F.col("part") == "late").cast("double").alias("target"),
    )
    return forest.feature_importance(lines, target="target", order_by="line", mode="regress", exclude=["line"])


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in both parts together, keys in both, and keys in neither."""
    orders = standin.table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = split.random_split(orders, seed=17)
    parts = stage(train.withColumn("n", F.lit(1)).union(test.withColumn("n", F.lit(1))), "parts")
    keys = orders.join(parts.groupBy("o_orderkey").count(), "o_orderkey", "left")
    return keys.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("split_rows"),
        F.count_if(F.col("count") > 1).alias("in_both"),
        F.count_if(F.col("count").isNull()).alias("in_neither"),
    )


def _slot_report(importance: DataFrame) -> DataFrame:
    """What is fixed about a report: each slot with its name, and that its score is a share."""
    return importance.select("idx", "name", F.col("score").between(0, 1).alias("is_share"))


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slot_report(forest.feature_importance(_staged_features(spark, sf_dir), mode="regress"))


# --- whole jobs -------------------------------------------------------------


def _job_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return _merchants(spark, sf_dir), standin.bank_yearly(spark, sf_dir), _census(spark, sf_dir)


def merchant_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scoring_report(merge_job(*_job_inputs(spark, sf_dir))["merged"])


def merchant_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slot_report(merchant_job(*_job_inputs(spark, sf_dir))["importance"])


def entry(spark: SparkSession) -> DataFrame:
    return trend_ranking(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        csv_round_trip, parquet_round_trip, scan_bank, filter_mcc, sql_text,
        drop_columns, avg_sales, sales_trends, count_trends, merchant_features, drop_nulls, limit_rows, zip_keys,
        typed_columns, trend_weighted,
        minmax_scale, scale_lines, proximity_score, weighted_sum, scoring_report,
        yearly_pivot, yearly_pivot_legacy, city_sums, agg_city_totals,
        census_parse, census_streamed, census_enrich, join_city, join_census, merge_all, merge_buckets,
        split_join, extract_parts,
        trend_ranking, rank_lines, rank_tied_lines, rank_keys, rank_money, rank_names,
        assemble_features, index_labels, index_many_labels, index_columns, one_hot, slot_labels, transform_features,
        hash_split, split_target, random_split, nearest_neighbour, accuracy,
        rf_predict, rf_accuracy, rf_lines, feature_importance,
        rf_exact_predict, rf_exact_accuracy, rf_saved_model, rf_exact_importance,
        merchant_report, merchant_importance,
    )
    found = {query.__name__: query for query in registered}
    if llm_queries:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """SQL for every query whose results SQL can say."""
    found = oracles.oracle_sql()
    if llm_oracles:
        found |= llm_oracles.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found

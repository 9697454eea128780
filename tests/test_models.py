"""Encoding, splits, forests, neighbours and the classifier job."""

import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trendspark.operators import encode, forest, neighbours, split
from trendspark.plans.classifier import classifier_job
from trendspark.staging import new_path, stage


def flowers(spark):
    """Three well separated classes of 40 rows with four measures."""
    rows = spark.range(120).select("id", (F.col("id") % 3).alias("kind"), F.hash("id").alias("h"))
    noise = F.pmod("h", F.lit(100)) / 200
    measures = [(F.col("kind") * k + noise).alias(n) for n, k in (("sl", 1.0), ("sw", -2.0), ("pl", 3.0), ("pw", 0.5))]
    return rows.select("id", *measures, F.element_at(F.array(*map(F.lit, ["setosa", "versicolor", "virginica"])), F.col("kind").cast("int") + 1).alias("species"))


MEASURES = ["sl", "sw", "pl", "pw"]


def test_assembled_features_replace_their_columns(spark):
    df = encode.assemble_features(flowers(spark), MEASURES)
    assert df.columns == ["id", "species", "features"]
    row = df.first()
    assert len(row["features"]) == 4


def test_ties_are_indexed_in_alphabetical_order(spark):
    df = encode.index_labels(flowers(spark), "species")
    assert {r["species"]: r["label"] for r in df.collect()} == {"setosa": 0.0, "versicolor": 1.0, "virginica": 2.0}


@pytest.mark.parametrize("max_labels", [1000, 3])
def test_both_index_paths_agree_with_string_indexer(spark, max_labels):
    df = spark.range(3000).select("id", F.concat(F.lit("v"), F.pmod(F.hash("id"), F.lit(60)) % 47).alias("s"))
    expected = StringIndexer(inputCol="s", outputCol="label").fit(df).transform(df)
    got = encode.index_labels(df, "s", max_labels=max_labels)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_null_label_is_an_error(spark):
    with pytest.raises(ValueError):
        encode.index_labels(spark.createDataFrame([("a",), (None,)], "s string"), "s")


@pytest.mark.parametrize("max_labels", [1000, 1])
def test_columns_with_nulls_get_the_last_index_and_the_zero_vector(spark, max_labels):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", None), (4, None, "y")], "id int, p string, q string")
    rows = {r["id"]: r for r in encode.index_columns(df, ["p", "q"], max_labels=max_labels).collect()}
    assert [rows[i]["IDX_p"] for i in (1, 2, 3, 4)] == [0.0, 0.0, 1.0, 2.0]
    assert [rows[i]["IDX_q"] for i in (1, 2, 3, 4)] == [1.0, 0.0, 2.0, 0.0]
    hot = encode.one_hot(df, ["p", "q"], max_labels=max_labels)
    slots = {r["id"]: r for r in hot.select("id", vector_to_array("OHE_p").alias("p"), vector_to_array("OHE_q").alias("q")).collect()}
    assert [slots[i]["p"] for i in (1, 3, 4)] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]
    assert [slots[i]["q"] for i in (1, 2, 3)] == [[0.0, 1.0], [1.0, 0.0], [0.0, 0.0]]


def test_index_columns_equals_multi_column_string_indexer(spark):
    df = flowers(spark).select("id", "species", F.concat(F.lit("h"), F.col("id") % 7).alias("other"))
    columns = ["species", "other"]
    expected = StringIndexer(inputCols=columns, outputCols=["IDX_" + c for c in columns], handleInvalid="keep").fit(df).transform(df)
    assert encode.index_columns(df, columns).exceptAll(expected).count() == 0


@pytest.mark.parametrize("max_labels", [1000, 3])
def test_slot_names_do_not_depend_on_the_number_of_values(spark, max_labels, monkeypatch):
    df = flowers(spark).select("id", "species", F.concat(F.lit("h"), F.col("id") % 7).alias("other"))
    columns = ["species", "other"]
    indexed = encode.index_columns(df, columns, max_labels=max_labels)
    names = {(r["name"], r["slot"]): r["value"] for r in encode.slot_labels(df, columns).collect()}
    assert len(names) == 10
    for row in indexed.collect():
        assert all(names[c, row["IDX_" + c]] == row[c] for c in columns)
    kinds = [indexed.schema["IDX_" + c].metadata["ml_attr"] for c in columns]
    assert kinds == [{"type": "nominal", "num_vals": n, "name": "IDX_" + c} for c, n in zip(columns, (4, 8))]
    monkeypatch.setattr(encode, "MAX_LABEL_BYTES", 1)
    again = encode.index_columns(df, columns)
    assert again.exceptAll(indexed).count() == 0


def test_importance_model_can_be_kept(spark):
    df = spark.range(60).selectExpr("id AS MERCHANT_ID", "id % 4 AS driver", "id % 4 * 100D AS TOT_SALES2021")
    path = new_path(spark, "importance-model")
    forest.feature_importance(df, mode="regress", exclude=["MERCHANT_ID"], model_path=path)
    kept = forest.load_model(spark, path).transform(df)
    assert kept.where("abs(prediction - TOT_SALES2021) < 50").count() == 60


def test_hash_split_parts_are_disjoint_whole_and_stable(spark):
    df = spark.range(5000)
    train, test = split.hash_split(df, "id", 0.2)
    again = split.hash_split(df.repartition(13), "id", 0.2)[1]
    assert train.count() + test.count() == 5000 and train.intersect(test).count() == 0
    assert test.exceptAll(again).count() == 0 and again.count() == test.count()
    assert abs(test.count() / 5000 - 0.2) < 0.03
    assert split.hash_split(df, ["id"], 0.0)[1].count() == 0
    assert split.hash_split(df, "id", 1.0)[0].count() == 0
    with pytest.raises(ValueError):
        split.hash_split(df, "id", 1.2)


def test_random_split_repeats_with_its_seed(spark):
    df = spark.range(1000)
    train, test = split.random_split(df, 0.2, 5)
    again = split.random_split(df, 0.2, 5)[1]
    assert train.count() + test.count() == 1000 and train.intersect(test).count() == 0
    assert test.exceptAll(again).count() == 0


def test_split_target(spark):
    x_train, x_test, y_train, y_test = split.split_target(flowers(spark), "species", "id")
    assert "species" not in x_train.columns and y_test.columns == ["id", "species"]
    assert x_train.count() == y_train.count() and x_train.count() + x_test.count() == 120


def test_classifier_job_learns_and_its_model_can_be_kept(spark):
    job = classifier_job(flowers(spark), MEASURES, "species", key="id", seed=3)
    assert job["accuracy"].first()["accuracy"] > 0.95
    assert job["predictions"].count() == job["testing"].count() > 0
    assert job["model"].getNumTrees == 10
    path = new_path(spark, "model")
    forest.save_model(job["model"], path)
    forest.save_model(job["model"], path)
    kept = forest.predict(forest.load_forest(path), job["testing"])
    columns = ["id", "label", "prediction"]
    assert kept.select(columns).exceptAll(job["predictions"].select(columns)).count() == 0


def test_training_parts_follow_from_the_rows():
    assert [forest.training_parts(n) for n in (0, 1, 50_000, 50_001, 10**9, 10**12)] == [1, 1, 1, 2, 4096, 500_000]


def test_equal_rows_are_dealt_evenly_by_their_key(spark):
    rows = spark.range(20_000).selectExpr("id", "id % 2 AS value")
    dealt = forest._spread(rows, [F.xxhash64("id"), F.col("value")], 16)
    sizes = sorted(r[1] for r in dealt.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]


def test_forest_does_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(forest, "PART_ROWS", 300)
    df = flowers(spark).withColumn("species", F.when(F.rand(1) < 0.2, F.lit("setosa")).otherwise(F.col("species")))
    df = stage(df, "noisy")
    models = [classifier_job(df.repartition(n), MEASURES, "species", key="id", seed=3)["model"] for n in (1, 7)]
    assert models[0].toDebugString.splitlines()[1:] == models[1].toDebugString.splitlines()[1:]


def test_classifier_job_with_random_split(spark):
    job = classifier_job(flowers(spark), MEASURES, "species", seed=3, num_trees=4)
    assert job["training"].count() + job["testing"].count() == 120
    assert job["model"].getNumTrees == 4


def test_accuracy(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (2.0, 2.0), (0.0, 0.0)], "label double, prediction double")
    assert forest.accuracy(df).first()["accuracy"] == 0.75
    assert forest.accuracy(df.limit(0)).first()["accuracy"] is None


@pytest.mark.parametrize("mode", ["classify", "regress"])
def test_feature_importance_names_every_slot(spark, mode):
    df = spark.range(60).select(
        F.col("id").alias("MERCHANT_ID"),
        (F.col("id") % 4).cast("double").alias("driver"),
        (F.hash("id") % 5).cast("double").alias("noise"),
        F.concat(F.lit("c"), F.col("id") % 2).alias("CITY"),
        (F.col("id") % 4 * 100.0).alias("TOT_SALES2021"),
    )
    table = forest.feature_importance(df, mode=mode, exclude=["MERCHANT_ID"])
    rows = table.collect()
    assert table.columns == ["idx", "name", "score"]
    assert {r["name"] for r in rows} == {"driver", "noise", "OHE_CITY_c0", "OHE_CITY_c1"}
    assert [r["score"] for r in rows] == sorted((r["score"] for r in rows), reverse=True)
    assert abs(sum(r["score"] for r in rows) - 1) < 1e-9
    assert rows[0]["name"] == "driver"
    assert forest.feature_importance(df, mode=mode, exclude=["MERCHANT_ID"]).collect() == rows


def test_feature_importance_of_more_slots_than_a_dense_row_holds(spark):
    rows = [(k, float(k % 4), f"n{k}", None if k % 7 == 0 else f"c{k % 2}", 1000.0 * (k == 5) + k % 4 * 100.0) for k in range(60)]
    schema = "MERCHANT_ID long, driver double, NAME string, CITY string, TOT_SALES2021 double"
    df = spark.createDataFrame(rows + rows[:5], schema)
    narrow = {(r.idx, r.name) for r in forest.feature_importance(df, mode="regress", exclude=["MERCHANT_ID"]).collect()}
    found = forest.feature_importance(df, mode="regress", exclude=["MERCHANT_ID"], max_slots=10).collect()
    assert {(r.idx, r.name) for r in found} == narrow and len(found) == 63
    assert abs(sum(r.score for r in found) - 1) < 1e-9
    assert {r.name for r in found[:2]} == {"OHE_NAME_n5", "driver"}
    again = forest.feature_importance(df.repartition(7), mode="regress", exclude=["MERCHANT_ID"], max_slots=10).collect()
    assert again == found
    with pytest.raises(ValueError, match="NAME"):
        forest.feature_importance(df, mode="classify", exclude=["MERCHANT_ID"], max_slots=10)
    with pytest.raises(ValueError, match="TOT_SALES2021"):
        blank = df.withColumn("TOT_SALES2021", F.expr("nullif(TOT_SALES2021, 1100)"))
        forest.feature_importance(blank, mode="regress", exclude=["MERCHANT_ID"], max_slots=10)


def test_feature_importance_refuses_other_modes(spark):
    with pytest.raises(ValueError):
        forest.feature_importance(spark.range(1), mode="cluster")


def brute_force(train, test):
    out = {}
    for key, v in test:
        distances = [(float(((np.array(v) - np.array(w)) ** 2).sum()), i, label) for i, w, label in train]
        out[key] = min(distances)[1:]
    return out


BLOCKS = [(None, 4096, 4096), (None, 16, 8), (40, 4096, 5), (1, 7, 1000)]


@pytest.mark.parametrize("pivots,train_block,test_block", BLOCKS)
def test_nearest_neighbour_equals_brute_force(spark, pivots, train_block, test_block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 6)) * 10
    points = [(i, (centres[i % 5] + rng.normal(size=6)).tolist(), f"l{i % 5}") for i in range(300)]
    # a third of the rows are copies of one vector; the least id has to win
    points += [(1000 - i, points[0][1], f"copy{i}") for i in range(150)]
    queries = [(i, (centres[i % 5] + rng.normal(size=6)).tolist()) for i in range(40)] + [(99, points[0][1])]
    train = spark.createDataFrame(points, "vec_id bigint, embedding array<double>, label string")
    test = spark.createDataFrame(queries, "vec_id bigint, embedding array<double>")
    found = neighbours.nearest_neighbour(
        train.repartition(5), test.repartition(3), pivots=pivots, train_block=train_block, test_block=test_block,
        broadcast_bytes=1 << 20 if train_block == 4096 else 0,
    )
    got = {r["test_id"]: (r["train_id"], r["prediction"]) for r in found.collect()}
    assert got == brute_force(points, queries)


def test_nearest_neighbour_of_uniform_vectors(spark):
    rng = np.random.default_rng(5)
    points = [(i, rng.random(3).tolist(), "x") for i in range(400)]
    queries = [(i, rng.random(3).tolist()) for i in range(50)]
    train = spark.createDataFrame(points, "vec_id bigint, embedding array<double>, label string")
    test = spark.createDataFrame(queries, "vec_id bigint, embedding array<double>")
    found = neighbours.nearest_neighbour(train, test, train_block=20, test_block=6, broadcast_bytes=0)
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == brute_force(points, queries)


def test_shells_spare_most_copies_of_clustered_rows():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 8)) * 100
    points = np.repeat(centres, 200, axis=0) + rng.normal(size=(4000, 8))
    distance = np.sqrt(((points[:, None] - centres[None]) ** 2).sum(axis=2))
    own = distance.argmin(axis=1)
    shells = [(c, s) for c in range(20) for s in np.array_split(np.sort(distance[own == c, c]), 10)]
    cells, low, high = np.array([c for c, _ in shells]), np.array([s[0] for _, s in shells]), np.array([s[-1] for _, s in shells])
    needed = neighbours._needed(distance, np.full(4000, 0.5), cells, low, high)
    home = (cells == own[:, None]) & (low <= distance.min(axis=1)[:, None]) & (high >= distance.min(axis=1)[:, None])
    assert (needed | ~home).all()
    assert needed.sum(axis=1).mean() < 10 < len(shells) / 10


def test_rows_meet_about_the_square_root_of_the_pivots(monkeypatch):
    """Distances a row are counted; the shells found hold every row within the bound."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(60, 8)) * 100
    points = np.repeat(centres, 100, axis=0) + rng.normal(size=(6000, 8))
    tree = neighbours.PivotTree(points[rng.choice(6000, 900, replace=False)])
    counted = []
    squared = neighbours._squared

    def watched(a, b):
        counted.append(len(a) * len(b))
        return squared(a, b)

    monkeypatch.setattr(neighbours, "_squared", watched)
    top, wide, cell, far = tree.nearest(points)
    assert sum(counted) / 6000 < 4 * 30
    reach = np.array([(wide[top == t].min(), wide[top == t].max()) if (top == t).any() else (np.inf, -np.inf) for t in range(30)])
    cells = np.unique(cell)
    index = neighbours.ShellIndex(
        tree, reach, cells, cells, np.array([far[cell == c].min() for c in cells]), np.array([far[cell == c].max() for c in cells])
    )
    queries = np.repeat(centres, 5, axis=0) + rng.normal(size=(300, 8))
    own, bound = index.home(queries), np.full(300, 2.5)
    counted.clear()
    found = index.others(queries, bound, own)
    assert sum(counted) / 300 < 900 / 4
    for q, shell, others in zip(queries, own, found, strict=True):
        near = set(np.searchsorted(cells, cell[((points - q) ** 2).sum(axis=1) <= 2.5**2]).tolist())
        assert near <= {int(shell), *others.tolist()}


@pytest.mark.parametrize("bad", [None, [1.0, None], [1.0, float("nan")], [float("inf"), 1.0], [1.0]])
def test_bad_vectors_are_named(spark, bad):
    schema = "vec_id bigint, embedding array<double>, label string"
    good = spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, [1.0, 3.0], "b")], schema)
    worse = good.union(spark.createDataFrame([(77, bad, "c")], schema))
    for train, test in ((good, worse), (worse, good)):
        with pytest.raises(ValueError, match="77"):
            neighbours.nearest_neighbour(train, test)


def test_nearest_neighbour_without_rows(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<double>, label string")
    some = spark.createDataFrame([(1, [1.0, 2.0], "a")], "vec_id bigint, embedding array<double>, label string")
    assert neighbours.nearest_neighbour(empty, some).collect() == []
    assert neighbours.nearest_neighbour(some, empty).collect() == []


def test_task_functions_need_no_package_on_the_executors(tmp_path):
    tree = neighbours.PivotTree(np.zeros((1, 2)))
    index = neighbours.ShellIndex(tree, np.zeros((1, 2)), *np.zeros((4, 1), np.int64))
    functions = neighbours._place(tree), neighbours._other_blocks(index), neighbours._nearest_in_block
    (tmp_path / "functions").write_bytes(cloudpickle.dumps(functions))
    code = """
import pickle, sys
import pandas as pd
place, _, nearest = pickle.load(open("functions", "rb"))
rows = pd.DataFrame({"id": [1, 2], "v": [[1.0, 2.0], [3.0, 4.0]], "label": ["a", "b"]})
assert list(next(place(iter([rows]))).cell) == [0, 0]
assert list(nearest(rows, rows).train_id) == [1, 2]
assert not any(name.startswith("trendspark") for name in sys.modules)
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)

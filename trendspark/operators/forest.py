"""Random forests: training, prediction, accuracy and named feature importance."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.functions import numeric_columns, text_columns
from trendspark.operators.encode import encoding_stages
from trendspark.operators.split import key_hash
from trendspark.operators.wide_forest import slot_importance
from trendspark.settings import (
    CLASSIFIER_TREES,
    IMPORTANCE_ROWS,
    IMPORTANCE_SEED,
    IMPORTANCE_SUBSAMPLING,
    IMPORTANCE_TARGET,
    IMPORTANCE_TREES,
)


MAX_SLOTS = 20_000
# rows of a training part, and those beyond which parts grow instead of becoming more
PART_ROWS, MANY_PARTS, LARGE_PART_ROWS = 50_000, 4_096, 2_000_000


def training_parts(rows: int) -> int:
    """The number of training parts for a number of rows, on any cluster.

    One for each 50,000 rows up to 4,096; as many for more rows, until one for each two million.
    """
    return max(1, min(-(-rows // PART_ROWS), MANY_PARTS), -(-rows // LARGE_PART_ROWS))


def _spread(rows: DataFrame, key: Sequence[Column], partitions: int) -> DataFrame:
    """``rows`` in an order and in parts that follow from their values alone.

    Bagging draws by partition and row, so a forest repeats only if these do: whatever
    the cores, the input's partitions and their order are.
    """
    names = [f"_key{i}" for i in range(len(key))]
    named = rows.withColumns(dict(zip(names, key, strict=True)))
    return named.repartition(partitions, names[0]).sortWithinPartitions(*names).drop(*names)


def train_forest(
    training: DataFrame,
    num_trees: int = CLASSIFIER_TREES,
    seed: int | None = None,
    partitions: int | None = None,
    keep: bool = True,
    key: str | Sequence[str] | None = None,
) -> RandomForestClassificationModel:
    """Fit a forest on columns ``features`` and ``label``.

    Training reads its input several times before the first tree grows, so the two
    columns are kept, in memory as far as it goes and on disk beyond, until it is done;
    ``keep=False`` reads a written table again instead.

    Rows are dealt by a hash of their ``key`` into ``partitions`` parts, by default as many as follow from the
    number of rows (:func:`training_parts`, which counts them): with one seed the same rows give the
    same forest on any cluster. Without a key they are dealt by their values, and
    equal rows share a part; name the key of a table in which a few values are frequent.
    """
    forest = RandomForestClassifier(numTrees=num_trees)
    if seed is not None:
        forest.setSeed(seed)
    values = F.xxhash64(vector_to_array("features"), "label")
    keys = [key] if isinstance(key, str) else list(key or ())
    order = [F.xxhash64(*keys), values] if keys else [values]
    chosen = training.select("features", "label", *(k for k in keys if k not in ("features", "label")))
    rows = _spread(chosen, order, partitions or training_parts(training.count())).select("features", "label")
    if not keep:
        return forest.fit(rows)
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return forest.fit(rows)
    finally:
        rows.unpersist()


def predict(model: RandomForestClassificationModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows)


def save_model(model, path: str) -> None:
    """Write a fitted model, replacing what is at ``path``."""
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str):
    """A model of any kind that :func:`save_model` wrote, such as the fitted steps of an importance report."""
    return DefaultParamsReader.loadParamsInstance(path, spark.sparkContext)


def load_forest(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of right predictions as a one-row table ``accuracy``; null without rows."""
    right = F.when(F.col(prediction) == F.col(label), 1.0).otherwise(0.0)
    return predictions.agg(F.avg(right).alias("accuracy"))


def _widest(rows: DataFrame, texts: list[str], max_slots: int) -> list[str]:
    """The text columns of most values, if all have more than ``max_slots`` together."""
    if not texts:
        return []
    counts = rows.agg(*(F.approx_count_distinct(c, 0.02).alias(c) for c in texts)).first().asDict()
    return sorted(texts, key=counts.get, reverse=True)[:5] if sum(counts.values()) > max_slots else []


def feature_importance(
    merged: DataFrame,
    *,
    target: str = IMPORTANCE_TARGET,
    order_by: str | None = "MERCHANT_ID",
    rows: int = IMPORTANCE_ROWS,
    mode: str = "classify",
    exclude: Iterable[str] = (),
    strict_types: bool = False,
    partitions: int | None = None,
    max_slots: int = MAX_SLOTS,
    model_path: str | None = None,
) -> DataFrame:
    """Importance of every feature slot for ``target``: ``idx``, ``name``, ``score``.

    Text columns are indexed and one-hot encoded, so a slot stands for one value; numeric
    columns are slots as they are. ``mode="regress"`` fits the amount itself, on all rows,
    dealt by the hash of ``order_by`` into parts whose number follows from that of the rows. ``mode="classify"`` takes every value of the target
    for a class of its own and is fitted on a bounded sample of labelled rows: the ``rows``
    rows of the least hash of ``order_by``, in one partition. The fitted
    steps are saved at ``model_path`` if one is given.

    Where text columns have more than ``max_slots`` values together, ``mode="regress"`` goes by
    :func:`slot_importance`, which reports every slot and holds none that a row does not have. It fits no steps
    that could be saved, and ``mode="classify"`` has no such way: both raise an error that names columns for ``exclude``.
    """
    if mode not in ("classify", "regress"):
        raise ValueError("mode is 'classify' or 'regress'")
    keys = [order_by] if order_by else sorted(merged.columns)
    if mode == "classify":
        # the limit leaves one partition, so that bagging repeats
        sample = merged.orderBy(key_hash(keys), *keys).limit(rows)
    else:
        hashed = key_hash(keys)
        sample = _spread(merged, [F.xxhash64(hashed), hashed, *map(F.col, keys)], partitions or training_parts(merged.count()))
    sample = sample.cache()  # used by several fits
    try:
        left_out = {*exclude, target}
        texts = text_columns(sample, left_out)
        numbers = numeric_columns(sample, left_out, strict_types)
        wide = _widest(sample, texts, max_slots)
        if wide and mode == "regress" and not model_path:
            return slot_importance(sample, target, numbers, texts, IMPORTANCE_TREES, IMPORTANCE_SUBSAMPLING, IMPORTANCE_SEED)
        if wide:
            raise ValueError(f"text columns with too many values for one slot each; exclude some of: {', '.join(wide)}")
        stages = encoding_stages(texts) if texts else []
        stages.append(VectorAssembler(inputCols=numbers + ["OHE_" + c for c in texts], outputCol="features"))
        options = {
            "featuresCol": "features",
            "seed": IMPORTANCE_SEED,
            "numTrees": IMPORTANCE_TREES,
            "cacheNodeIds": True,
            "subsamplingRate": IMPORTANCE_SUBSAMPLING,
        }
        if mode == "classify":
            stages.append(StringIndexer(inputCol=target, outputCol="label", handleInvalid="keep"))
            stages.append(RandomForestClassifier(labelCol="label", **options))
        else:
            stages.append(RandomForestRegressor(labelCol=target, **options))
        model = Pipeline(stages=stages).fit(sample)
        slots = model.transform(sample).schema["features"].metadata["ml_attr"]["attrs"]
    finally:
        sample.unpersist()

    if model_path:
        save_model(model, model_path)
    weights = model.stages[-1].featureImportances
    scored = [
        (slot["idx"], slot["name"], float(weights[slot["idx"]]))
        for kind in slots.values()
        for slot in kind
    ]
    table = merged.sparkSession.createDataFrame(scored, "idx int, name string, score double")
    return table.orderBy(F.desc("score"), "idx")

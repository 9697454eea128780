"""Feature vectors, value indexes and one-hot encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.operators.joins import lookup_join
from trendspark.staging import release, stage

# of a column whose values go through the driver: how many, and how many bytes in all
MAX_LABELS = 100_000
MAX_LABEL_BYTES = 16 * 1024 * 1024


def assemble_features(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Replace the columns by one vector column."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df).drop(*columns)


def index_labels(df: DataFrame, column: str, output: str = "label", max_labels: int = MAX_LABELS) -> DataFrame:
    """Add the index of a value: 0.0 for the most frequent, ties in alphabetical order.

    Values come out as :func:`index_columns` numbers them; a null is an error.
    """
    return _index(df, [column], [output], "error", max_labels)


def index_columns(
    df: DataFrame, columns: Sequence[str], prefix: str = "IDX_", max_labels: int = MAX_LABELS
) -> DataFrame:
    """Index several text columns at once; a null gets the index after the last value.

    One job counts the values of all columns, with partial counts before the shuffle.
    A column of up to ``max_labels`` values of ``MAX_LABEL_BYTES`` gets a
    ``StringIndexerModel``. The values of any other column are numbered in parallel and
    joined back, so that neither the driver nor a task ever holds them all. Either way the
    column metadata holds the number of slots and no values; :func:`slot_labels` names them.
    """
    return _index(df, columns, [prefix + c for c in columns], "keep", max_labels)


def _index(
    df: DataFrame, columns: Sequence[str], outputs: Sequence[str], handle_invalid: str, max_labels: int
) -> DataFrame:
    counts = _value_counts(df, columns)
    known = counts.where("_value IS NOT NULL")
    if handle_invalid == "error":
        for row in counts.where("_value IS NULL").collect():  # one per column at most
            raise ValueError(f"{columns[row[0]]} has null values, which have no index")
    measured = known.groupBy("_column").agg(F.count("*"), F.sum(F.octet_length("_value").cast("bigint"))).collect()
    sizes = {r[0]: r[1] for r in measured}  # one per column
    large = {r[0] for r in measured if r[1] > max_labels or r[2] > MAX_LABEL_BYTES}

    small = [i for i in range(len(columns)) if i not in large]
    if small:
        labels = {i: [] for i in small}
        listed = known.where(F.col("_column").isin(small)).select("_column", "_value", "_n")
        for i, value, _ in listed.orderBy("_column", F.desc("_n"), "_value").collect():
            labels[i].append(value)
        for i in small:
            df = StringIndexerModel.from_labels(labels[i], columns[i], outputs[i], handle_invalid).transform(df)
    for i in sorted(large):
        numbered = stage(_numbered(known.where(F.col("_column") == i), outputs[i]).drop("_column"), "value-index")
        keyed = df.withColumn("_value", F.col(columns[i]).cast("string"))
        joined = lookup_join(keyed, numbered, ["_value"], "left")
        df = joined.select(*df.columns, F.coalesce(outputs[i], F.lit(float(sizes[i]))).alias(outputs[i]))
    release(counts)
    for i, output in enumerate(outputs):
        slots = sizes.get(i, 0) + (handle_invalid == "keep")
        df = df.withMetadata(output, {"ml_attr": {"type": "nominal", "num_vals": slots, "name": output}})
    return df


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [
        F.struct(F.lit(i).alias("_column"), F.col(c).cast("string").alias("_value")) for i, c in enumerate(columns)
    ]
    counted = df.select(F.inline(F.array(*cells))).groupBy("_column", "_value").agg(F.count("*").alias("_n"))
    return stage(counted, "value-counts")


def slot_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``name, slot, value``: which value an index of a column stands for, however many there are.

    The slots are those of :func:`index_columns`, :func:`index_labels` and :func:`one_hot`; a
    null has none here. Nothing passes through the driver but sizes per partition.
    """
    counts = _value_counts(df, columns)
    names = F.element_at(F.array(*(F.lit(c) for c in columns)), F.col("_column") + 1)
    numbered = _numbered(counts.where("_value IS NOT NULL"), "slot")
    labels = stage(numbered.select(names.alias("name"), F.col("slot").cast("int"), F.col("_value").alias("value")), "labels")
    release(counts)
    return labels


def _numbered(counts: DataFrame, output: str) -> DataFrame:
    """Distinct values of each column with their position in (count descending, value) order, from 0.

    The values are cut into ordered ranges, and the range number is written with the
    row, so that later steps see the same ranges. The position is then the position
    in the range plus the sizes of the ranges of the same column before it.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = stage(
        counts.repartitionByRange(partitions, "_column", F.desc("_n"), F.asc("_value")).withColumn(
            "_range", F.spark_partition_id()
        ),
        "value-ranges",
    )
    # a row per range, and one more per column
    sizes = stage(ranges.groupBy("_column", "_range").agg(F.count("*").alias("_size")), "value-sizes")
    earlier = Window.partitionBy("_column").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_column", "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_column", "_range").orderBy(F.desc("_n"), "_value"))
    placed = ranges.withColumn("_place", place).join(F.broadcast(before), ["_column", "_range"])
    return placed.select("_column", "_value", (F.col("_place") - 1 + F.col("_before")).cast("double").alias(output))


def encoding_stages(columns: Sequence[str], index_prefix: str = "IDX_", prefix: str = "OHE_") -> list:
    """Pipeline stages from text columns to one-hot vectors.

    For tables whose size bounds the number of values; see :func:`one_hot` otherwise.
    """
    indexes, outputs = [index_prefix + c for c in columns], [prefix + c for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexes, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexes, outputCols=outputs),
    ]


def one_hot(
    df: DataFrame,
    columns: Sequence[str],
    index_prefix: str = "IDX_",
    prefix: str = "OHE_",
    max_labels: int = MAX_LABELS,
) -> DataFrame:
    """Sparse one-hot vectors ``OHE_<column>`` beside the indexes.

    Every value has a slot, named by :func:`slot_labels`; a null encodes to the zero vector.
    """
    indexed = index_columns(df, columns, index_prefix, max_labels)
    encoder = OneHotEncoder(
        inputCols=[index_prefix + c for c in columns], outputCols=[prefix + c for c in columns]
    )
    return encoder.fit(indexed).transform(indexed)


def transform_features(df: DataFrame, feature_columns: Sequence[str], label_column: str) -> DataFrame:
    """Feature columns to ``features``, label column to its index ``label``."""
    assembled = assemble_features(df, feature_columns)
    return index_labels(assembled, label_column).drop(label_column)

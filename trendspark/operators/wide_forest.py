"""Importance by a regression forest over more one-hot slots than a dense row can hold.

``RandomForestRegressor`` keeps every slot of every row, which grows with rows times values. Here a
row is a short array of cells, the bin of each number and the value of each text, and a level of all trees is one
aggregation by tree, node, column and cell: the work grows with rows times columns.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from itertools import accumulate
from math import exp, factorial

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendspark.operators.encode import index_columns, slot_labels
from trendspark.staging import Scratch

BINS, DEPTH = 32, 5
# the largest distance of a target from the middle of its range, as a whole number: sums are exact in any order
_TARGET_STEPS = 1 << 30
_DRAWS = 1 << 40


def _bags(values: Column, trees: int, rate: float, seed: int) -> Column:
    """How often each tree draws a row: Poisson numbers that follow from the row's values."""
    shares = list(accumulate(exp(-rate) * rate**k / factorial(k) for k in range(20)))
    limits = F.array(*(F.lit(int(s * _DRAWS)) for s in shares))
    draw = lambda tree: F.pmod(F.xxhash64(values, tree, F.lit(seed)), F.lit(_DRAWS))
    return F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.size(F.filter(limits, lambda x: x <= draw(t))))


def _cells(rows: DataFrame, target: str, numbers: Sequence[str], texts: Sequence[str], trees: int, rate: float, seed: int) -> DataFrame:
    """``y, cells, times, nodes`` of every row; a null text has the cell behind those of the values."""
    doubles = {c: F.col(c).cast("double") for c in dict.fromkeys([*numbers, target])}
    bad = [F.count_if(d.isNull() | F.isnan(d)).alias(c) for c, d in doubles.items()]
    low, high, *invalid = rows.agg(F.min(doubles[target]), F.max(doubles[target]), *bad).first()
    if any(invalid):
        raise ValueError(f"null or NaN in {', '.join(c for c, n in zip(doubles, invalid) if n)}")
    bagged = rows.select(*rows.columns, _bags(F.xxhash64(*rows.columns), trees, rate, seed).alias("_times"))
    found = bagged.withColumns({f"_number{i}": doubles[c] for i, c in enumerate(numbers)})
    names = [f"_number{i}" for i in range(len(numbers))]
    if names:
        cuts = found.approxQuantile(names, [i / BINS for i in range(1, BINS)], 0.001)
        splits = [[float("-inf"), *sorted(set(c)), float("inf")] for c in cuts]
        found = Bucketizer(splitsArray=splits, inputCols=names, outputCols=[f"_bin{i}" for i in range(len(names))]).transform(found)
    indexed = index_columns(found, list(texts))
    y = F.round((doubles[target] - (low + high) / 2) / ((high - low) / 2 or 1.0) * _TARGET_STEPS).cast("long")
    cells = [F.col(f"_bin{i}") for i in range(len(names))] + [F.col("IDX_" + c) for c in texts]
    start = F.transform("_times", lambda n: F.when(n > 0, 1).otherwise(0))
    return indexed.select(y.alias("y"), F.array(*(c.cast("int") for c in cells)).alias("cells"), F.col("_times").alias("times"), start.alias("nodes"))


def _best_splits(rows: DataFrame, n_numbers: int, offsets: Sequence[int], sizes: Sequence[int], seed: int) -> list:
    """The split of most gain of each tree and node, among a random third of the slots; one row a node."""
    by_tree = rows.select("y", "cells", F.posexplode(F.arrays_zip("nodes", "times")).alias("tree", "at"))
    drawn = by_tree.where("at.nodes > 0").select("tree", F.col("at.nodes").alias("node"), F.col("at.times").alias("n"), "y", F.posexplode("cells").alias("column", "cell"))
    sums = drawn.groupBy("tree", "node", "column", "cell").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("s"))
    node, column = Window.partitionBy("tree", "node", "column"), F.col("column")
    # a number parts at a bin, a text into one value and the others
    up_to = node.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    whole = sums.where("column = 0").groupBy("tree", "node").agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
    number = sums.where(column < n_numbers).withColumns({"n": F.sum("n").over(up_to), "s": F.sum("s").over(up_to)})
    of = lambda held: F.element_at(F.array(*map(F.lit, held)), column + 1)
    text = sums.where((column >= n_numbers) & (F.col("cell") < of(sizes)))
    slot = F.when(column < n_numbers, column).otherwise(of(offsets) + F.col("cell"))
    n, s = F.col("n").cast("double"), F.col("s").cast("double")
    other_n, other_s = F.col("all_n") - n, F.col("all_s") - s
    parts = s * s / n + other_s * other_s / other_n
    gain = parts - F.col("all_s").cast("double") * F.col("all_s") / F.col("all_n")
    split = (
        number.unionByName(text).join(F.broadcast(whole), ["tree", "node"]).withColumn("slot", slot)
        .where((F.col("n") < F.col("all_n")) & (F.pmod(F.xxhash64("tree", "node", "slot", F.lit(seed)), F.lit(3)) == 0))
        .withColumns({"gain": gain, "parts": parts}).where("gain > 1e-12 * parts")
    )
    best = F.max(F.struct("gain", (-F.col("slot")).alias("least"), "slot", "column", "cell")).alias("best")
    return split.groupBy("tree", "node").agg(best).select("tree", "node", "best.*").collect()


def _descend(rows: DataFrame, splits: list, n_numbers: int) -> DataFrame:
    """Rows at the next level: node ``2 n`` or ``2 n + 1``, 0 where a node was not split."""
    table = [([int(r.tree * 64 + r.node) for r in splits], [(int(r.column), int(r.cell)) for r in splits])]
    schema = "at array<int>, splits array<struct<column int, cell int>>"
    held = rows.sparkSession.createDataFrame(table, schema).select(F.map_from_arrays("at", "splits").alias("split"))

    def step(node: Column, tree: Column) -> Column:
        split = F.col("split")[tree * 64 + node]
        own = F.element_at("cells", split["column"] + 1)
        left = F.when(split["column"] < n_numbers, own <= split["cell"]).otherwise(own == split["cell"])
        return F.when(split.isNull(), 0).otherwise(2 * node + F.when(left, 0).otherwise(1))

    return rows.crossJoin(F.broadcast(held)).withColumn("nodes", F.transform("nodes", step)).drop("split")


def slot_importance(
    rows: DataFrame, target: str, numbers: Sequence[str], texts: Sequence[str], trees: int, rate: float, seed: int
) -> DataFrame:
    """``idx, name, score`` of every slot: numbers, then the values of each text, most frequent first.

    Trees of five levels over all rows, with bags, thirds of the slots at a node and gains by variance as
    ``RandomForestRegressor`` has them; the draws are its own and follow from values, so a report repeats in any layout.
    Numbers part at 32 quantiles. What reaches the driver is one split a node, 31 a tree. A null or NaN in
    ``target`` or a number is an error; a null text is in none of its column's slots.
    """
    spark = rows.sparkSession
    labels = slot_labels(rows, list(texts))
    counted = {r[0]: r[1] for r in labels.groupBy("name").count().collect()}  # one per column
    sizes = [0] * len(numbers) + [counted.get(c, 0) for c in texts]
    offsets = [0] * len(numbers) + [len(numbers) + n for n in accumulate(sizes[len(numbers) : -1], initial=0)]
    scores: dict[int, float] = defaultdict(float)
    with Scratch(spark, "wide-forest") as scratch:
        at = scratch.stage(_cells(rows, target, numbers, texts, trees, rate, seed), "cells")
        gains: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
        for _ in range(DEPTH):
            splits = _best_splits(at, len(numbers), offsets, sizes, seed)
            if not splits:
                break
            for r in splits:
                gains[r.tree][r.slot] += r.gain
            at = _descend(at, splits, len(numbers))
    for _, of_tree in sorted(gains.items()):
        for slot, gain in sorted(of_tree.items()):
            scores[slot] += gain / sum(of_tree[s] for s in sorted(of_tree)) / len(gains)
    scored = spark.createDataFrame(sorted(scores.items()), "idx int, score double")
    named = spark.createDataFrame(list(enumerate(numbers)), "idx int, name string")
    first = F.create_map(*(F.lit(x) for c, n in zip(texts, offsets[len(numbers) :], strict=True) for x in (c, n)))
    values = labels.select((first[F.col("name")] + F.col("slot")).alias("idx"), F.concat(F.lit("OHE_"), "name", F.lit("_"), "value").alias("name"))
    table = named.unionByName(values).join(F.broadcast(scored), "idx", "left")
    return table.select("idx", "name", F.coalesce("score", F.lit(0.0)).alias("score")).orderBy(F.desc("score"), "idx")

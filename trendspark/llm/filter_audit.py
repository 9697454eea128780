"""Audit of five quality filters in every order they can be applied.

A document fails each filter or not, so all that matters about it is a mask of five bits.
Documents are counted by part and mask, 32 cells a part at most. Each cell is folded across
the constant array of the 120 orders by ``transform`` and ``aggregate``: a fold walks an order
with the filters already applied as its state, and gives one struct of weighted counts a step.
The 600 structs of a part's cells are added element by element.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, map_arrow, slices

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80  # distinct words per 100 words
MAX_CAPITALS = 10  # capitals per 100 characters
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"#$%&*|"
_COPY = 1 << FILTERS.index("E")


def failure_mask(text: bytes, n_chars: int) -> int:
    """Bits of the failed filters A to D of a text in UTF-8 that has ``n_chars`` code points.

    A: under 100 words. B: fewer than 80 distinct words in 100. C: more than 10 capitals
    A-Z in 100 characters. D: one of ``#$%&*|``. ``bytes.split`` cuts at just the six
    ASCII blanks that end a word here.
    """
    words = text.split()
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    marks = len(text) - len(text.translate(None, _MARKS))
    failed = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT * len(words),
        100 * capitals > MAX_CAPITALS * n_chars,
        marks > 0,
    )
    return sum(1 << i for i, f in enumerate(failed) if f)


def text_failures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "lang") -> DataFrame:
    """``id, part, digest, mask`` of every row; a null text is empty, a null part the empty string."""
    out = pa.schema([("id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("mask", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes = pc.utf8_length(batch["text"]).to_pylist()
            texts = [t.as_buffer().to_pybytes() for t in batch["text"]]
            masks = [failure_mask(t, n) for t, n in zip(texts, sizes, strict=True)]
            yield batch_of(out, [batch["id"], batch["part"], [hashlib.sha256(t).digest() for t in texts], masks])

    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    return map_arrow(rows, run, "id long, part string, digest binary, mask int")


def failure_cells(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and mask of all five filters.

    Filter E fails a row whose text some smaller id has too. Rows that share text, part and labels are
    counted before they are shuffled, with their least id and its rows: the least id of a text tells
    how many of them fail, and a text that a third of all rows share is a few rows by then.
    """
    rows = text_failures(docs, **columns).groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    known = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .withColumn("salt", F.lit(0).cast("long"))
    )
    # rows without an id meet no label; the salt spreads them
    salted = rows.withColumn("salt", F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long")))
    labelled = salted.join(known, ["id", "salt"], "left").select(
        "id", "digest", "part", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least")
    alike = labelled.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"), least
    )
    # a few rows a digest: parts by labels
    entry = F.struct("part", "mask", "good", "toxic", "n", "unnamed", "least")
    texts = alike.groupBy("digest").agg(F.min("least.id").alias("first"), F.collect_list(entry).alias("rows"))
    row = texts.select("first", F.inline("rows"))
    stays = F.col("unnamed") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = row.select("part", "mask", "good", "toxic", (F.col("n") - stays).alias("copies"), stays.alias("stays"))
    both = F.array(
        F.struct(F.col("mask").bitwiseOR(_COPY).alias("mask"), F.col("copies").alias("n")),
        F.struct(F.col("mask").alias("mask"), F.col("stays").alias("n")),
    )
    cells = split.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    return cells.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def _orders() -> Column:
    """The 120 orders as arrays of the filters' bits: one folded constant in the plan."""
    orders = [[1 << FILTERS.index(f) for f in order] for order in permutations(FILTERS)]
    return F.from_json(F.lit(str(orders)), "array<array<int>>")


def _fold(order: Column) -> Column:
    """One struct a step for a cell ``mask, n, good, toxic`` along an order of bits."""
    none = F.lit(0).cast("long")
    step_type = "struct<bit:int," + ",".join(f"{m}:bigint" for m in MEASURES) + ">"
    start = F.struct(F.lit(0).alias("prior"), F.array().cast(f"array<{step_type}>").alias("steps"))

    def walk(state: Column, bit: Column) -> Column:
        mask, prior = F.col("mask"), state["prior"]
        applied = prior.bitwiseOR(bit)
        fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(prior) != 0

        def when(condition: Column, weight: str) -> Column:
            return F.when(condition, F.col(weight)).otherwise(none)

        values = (
            when(mask.bitwiseAND(applied) == 0, "n"), when(fails & ~gone, "n"), when(fails & gone, "n"),
            when(mask == bit, "n"), when(fails & ~gone, "good"), when(fails & ~gone, "toxic"),
        )
        step = F.struct(bit.alias("bit"), *(v.alias(m) for m, v in zip(MEASURES, values, strict=True)))
        return F.struct(applied.alias("prior"), F.concat(state["steps"], F.array(step.cast(step_type))).alias("steps"))

    return F.aggregate(order, start, walk, lambda state: state["steps"])


def audit_cells(cells: DataFrame) -> DataFrame:
    """One row per part, order and step from counted cells ``part, mask, n, good, toxic``."""

    def added(left: Column, right: Column) -> Column:
        return F.zip_with(left, right, lambda a, b: F.struct(a["bit"].alias("bit"), *((a[m] + b[m]).alias(m) for m in MEASURES)))

    orders = ["".join(order) for order in permutations(FILTERS)]
    folded = cells.select("part", F.flatten(F.transform(_orders(), _fold)).alias("steps"))
    # 32 cells a part at most
    summed = folded.groupBy("part").agg(F.collect_list("steps").alias("cells")).select(
        "part", F.aggregate(F.slice("cells", 2, 32), F.element_at("cells", 1), added).alias("steps")
    )
    bits = [1 << i for i in range(len(FILTERS))]

    def removed_by(bit: int) -> Column:
        zero = F.lit(0).cast("long")
        return F.aggregate("steps", zero, lambda n, s: n + F.when(s["bit"] == bit, s["removed"]).otherwise(zero))

    removed = map(removed_by, bits)
    placed = summed.select("part", F.array(*removed).alias("shapley"), F.posexplode("steps").alias("place", "s"))
    names = F.split(F.lit(",".join(orders)), ",")
    which = reduce(lambda rest, i: F.when(F.col("s.bit") == bits[i], i + 1).otherwise(rest), range(len(bits)), F.lit(0))
    return placed.select(
        "part",
        F.element_at(names, F.floor(F.col("place") / len(FILTERS)).cast("int") + 1).alias("filter_order"),
        (F.col("place") % len(FILTERS) + 1).cast("int").alias("step"),
        *(F.col(f"s.{m}").alias(m) for m in MEASURES),
        F.element_at("shapley", which).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """What each filter does at each step of all 120 orders, for every part of ``docs``.

    Columns ``part, filter_order, step`` and counts of documents: ``kept`` after the step, ``removed``
    by it, ``redundant`` (fail it, were gone before), ``unique_fails`` (fail no other filter), ``good_lost``
    and ``toxic_lost`` (removed with that label), ``shapley`` (removed by the filter over all orders).

    Every row is a document: repeated rows count as often and are no copies of each other.
    Filter E asks for a smaller id, so a row without an id fails it never and makes no other fail. A null
    text is empty, a null part the empty string. Of several label rows of an id any may set a
    label. A table without rows gives no rows. Columns other than the named ones are not read.
    """
    return audit_cells(failure_cells(docs, labels, **columns))

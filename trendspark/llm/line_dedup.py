"""Removal of lines and sentences that occurred before, anywhere in the corpus.

Texts are cut into lines and lines into sentences; a unit is normalised (letters in lower case,
runs of blanks one blank, none at the ends) and hashed to 128 bits. The digests are grouped
over all documents with partial sums, the occurrence of smallest document id and unit
number stays, and all others go. Units that follow each other and go are one run,
reported with its place in the original text, so that a passage is one row with its length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, join_counted, map_arrow, slices
from trendspark.staging import Scratch, stage

# a sentence ends with marks before a blank or at the end of its line; sentences tile the line
SENTENCE = r"(?:[^.!?]+|[.!?]+[^.!? \t\r\f\v])+[.!?]*|[.!?]+"
_SENTENCE = re.compile(SENTENCE)
_BLANKS = re.compile(r"[ \t\r\f\v]+")


def normalise(unit: str) -> str:
    return _BLANKS.sub(" ", unit).strip(" ").lower()


def cut_units(text: str) -> Iterator[tuple[int, int, str]]:
    """``start, end, normalised text`` of the sentences of each line that are not blank."""
    at = 0
    for line in text.split("\n"):
        for found in _SENTENCE.finditer(line):
            normal = normalise(found[0])
            if normal:
                yield at + found.start(), at + found.end(), normal
        at += len(line) + 1


def _named(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id, mark, text``; the mark tells different texts of one id apart."""
    text = F.col(text_column).cast("string")
    return docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def units(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, mark, unit, start, end, n_words, digest`` of each unit, numbered in its text.

    ``start`` and ``end`` are code points of the original text; a sentence starts with the blanks before it.
    """
    out = pa.schema(
        [("id", pa.int64()), ("mark", pa.int64()), ("unit", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
         ("n_words", pa.int32()), ("digest", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = (batch[c].to_pylist() for c in ("id", "mark", "text"))
            found = [
                (doc, mark, number, start, end, normal.count(" ") + 1,
                 hashlib.blake2b(normal.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                for doc, mark, text in zip(*columns, strict=True)
                for number, (start, end, normal) in enumerate(cut_units(text or ""))
            ]
            if found:
                yield batch_of(out, list(zip(*found, strict=True)))

    rows = _named(docs, id_column, text_column).where("id is not null")
    return map_arrow(rows, cut, "id long, mark long, unit int, start long, end long, n_words int, digest binary")


def _runs(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    spark = docs.sparkSession
    with Scratch(spark, "line-dedup") as scratch:
        found = scratch.stage(units(docs, id_column, text_column), "units")
        firsts = scratch.stage(
            found.groupBy("digest")
            .agg(F.min(F.struct("id", "unit")).alias("first"), F.count("*").alias("copies"))
            .where("copies > 1"),
            "firsts",
        )
        gone = join_counted(found, firsts, "digest", "copies").where("id <> first.id or unit <> first.unit")
        # repeated rows of one id and text are the same occurrences
        once = gone.dropDuplicates(["id", "mark", "unit"])
        in_text = Window.partitionBy("id", "mark").orderBy("unit")
        marked = once.withColumn("run", F.col("unit") - F.row_number().over(in_text))
        runs = marked.groupBy("id", "mark", "run").agg(
            F.min("start").alias("start_char"),
            F.max("end").alias("end_char"),
            F.count("*").alias("n_units"),
            F.sum("n_words").cast("long").alias("n_words"),
            F.min(F.struct("unit", F.col("first.id").alias("id"))).getField("id").alias("kept_id"),
            F.min("copies").alias("copies"),
        )
        return stage(runs.drop("run"), "runs")


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each run of units that goes: where it stands and where its first unit stays.

    ``doc_id, start_char, end_char, n_units, n_words, kept_doc_id, copies``. Of every unit the
    earliest occurrence by (document id, unit number) stays, also within one document; units of any length count.
    ``copies`` is the least number of occurrences of the run's units. Null and empty texts have no
    units; rows without an id take no part. Equal rows of one id hold the same occurrences, which are not repetitions of
    themselves; different texts of one id are different texts.
    """
    found = _runs(docs, id_column, text_column)
    kept = F.col("kept_id").alias("kept_" + id_column)
    return found.select(F.col("id").alias(id_column), "start_char", "end_char", "n_units", "n_words", kept, "copies")


def drop_repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with their repeated units cut out, and ``removed``: their original (start, end) places.

    A run that fills its lines goes with the line feed after it. Other columns stay; a column named
    ``removed`` is replaced. Rows are joined to their runs by id and text, so the same place in another text of that id
    stays. A text of which nothing is left is empty, a null text stays null.
    """
    place = F.struct("start_char", "end_char")
    gone = _runs(docs, id_column, text_column).groupBy("id", "mark").agg(F.array_sort(F.collect_list(place)).alias("removed"))
    gone = gone.withColumnsRenamed({"id": "_removed_id", "mark": "_removed_mark"})
    rows = docs.drop("removed")
    same = (F.col(id_column).cast("long") == F.col("_removed_id")) & (F.xxhash64(F.col(text_column).cast("string")) == F.col("_removed_mark"))
    joined = rows.join(gone, same, "left").drop("_removed_id", "_removed_mark")
    empty = "cast(array() as array<struct<start_char:bigint,end_char:bigint>>)"
    joined = joined.withColumn("removed", F.coalesce("removed", F.expr(empty)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for text, spans in zip(batch[text_column].to_pylist(), batch["removed"].to_pylist(), strict=True):
                kept, at = [], 0
                for span in spans:
                    start, end = span["start_char"], span["end_char"]
                    kept.append(text[at:start])
                    fills = text[start - 1 : start] in ("", "\n") and text[end : end + 1] == "\n"
                    at = end + fills
                texts.append(text if not spans else "".join([*kept, text[at:]]))
            at = batch.schema.get_field_index(text_column)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return map_arrow(joined, cut, joined.schema)

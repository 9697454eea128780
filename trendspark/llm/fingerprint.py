"""Quartile bucket digests of documents and a bounded difference score.

Byte triplets of a text (three of every window of four bytes) are hashed into 256
buckets and counted. The three quartiles of the counts cut the buckets into four classes,
two bits each. The digest is hexadecimal: a length code, the quartile ratios and the 64
bytes of classes. It moves a little where a text changes a little.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, map_arrow, slices
from trendspark.llm.ordered import bucket_bounds, bucket_count, bucket_of

BUCKETS = 256
# difference of two classes of a bucket; opposite ends count double
_CLASS_DIFFERENCE = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]], np.int64)
_LENGTH_LIMIT, _RATIO_WEIGHT = 64, 2
_LARGEST = 6 * BUCKETS + _LENGTH_LIMIT + 2 * 15 * _RATIO_WEIGHT
_FIRST_ID = -(1 << 63)


def _counts(data: np.ndarray) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(data), 1 << 16):
        for second, third, salt in ((1, 2, 1), (1, 3, 2), (2, 3, 3)):
            stop = min(start + (1 << 16), len(data) - third)
            if stop > start:
                x, y, z = (data[start + o : stop + o].astype(np.uint32) for o in (0, second, third))
                mixed = (x << 16 | y << 8 | z) * np.uint32(0x9E3779B1) + np.uint32(salt * 0x05EBCA6B)
                mixed = (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
                total += np.bincount(mixed >> np.uint32(24), minlength=BUCKETS)
    return total


def digest(text: str | None) -> str:
    """The digest of a text; null counts as empty. Texts under three bytes have no counts."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    counts = _counts(data)
    q1, q2, q3 = (int(x) for x in np.sort(counts)[[BUCKETS // 4, BUCKETS // 2, 3 * BUCKETS // 4]])
    classes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    quads = classes.reshape(-1, 4)
    body = (quads[:, 0] << 6 | quads[:, 1] << 4 | quads[:, 2] << 2 | quads[:, 3]).astype(np.uint8).tobytes()
    length = min(255, round(8 * math.log2(1 + len(data))))
    low, middle = (15 * q1 // q3, 15 * q2 // q3) if q3 else (0, 0)
    return bytes((length, low << 4 | middle)).hex() + body.hex()


def _classes(data: bytes) -> np.ndarray:
    body = np.frombuffer(data, np.uint8, offset=2)
    return np.stack((body >> 6, body >> 4 & 3, body >> 2 & 3, body & 3), axis=1).ravel()


def likeness(left: str, right: str) -> float:
    """One less the bounded difference of two digests: 1 for equal ones, 0 at the largest difference."""
    a, b = bytes.fromhex(left), bytes.fromhex(right)
    difference = int(_CLASS_DIFFERENCE[_classes(a), _classes(b)].sum())
    difference += min(_LENGTH_LIMIT, abs(a[0] - b[0]))
    difference += _RATIO_WEIGHT * (abs((a[1] >> 4) - (b[1] >> 4)) + abs((a[1] & 15) - (b[1] & 15)))
    return 1.0 - difference / _LARGEST


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every row; null and empty texts have one digest."""
    out = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch["text"].to_pylist()
            yield batch_of(out, [batch["id"], [len(t or "") for t in texts], [digest(t) for t in texts]])

    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return map_arrow(texts, run, "doc_id long, n_chars long, fingerprint string")


def compare_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each text's digest beside that of an edited text and of the next document.

    The edited text is the text with its last half replaced by the start of the next
    document by id (after the last: the first). ``near_edited`` and ``near_next`` are the
    likeness of the text's digest to these two.

    Rows are dealt by ranges of the id and read in order, so a task holds one text and the
    next; the first row of each range is sent to the range before it as well. Rows of one id
    follow each other by text. A null id comes first. A null text counts as empty; a table
    of one row is its own next, an empty one gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(_FIRST_ID)).alias("id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    bounds = bucket_bounds(texts.select("id"), "id", bucket_count(docs))
    dealt = texts.withColumn("bucket", bucket_of("id", bounds))
    # one row for each bucket: as many as shuffle partitions
    firsts = sorted(dealt.groupBy("bucket").agg(F.min("id").alias("id")).collect())
    ahead = [(row["id"], firsts[i - 1]["bucket"]) for i, row in enumerate(firsts)]
    extra = spark.createDataFrame(ahead, "id long, before int") if ahead else spark.createDataFrame([], "id long, before int")
    own = F.struct(F.col("bucket"), F.lit(0).alias("extra"))
    copy = F.struct(F.col("before").alias("bucket"), F.lit(1).alias("extra"))
    rows = (
        dealt.join(F.broadcast(extra), "id", "left")
        .select("id", "text", F.inline(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))))
        .repartitionByRange(max(1, len(firsts)), "bucket")
        .sortWithinPartitions("bucket", "extra", "id", "text")
    )
    out = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in slices(batches):
            found = []
            columns = (batch[c].to_pylist() for c in ("bucket", "extra", "id", "text"))
            for bucket, copied, doc, text in zip(*columns, strict=True):
                print_ = digest(text)
                if held and held[0] == bucket:
                    _, before, old, old_print = held
                    half = len(old) // 2
                    edited = old[: len(old) - half] + text[:half]
                    edited_print = digest(edited)
                    found.append(
                        (None if before == _FIRST_ID else before, len(old), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                         old_print, edited_print, likeness(old_print, edited_print), likeness(old_print, print_))
                    )
                held = None if copied else (bucket, doc, text, print_)
            if found:
                yield batch_of(out, list(zip(*found, strict=True)))

    return map_arrow(
        rows, compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )

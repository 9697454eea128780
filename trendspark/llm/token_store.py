"""Token ids of documents with Elias-Fano encoded boundaries.

A stored block holds the ids of a run of documents as one array (16-bit where the
vocabulary allows it, else 32-bit) and the positions where documents end as an
Elias-Fano sequence: the low bits of each position packed, the high bits in unary, and a
sample of every 64th unary one for select. That is about 2 + log2(tokens / documents)
bits a document, where a table of offsets takes 64. A block is bounded by its number of
ids, not by documents, and is one binary value of a row, so Spark's own writers place the
files in any store that Spark can reach, and a lost executor costs its tasks only.

Layout of a block, little endian: magic ``TSEF``, u8 version 1, u8 bytes an id (2 or 4),
u8 low bits, u8 0, u64 documents, u64 ids, u64 bytes of the low part, u64 bytes of the
high part, then document ids (i64 each), low part, high part, select samples (u64 each),
ids.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, map_arrow, slices
from trendspark.llm.ordered import bucket_bounds, bucket_count, bucket_of
from trendspark.llm.token_ids import shared_encoder

END_ID = 2
BLOCK_IDS = 1 << 19
SAMPLE = 64
_HEAD = "<4sBBBBQQQQ"


def _pack(values: np.ndarray, width: int) -> bytes:
    if not width:
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def _unpack(data: np.ndarray, n: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint64)
    bits = np.unpackbits(data, count=n * width, bitorder="little").reshape(n, width).astype(np.uint64)
    return (bits << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def encode_block(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of a block: documents in order, ``lengths`` adding up to ``ids``."""
    ends = np.cumsum(lengths).astype(np.uint64)
    n, universe = len(ends), int(ends[-1]) + 1
    low_bits = max(0, (universe // n).bit_length() - 1)
    low = _pack(ends & np.uint64((1 << low_bits) - 1), low_bits)
    ones = (ends >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(ones[-1]) + 1, np.uint8)
    unary[ones] = 1
    high = np.packbits(unary, bitorder="little").tobytes()
    size = 2 if int(ids.max(initial=0)) < 1 << 16 else 4
    head = struct.pack(_HEAD, b"TSEF", 1, size, low_bits, 0, n, len(ids), len(low), len(high))
    return b"".join(
        (head, doc_ids.astype("<i8").tobytes(), low, high, ones[::SAMPLE].astype("<u8").tobytes(), ids.astype(f"<u{size}").tobytes())
    )


class Block:
    """A stored block; ``end(i)`` finds one boundary without reading the others."""

    def __init__(self, data: bytes):
        magic, version, size, self.low_bits, _, self.n, n_ids, n_low, n_high = struct.unpack_from(_HEAD, data)
        if magic != b"TSEF" or version != 1:
            raise ValueError("not a block of token ids")
        at = struct.calcsize(_HEAD)
        self.doc_ids = np.frombuffer(data, "<i8", self.n, at)
        at += 8 * self.n
        self.low = np.frombuffer(data, np.uint8, n_low, at)
        self.high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        at += n_low + n_high
        samples = -(-self.n // SAMPLE)
        self.samples = np.frombuffer(data, "<u8", samples, at)
        self.ids = np.frombuffer(data, f"<u{size}", n_ids, at + 8 * samples)

    def end(self, i: int) -> int:
        """Select: where document ``i`` ends."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        while left:  # ones after the sample, byte by byte
            window = np.unpackbits(self.high[(at + 1) // 8 : (at + 1) // 8 + 64], bitorder="little")[(at + 1) % 8 :]
            ones = np.flatnonzero(window)
            step = min(left, len(ones))
            at, left = at + 1 + (int(ones[step - 1]) if step else len(window) - 1), left - step
        bits = np.unpackbits(self.low[i * self.low_bits // 8 : (i + 1) * self.low_bits // 8 + 1], bitorder="little")
        bits = bits[i * self.low_bits % 8 :][: self.low_bits].astype(np.int64)
        return ((at - i) << self.low_bits) + int((bits << np.arange(len(bits))).sum())

    def ends(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64)
        return ((high << np.uint64(self.low_bits)) | _unpack(self.low, self.n, self.low_bits)).astype(np.int64)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.end(i - 1) if i else 0 : self.end(i)]


def write_token_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    buckets: int | None = None,
) -> None:
    """Tokenize whole texts, append ``end_id`` to each and write blocks in ascending id order.

    Rows of ``path``: ``bucket, block, n_docs, n_ids, data``; (bucket, block) is the order.
    A null or empty text is the end id alone. Repeated rows and rows of one id come one
    after the other, equal ids by text; a null id sorts first and is stored as the smallest integer. An
    empty table gives a table without rows. Other columns are not read.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    parts = bucket_count(docs)
    # several ranges a task even out what a hash of so few numbers deals unevenly
    bounds = bucket_bounds(texts.select("id"), "id", buckets or 3 * parts)
    ordered = (
        texts.withColumn("bucket", bucket_of("id", bounds).cast("int"))
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "id", "text")
    )
    out = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        held_ids, held, total, at, number = [], [], 0, None, 0

        def block() -> pa.RecordBatch:
            data = encode_block(np.array(held_ids, np.int64), np.array([len(x) for x in held]), np.concatenate(held))
            return batch_of(out, [[at], [number], [len(held)], [total], [data]])

        for batch in slices(batches):
            encoder = encoder or shared_encoder(tokenizer)
            buckets, docs, texts = (batch[c].to_pylist() for c in ("bucket", "id", "text"))
            for bucket, doc, ids in zip(buckets, docs, encoder.encode_texts(texts, end_id), strict=True):
                if held and (bucket != at or total >= BLOCK_IDS):
                    yield block()
                    held_ids, held, total, number = [], [], 0, (number + 1 if bucket == at else 0)
                at = bucket
                held_ids.append(-(1 << 63) if doc is None else doc)
                held.append(ids)
                total += len(held[-1])
        if held:
            yield block()

    map_arrow(ordered, encode, "bucket int, block long, n_docs long, n_ids long, data binary", encodes=True).write.parquet(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the written blocks.

    ``start`` counts the ids of all documents before it, over all blocks: a sum over
    buckets, then one inside each bucket, on rows of sizes only.
    """
    stored = spark.read.schema("bucket int, block long, n_docs long, n_ids long, data binary").parquet(path)
    sizes = stored.groupBy("bucket", "block").agg(F.sum("n_ids").alias("n_ids"))
    per_bucket = sizes.groupBy("bucket").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_bucket.select("bucket", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("within"))
    # a few bytes for each block of half a million ids
    starts = starts.join(firsts, "bucket").select("bucket", "block", (F.col("first") + F.col("within")).alias("first"))
    found = map_arrow(
        stored.select("bucket", "block", "data"), _documents, "bucket int, block long, doc_id long, start long, n_tokens long, ids_crc32 long"
    )
    return found.join(starts, ["bucket", "block"]).select(
        "doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("bucket", "block", "doc_id", "start", "n_tokens", "ids_crc32")
    out = pa.schema([(n, pa.int32() if n == "bucket" else pa.int64()) for n in names])
    for batch in slices(batches, 1):
        block = Block(batch["data"][0].as_py())
        ends = block.ends()
        starts = np.concatenate(([0], ends[:-1]))
        crcs = [zlib.crc32(block.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
        ids = [None if d == -(1 << 63) else int(d) for d in block.doc_ids]
        n = block.n
        yield batch_of(out, [[batch["bucket"][0].as_py()] * n, [batch["block"][0].as_py()] * n, ids, starts, ends - starts, crcs])

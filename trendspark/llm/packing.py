"""Best-fit decreasing packing of token pieces into fixed windows.

Documents are cut into full windows first; what is left of each is a piece shorter than a
window. Pieces are dealt by a hash into packs of about ``PACK`` pieces, and each
pack is packed on its own: pieces by falling length, each into the open window with the
least room that still holds it. A segment tree over the remaining capacities finds that
window in log2(window) steps. A pack leaves some windows part full, which at this size
of pack is far below one percent; no task sees more than a pack.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, map_arrow, slices
from trendspark.llm.token_ids import shared_encoder
from trendspark.staging import stage

END_ID = 0
WINDOW = 1024
PACK = 16_384


class CapacityTree:
    """Open windows by remaining capacity; ``tightest(n)`` is the smallest capacity >= n in use."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, number: int) -> None:
        self.open[capacity].append(number)
        node = self.leaves + capacity
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, capacity: int) -> int:
        node = self.leaves + capacity
        while node:
            self.count[node] -= 1
            node >>= 1
        return self.open[capacity].pop()

    def tightest(self, least: int) -> int | None:
        node = self.leaves + least
        if node >= 2 * self.leaves:
            return None
        if self.count[node]:
            return least
        while node > 1 and (node & 1 or not self.count[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; equal lengths keep their order."""
    tree, used = CapacityTree(window), 0
    numbers, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-np.asarray(lengths), kind="stable").tolist():
        length = int(lengths[i])
        capacity = tree.tightest(length)
        if capacity is None:
            number, capacity, used = used, window, used + 1
        else:
            number = tree.take(capacity)
        numbers[i], offsets[i] = number, window - capacity
        if capacity > length:
            tree.add(capacity - length, number)
    return numbers, offsets


def cut_pieces(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of each piece of each document."""
    out = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in slices(batches):
            encoder = encoder or shared_encoder(tokenizer)
            found = []
            for doc, ids in zip(batch["id"].to_pylist(), encoder.encode_texts(batch["text"].to_pylist(), end_id), strict=True):
                ids = ids.astype("<u4", copy=False)
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    found.append((doc, start, len(piece), zlib.crc32(piece), len(ids)))
            yield batch_of(out, list(zip(*found, strict=True)))

    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return map_arrow(texts, cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long", encodes=True)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, **columns) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset`` in sequences of ``window`` ids.

    A document is its ids and then ``end_id``; a null or empty text is the end id alone.
    Each id is in one piece. Pieces of a sequence follow each other without a gap from offset
    0. Repeated rows are packed as often as they occur; a null id stays null. An empty
    table gives no pieces. Sequence ids are unique, not consecutive: the pack in the upper
    bits, the window in the lower 32.
    """
    pieces = stage(cut_pieces(docs, tokenizer, window, end_id, **columns), "pieces")
    packs = max(1, -(-pieces.count() // PACK))
    dealt = pieces.withColumn("pack", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(packs)))
    out = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

    def pack(group: pa.Table) -> pa.Table:
        order = [(c, "ascending") for c in ("doc_id", "start", "ids_crc32")]
        group = group.combine_chunks().sort_by(order)
        numbers, offsets = best_fit_decreasing(group["length"].to_numpy(), window)
        base = group["pack"][0].as_py() << 32
        columns = [group[n].combine_chunks() for n in out.names[:5]]
        return pa.Table.from_arrays([*columns, pa.array(base + numbers), pa.array(offsets)], schema=out)

    schema = ", ".join(f"{n} long" for n in out.names)
    return dealt.groupBy("pack").applyInArrow(pack, schema)

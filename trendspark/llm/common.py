"""Helpers that several operators share: Arrow maps, words and hashes of texts."""

from __future__ import annotations

import ctypes
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 16 << 20
SLICE_ROWS = 256

# the white space of a word split: space, tab, line feed, vertical tab, form feed, return
WHITE_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ENCODERS = "_trendspark_encoders"


def give_back() -> None:
    """Returns memory that this process has freed to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, encodes: bool = False
) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes, so that long texts do not add up.

    The bound is a session setting, only ever lowered here. Python workers serve one stage after the other: a task that does
    not encode tokens (``encodes``) gives back the encoder tables that its worker still holds, and each task what
    its arrays took, which the C library else keeps while later stages need memory of their own.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    bound = re.fullmatch(r"(\d+)b?", df.sparkSession.conf.get(key))
    if bound and int(bound[1]) > BATCH_BYTES:
        df.sparkSession.conf.set(key, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not encodes:
            sys.modules.pop(ENCODERS, None)
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows: what a task holds as Python objects stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


HOT_GROUPS = 200


def join_counted(rows: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` joined to the one row of their group in ``groups``, which counts its rows in ``count``.

    Groups of more than a two-hundredth of all grouped rows are 200 at most: their rows go to the rows by broadcast, so
    that no task takes a large group. The others are joined by their key. Both tables are read
    twice, so pass written ones.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    limit = total / HOT_GROUPS
    hot = groups.where(F.col(count) > limit)
    if hot.isEmpty():
        return rows.join(groups, key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(groups.where(F.col(count) <= limit), key)
    return rows.join(F.broadcast(hot), key).unionByName(others)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


# --- numpy inside tasks -------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(1024, 2 * n)
        _POWERS = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, 0x9E3779B97F4A7C15, np.uint64))))
    return _POWERS


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edges[0::2], edges[1::2]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``values[start:end]``; runs are not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    within = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    picked = values[np.repeat(starts, lengths) + within].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(picked * _powers(int(lengths.max()))[within], firsts)
    return mix(sums ^ (lengths.astype(np.uint64) << np.uint64(48)))


_FOLD_BYTES = np.arange(256, dtype=np.uint8)
_FOLD_BYTES[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[list(WHITE_SPACE)] = False


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of ``text``: runs between white space, A-Z in lower case."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return run_hashes(_FOLD_BYTES[data], *runs(_IN_WORD[data]))


def sequence_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive words; of all of them if there are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total += words[i : i + len(total)] * _powers(size)[i]
    return mix(total + np.uint64(size))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(sequence_hashes(word_hashes(text), size))


def text_codes(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")

"""MinHash near-dedup with sequential Bayesian verification.

1. One pass turns each text into its shingle set, a digest of the set, a MinHash
   signature and banded keys of it. Equal sets are one node from here on.
2. Documents that share a band meet in a bucket. A bucket does not emit its pairs: each
   member is compared with one pivot, the member that shares most buckets with others.
3. Pairs are judged by their signatures in batches. After each batch the similarity has
   a Beta posterior; a pair leaves as soon as the probability that it reaches the
   threshold falls below the chosen miss probability. Survivors are verified exactly, on
   full shingle sets.
4. Components of the verified links. Where a bucket still holds more than one component,
   its members across components are compared in blocks inside tasks, by signatures and
   then exactly, until components meet. No cap applies to buckets, partners or candidates.

A member meets its pivot in a group of bounded size: the pivot's row is sent once to each
chunk of about 256 partners, so neither a hub nor a group of a third of all rows lands in
one task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, join_counted, map_arrow, mix, shingle_set, slices
from trendspark.llm.components import connected_components
from trendspark.staging import Scratch, stage

HASHES = 256
BATCH = 32
CHUNK = 256
# keys of texts that are wanted go to the texts up to this size
BROADCAST_BYTES = 64 << 20
_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_FACTORS, _OFFSETS = _SEEDS[:HASHES] | np.uint64(1), _SEEDS[HASHES:]


def bands_for(threshold: float, miss: float) -> tuple[int, int]:
    """Bands and rows: the most rows that still miss a pair at the threshold at most ``miss`` often."""
    for rows in range(12, 0, -1):
        bands = HASHES // rows
        if (1 - threshold**rows) ** bands <= miss:
            return bands, rows
    return HASHES, 1


@lru_cache
def fewest_matches(threshold: float, miss: float) -> tuple[int, ...]:
    """For each batch end ``n``: the fewest equal hashes with P(similarity >= threshold) >= miss.

    With a uniform prior the posterior after ``m`` of ``n`` matches is Beta(m+1, n-m+1),
    whose upper tail at the threshold is P(Binomial(n+1, threshold) <= m).
    """
    bounds = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss and m < n:
            m += 1
            log = math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
            tail += math.exp(log + m * math.log(threshold) + (n + 1 - m) * math.log1p(-threshold))
        bounds.append(m)
    return tuple(bounds)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set that is not empty."""
    lowest = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        block = shingles[start : start + 2048]
        for at in range(0, HASHES, 32):
            values = _FACTORS[at : at + 32, None] * block + _OFFSETS[at : at + 32, None]
            np.minimum(lowest[at : at + 32], values.min(axis=1), out=lowest[at : at + 32])
    return lowest


def survivors(left: np.ndarray, right: np.ndarray, bounds: tuple[int, ...]) -> np.ndarray:
    """Rows of ``right`` that no batch of signatures rules out against ``left`` (a row or rows)."""
    alive, matches = np.arange(len(right)), np.zeros(len(right), np.int64)
    for i, least in enumerate(bounds):
        part = slice(i * BATCH, (i + 1) * BATCH)
        ours = left[part] if left.ndim == 1 else left[alive, part]
        matches[alive] += (right[alive, part] == ours).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


def _sketch(documents: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    out = pa.schema(
        [("id", pa.int64()), ("mark", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
         ("bands", pa.list_(pa.int64())), ("signature", pa.binary())]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(bands, dtype=np.uint64) + np.uint64(77))
        for batch in slices(batches):
            found = []
            for key, mark, text in zip(*(batch[c].to_pylist() for c in ("id", "mark", "text")), strict=True):
                shingles = shingle_set(text, size)
                if not len(shingles):
                    found.append((key, mark, 0, None, None, None))
                    continue
                lowest = minhash(shingles)
                keys = salt.copy()
                for r in range(rows):
                    keys = mix(keys ^ lowest[r * bands : (r + 1) * bands])
                digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                short = (lowest >> np.uint64(32)).astype(np.uint16).tobytes()
                found.append((key, mark, len(shingles), digest, keys.view(np.int64), short))
            yield batch_of(out, list(zip(*found, strict=True)))

    return map_arrow(documents, sketch, "id long, mark long, n_shingles long, digest binary, bands array<long>, signature binary")


def _star(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """Rows ``pivot, chunk, id, value``: a pivot's own row (``id`` null) leads each chunk of its partners."""
    sizes = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    heads = (
        values.withColumnRenamed("id", "pivot")
        .join(sizes, "pivot")
        .select("pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(None).cast("long").alias("id"), "value")
    )
    members = (
        pairs.join(sizes, "pivot")
        .select("pivot", F.pmod(F.xxhash64("id"), "chunks").alias("chunk"), "id")
        .join(values, "id")
        .select("pivot", "chunk", "id", "value")
    )
    return heads.union(members).repartition("pivot", "chunk").sortWithinPartitions("pivot", "chunk", F.asc_nulls_first("id"))


def _judge_signatures(pairs: DataFrame, signatures: DataFrame, bounds: tuple[int, ...]) -> DataFrame:
    """The pairs that the signatures leave in question."""
    out = pa.schema([("pivot", pa.int64()), ("id", pa.int64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, at = None, None
        for batch in slices(batches, 2048):
            pivots, ids, chunks = batch["pivot"].to_pylist(), batch["id"].to_pylist(), batch["chunk"].to_pylist()
            rows = _signatures(batch["value"])
            kept_pivots, kept_ids = [], []
            cuts = [i for i in range(len(ids)) if ids[i] is None or i == 0] + [len(ids)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if ids[start] is None:
                    head, at, start = rows[start], (pivots[start], chunks[start]), start + 1
                if start < end and at == (pivots[start], chunks[start]):
                    for i in survivors(head, rows[start:end], bounds):
                        kept_pivots.append(pivots[start + i])
                        kept_ids.append(ids[start + i])
            yield batch_of(out, [kept_pivots, kept_ids])

    return map_arrow(_star(pairs, signatures), judge, "pivot long, id long").distinct()


def _verify(pairs: DataFrame, texts: DataFrame, threshold: tuple[int, int], size: int) -> DataFrame:
    """The pairs whose full sets reach the threshold, as links ``a, b``."""
    most, whole = threshold
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, at = None, None
        for batch in slices(batches):
            a, b = [], []
            columns = (batch[c].to_pylist() for c in ("pivot", "chunk", "id", "value"))
            for pivot, chunk, key, text in zip(*columns, strict=True):
                shingles = shingle_set(text, size)
                if key is None:
                    head, at = shingles, (pivot, chunk)
                elif at == (pivot, chunk):
                    shared = len(np.intersect1d(head, shingles, assume_unique=True))
                    if shared and whole * shared >= most * (len(head) + len(shingles) - shared):
                        a.append(pivot)
                        b.append(key)
            yield batch_of(out, [a, b])

    return map_arrow(_star(pairs, texts), verify, "a long, b long")


def _across(
    entries: DataFrame, components: DataFrame, own: DataFrame, texts: DataFrame, bounds: tuple[int, ...],
    threshold: tuple[int, int], size: int, scratch: Scratch,
) -> DataFrame:
    """Links ``a, b`` between components that share a bucket.

    In each bucket the members of its largest component and the rest are cut into chunks;
    blocks are rest against rest and rest against largest, so a bucket that is one
    component but for a few members costs a few copies of it. A block judges signatures,
    then full sets, and stops comparing two components once they are linked, so it gives
    fewer links than it has members. A pair is compared in the first band that it shares.
    """
    labelled = entries.join(components, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    members = scratch.stage(labelled.join(mixed.select("key"), "key"), "mixed")
    if members.isEmpty():
        return members.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    sizes = members.groupBy("key", "component").count()
    shape = sizes.groupBy("key").agg(
        F.max(F.struct("count", "component")).alias("largest"), F.sum("count").alias("total")
    )
    shape = shape.select(
        "key",
        F.col("largest.component").alias("main"),
        F.ceil(F.col("largest.count") / CHUNK).alias("mains"),
        F.ceil((F.col("total") - F.col("largest.count")) / CHUNK).alias("rests"),
    )
    dealt = members.join(shape, "key").withColumn("is_main", F.col("component") == F.col("main"))
    dealt = dealt.withColumn("own", F.when(F.col("is_main"), -1 - F.pmod(F.xxhash64("id"), "mains")).otherwise(F.pmod(F.xxhash64("id"), "rests")))
    others = F.when(F.col("is_main"), F.sequence(F.lit(0).cast("long"), F.col("rests") - 1)).otherwise(
        F.concat(F.sequence(F.lit(0).cast("long"), F.col("rests") - 1), F.transform(F.sequence(F.lit(1).cast("long"), F.col("mains")), lambda i: -i))
    )
    blocks = dealt.select("key", "id", "component", "own", F.explode(others).alias("other")).select(
        "key", "id", "component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    marks = own.select("id", "bands", "signature")
    rows = (
        blocks.join(marks.join(texts, "id"), "id")
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high", "id")
        .select("key", "low", "high", "id", "component", "bands", "signature", "value")
    )
    most, whole = threshold
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(key: int, block: list) -> pa.RecordBatch:
            ids, parts, bands, signatures, held = zip(*block, strict=True)
            parts, bands = np.array(parts), np.array(bands, np.int64)
            signatures = np.frombuffer(b"".join(signatures), np.uint16).reshape(-1, HASHES)
            band = int(np.flatnonzero(bands[0] == key)[0])
            sets: dict[int, np.ndarray] = {}

            def of(i: int) -> np.ndarray:
                if i not in sets:
                    sets[i] = shingle_set(held[i], size)
                return sets[i]

            a, b = [], []
            for i in range(len(ids) - 1):
                near = np.flatnonzero(parts[i + 1 :] != parts[i]) + i + 1
                near = near[~(bands[near, :band] == bands[i, :band]).any(axis=1)]
                for j in near[survivors(signatures[i], signatures[near], bounds)].tolist():
                    if parts[i] == parts[j]:
                        continue
                    shared = len(np.intersect1d(of(i), of(j), assume_unique=True))
                    if whole * shared >= most * (len(of(i)) + len(of(j)) - shared):
                        a.append(ids[i])
                        b.append(ids[j])
                        parts[parts == parts[j]] = parts[i]
            return batch_of(out, [a, b])

        block, at = [], None
        for batch in slices(batches):
            columns = (batch[c].to_pylist() for c in ("key", "low", "high", "id", "component", "bands", "signature", "value"))
            for key, low, high, *member in zip(*columns, strict=True):
                if (key, low, high) != at:
                    if len(block) > 1:
                        yield linked(at[0], block)
                    block, at = [], (key, low, high)
                block.append(member)
        if len(block) > 1:
            yield linked(at[0], block)

    return map_arrow(rows, compare, "a long, b long")


def _text_rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id, mark, text``; the mark tells different texts of one id apart."""
    text = F.col(text_column).cast("string")
    return docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _only(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with a key in ``keys``, which go to the rows while they are few; else both are shuffled."""
    few = keys.count() * 16 * len(columns) <= BROADCAST_BYTES
    return rows.join(F.broadcast(keys) if few else keys, columns)


def _first_pairs(judged: DataFrame) -> DataFrame:
    """One pair for each id: with its least pivot."""
    return judged.groupBy("id").agg(F.min("pivot").alias("pivot")).select("pivot", "id")


def _still_apart(judged: DataFrame, components: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    left = components.select(F.col("id").alias("pivot"), F.col("component").alias("left"))
    right = components.select("id", F.col("component").alias("right"))
    ends = judged.join(left, "pivot", "left").join(right, "id", "left")
    return ends.where(F.coalesce("left", "pivot") != F.coalesce("right", "id")).select("pivot", "id")


def _components(
    docs: DataFrame, threshold: tuple[int, int], shingle: int, miss: float, id_column: str, text_column: str
) -> DataFrame:
    """``id, mark, n_shingles, component`` of every row: component is the least id of the texts linked to its own."""
    spark = docs.sparkSession
    rate = threshold[0] / threshold[1]
    bands, rows = bands_for(rate, miss)
    bounds = fewest_matches(rate, miss)
    texts = _text_rows(docs, id_column, text_column)
    with Scratch(spark, "near-dedup") as scratch:
        sketches = scratch.stage(_sketch(texts, shingle, bands, rows), "sketches")
        sets = sketches.where("digest is not null and id is not null")
        firsts = sets.groupBy("digest").agg(F.min(F.struct("id", "mark")).alias("first"), F.count("*").alias("n"))
        # a node is a set and named by its least id; of several sets of one id all but the first get a name of their own
        again = F.row_number().over(Window.partitionBy("first.id").orderBy("digest")) > 1
        spare = F.lit(-(1 << 62)) - F.xxhash64("digest").bitwiseAND(F.lit((1 << 62) - 1))
        firsts = scratch.stage(
            firsts.withColumn("node", F.when(again, spare).otherwise(F.col("first.id"))).select(
                "digest", "n", "node", F.col("first.id").alias("id"), F.col("first.mark").alias("mark")
            ),
            "firsts",
        )
        # one row of each set
        named = sets.join(firsts.select("digest", "id", "mark", "node"), ["digest", "id", "mark"])
        own = named.dropDuplicates(["digest"]).select(F.col("node").alias("id"), "bands", "signature")
        own = scratch.stage(own, "nodes")
        entries = own.select("id", F.explode("bands").alias("key"))
        shared = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        entries = scratch.stage(entries.join(shared, "key").distinct(), "entries")
        degrees = entries.groupBy("id").agg(F.sum("n").alias("degree"))
        ranked = entries.join(degrees, "id").select("key", "id", "degree")
        pivots = ranked.groupBy("key").agg(F.max(F.struct("degree", "id")).getField("id").alias("pivot"))
        pairs = scratch.stage(
            entries.join(pivots, "key").where("id <> pivot").select("pivot", "id").distinct(), "pairs"
        )
        signatures = own.select("id", F.col("signature").alias("value"))
        sharing = entries.select(F.col("id").alias("node")).distinct()
        places = scratch.stage(firsts.join(sharing, "node").select("id", "mark", "node"), "places")
        node_texts = scratch.stage(
            _only(texts, places, ["id", "mark"]).dropDuplicates(["node"]).select(F.col("node").alias("id"), F.col("text").alias("value")),
            "texts",
        )
        judged = scratch.stage(_judge_signatures(pairs, signatures, bounds), "judged")
        # a text is fetched for one pivot first, and for others only if that left it apart
        links = scratch.stage(_verify(_first_pairs(judged), node_texts, threshold, shingle), "links")
        components = connected_components(links, scratch)
        apart = scratch.stage(_still_apart(judged, components), "apart")
        if not apart.isEmpty():
            links = scratch.stage(links.union(_verify(apart, node_texts, threshold, shingle)), "links")
            components = connected_components(links, scratch)
        across = scratch.stage(
            _across(entries.select("key", "id"), components, own, node_texts, bounds, threshold, shingle, scratch), "across"
        )
        if not across.isEmpty():
            components = connected_components(links.union(across), scratch)
        # the least id of a component's sets
        labelled = firsts.join(components.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = labelled.groupBy("component").agg(F.min("id").alias("least"))
        groups = scratch.stage(labelled.join(least, "component").select("digest", "n", F.col("least").alias("component")), "groups")
        found = join_counted(sets.select("id", "mark", "n_shingles", "digest"), groups, "digest", "n")
        alone = sketches.where("digest is null or id is null").withColumn("component", F.col("id"))
        columns = ("id", "mark", "n_shingles", "component")
        return stage(found.select(*columns).unionByName(alone.select(*columns)), "near-duplicates")


def near_duplicates(
    docs: DataFrame,
    threshold: tuple[int, int] = (80, 100),
    shingle: int = 5,
    miss: float = 1e-4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Two documents are linked if 100 * |A and B| >= 80 * |A or B| (``threshold`` is that
    fraction) over their distinct ``shingle``-word shingles, words being runs between
    white space with A-Z in lower case. A text of fewer words is one shingle. Every link
    that is used was confirmed on the full sets; a pair at the threshold is missed with
    probability ``miss`` at most by the bands and once more by the signatures.

    Null and empty texts have no shingles and link with nothing, not with each other.
    Every row comes back, repeated ones too. Different texts of one id are different documents, and
    each has the component of its own text. A row without an id is in no
    group: its component is null and it is kept. Other columns are not looked at.
    """
    found = _components(docs, threshold, shingle, miss, id_column, text_column)
    return found.select(
        F.col("id").alias(id_column),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: tuple[int, int] = (80, 100),
    shingle: int = 5,
    miss: float = 1e-4,
) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one of smallest id.

    All columns stay. Of repeated rows of one id and text one stays; of different texts of the id that stays those
    that are linked stay once each, as they cannot be told which is the first. Rows without an id stay.
    """
    found = _components(docs, threshold, shingle, miss, id_column, text_column)
    gone = found.where("id <> component").select(F.col("id").alias("_gone_id"), F.col("mark").alias("_gone_mark")).distinct()
    named = docs.where(F.col(id_column).isNotNull()).withColumn("_mark", F.xxhash64(F.col(text_column).cast("string")))
    same = (F.col(id_column).cast("long") == F.col("_gone_id")) & (F.col("_mark") == F.col("_gone_mark"))
    return (
        named.join(gone, same, "left_anti")
        .dropDuplicates([id_column, "_mark"])
        .select(*docs.columns)
        .union(docs.where(F.col(id_column).isNull()))
    )

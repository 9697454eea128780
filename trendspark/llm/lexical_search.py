"""Ranked lexical search by the Best Position Algorithm.

Documents are read twice: once for the postings of the queries' terms and the statistics, once
block by block of postings for the search. In a block every term has an impact list: its
documents by falling impact. For a query the lists are read from the top in step; a document
met in one list is looked up in the others at once (direct access), which gives its whole
score and its place in each list. A list's best position is the end of the run of places
seen from the top, however they were seen. What a document not yet seen can score is at most the
sum of the impacts at the best positions; the search of a block ends once that is strictly
below the score of the k-th document, so that ties are complete.

Scores use statistics of all documents, so the best of the blocks hold the best of all; the
k-th score of earlier blocks of a task is carried on into the next.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, map_arrow, slices
from trendspark.staging import stage

# terms are runs of ASCII letters and digits and of everything beyond ASCII; A-Z in lower case
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
# postings that a block holds, and bytes of the queries that one pass over the documents serves
BLOCK_POSTINGS = 2_000_000
PASS_BYTES = 4 << 20
FIRST_STEP = 16
# cells of documents by lists that one numpy step may hold
STEP_CELLS = 2_000_000
SALTS = 64


def terms_of(text: str | bytes | None) -> list[bytes]:
    """The terms of a text in order, in UTF-8."""
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return data.translate(_TERM_BYTES).split()


def weight(documents: int, holding: int) -> int:
    """Weight of a term that ``holding`` of ``documents`` hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def saturation(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """``m`` of documents by their number of terms."""
    scaled = [25 + (75 * int(n) * documents) // total for n in lengths.tolist()]
    return np.array(scaled, np.int64)


class Block:
    """Impact lists of some documents: per term the documents by falling impact, and by number."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray):
        keep = impacts > 0
        terms, docs, impacts = terms[keep], docs[keep], impacts[keep]
        order = np.lexsort((docs, -impacts, terms))
        self.docs, self.impacts, terms = docs[order], impacts[order], terms[order]
        self.terms, self.starts = np.unique(terms, return_index=True)
        self.ends = np.append(self.starts[1:], len(terms))
        # direct access: postings by (term, document), with their place in the impact lists
        keys = terms << 32 | self.docs
        self.places = np.argsort(keys)
        self.keys = keys[self.places]


def best_positions(seen: np.ndarray, starts: np.ndarray, ends: np.ndarray, held: np.ndarray) -> np.ndarray:
    """How many places of each list are seen in a run from its top; ``held`` are known to be."""
    out = held.copy()
    for i in range(len(starts)):
        rest = seen[starts[i] + held[i] : ends[i]]
        out[i] += len(rest) if rest.all() else int(rest.argmin())
    return out


def search_block(block: Block, terms: np.ndarray, repeats: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Document numbers and scores of a block that can be among the ``k`` best for a query, and the accesses made.

    ``terms`` are distinct, ``repeats`` their numbers in the query. Documents strictly below
    ``least`` may be left out, and so may those strictly below the k-th of the block.
    """
    nothing = np.zeros(0, np.int64)
    at = np.searchsorted(block.terms, terms)
    held = block.terms[np.minimum(at, len(block.terms) - 1)] == terms if len(block.terms) else np.zeros(len(terms), bool)
    at, repeats = at[held], repeats[held]
    starts, ends, names = block.starts[at], block.ends[at], terms[held]
    # the lists of the query one after the other
    sizes = ends - starts
    firsts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    seen = np.zeros(int(sizes.sum()), bool)
    best = np.zeros(len(at), np.int64)
    read = np.zeros(len(at), np.int64)
    docs, scores, kth, step, accesses = nothing, nothing, least, FIRST_STEP, 0
    while True:
        # a list that was seen to its end gives nothing more; nothing seen yet bounds by the top
        open_lists = best < sizes
        at_best = block.impacts[np.minimum(starts + np.maximum(best - 1, 0), np.maximum(ends - 1, 0))]
        bound = int((np.where(open_lists, at_best, 0) * repeats).sum())
        if not open_lists.any() or bound < kth:
            break
        # sorted access: the next places of every list, those read by direct access left out
        upto = np.minimum(np.maximum(read, best) + step, sizes)
        rows = np.concatenate([np.arange(s + r, s + u) for s, r, u in zip(starts, np.maximum(read, best), upto, strict=True)])
        read = upto
        fresh = np.setdiff1d(block.docs[rows], docs)
        step *= 2
        width = max(1, STEP_CELLS // len(names))
        for some in (fresh[i : i + width] for i in range(0, len(fresh), width)):
            # direct access: every fresh document in every list
            wanted = (names[None, :] << 32 | some[:, None]).ravel()
            found = np.searchsorted(block.keys, wanted)
            hit = block.keys[np.minimum(found, len(block.keys) - 1)] == wanted
            accesses += len(wanted)
            places = block.places[found[hit]]
            which = np.tile(np.arange(len(names)), len(some))[hit]
            seen[firsts[which] + places - starts[which]] = True
            values = np.zeros(len(wanted), np.int64)
            values[hit] = block.impacts[places] * repeats[which]
            docs = np.concatenate((docs, some))
            scores = np.concatenate((scores, values.reshape(len(some), len(names)).sum(axis=1)))
        if len(scores) >= k:
            kth = max(kth, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        best = best_positions(seen, firsts, firsts + sizes, best)
    keep = scores >= max(kth, 1)
    return docs[keep], scores[keep], accesses


class Found:
    """The ``k`` best documents of a query so far: highest score, then least id, ids that are null last."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def least(self) -> int:
        return self.heap[0][0] if len(self.heap) == self.k else 0

    def add(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, 0 if doc_id is None else -doc_id)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)

    def rows(self) -> Iterator[tuple[int, int | None]]:
        return ((score, -minus if named else None) for score, named, minus in self.heap)


# --- tables -------------------------------------------------------------------


def postings(docs: DataFrame, numbers: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """``doc_id, n, terms, counts`` of every document with a term: how often it holds the numbered terms."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    out = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches):
            ids, n, held, counts = [], [], [], []
            for doc, text in zip(batch["id"].to_pylist(), batch["text"], strict=True):
                found = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                if found:
                    counted = Counter([known[t] for t in found if t in known])
                    ids.append(doc)
                    n.append(len(found))
                    held.append(list(counted))
                    counts.append(list(counted.values()))
            yield batch_of(out, [ids, n, held, counts])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id long, n long, terms array<int>, counts array<int>")


def _passes(queries: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Queries with terms, in blocks of about ``PASS_BYTES``; rows of one id and text are one query."""
    rows = queries.where(F.col(id_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("item_id"), F.col(text_column).cast("string").alias("text")
    ).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // PASS_BYTES))
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else rows
        yield [(r.item_id, terms_of(r.text)) for r in part.orderBy("item_id", "text").collect()]


def _search_pass(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int, id_column: str, text_column: str) -> DataFrame | None:
    spark = docs.sparkSession
    numbers = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    held = stage(postings(docs, numbers, id_column, text_column), "postings")
    documents, total = held.agg(F.count("*"), F.sum("n")).first()
    if not documents or not numbers:
        return None
    holding = dict(held.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # one row a term of the queries
    weights = np.zeros(len(numbers), np.int64)
    for term, df in holding.items():
        weights[term] = weight(documents, df)
    wanted = []
    for item, terms in items:
        counted = Counter(numbers[t] for t in terms)
        # a term that nearly all documents hold weighs nothing
        useful = sorted(t for t in counted if weights[t] > 0)
        wanted.append((item, np.array(useful, np.int64), np.array([counted[t] for t in useful], np.int64)))
    shared = spark.sparkContext.broadcast((weights, wanted))
    out = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, wanted = shared.value
        found = [Found(k) for _ in wanted]
        for ids, terms, owners, counts, lengths in _blocks(batches):
            m = saturation(lengths, documents, total)
            impacts = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[owners]))
            block = Block(terms, owners, impacts)
            for best, (_, names, repeats) in zip(found, wanted, strict=True):
                picked, scores, _ = search_block(block, names, repeats, k, best.least())
                for doc, score in zip(picked.tolist(), scores.tolist(), strict=True):
                    best.add(score, ids[doc])
        rows = [(i, doc, score) for i, best in enumerate(found) for score, doc in best.rows()]
        if rows:
            yield batch_of(out, list(zip(*rows, strict=True)))

    # at most k rows a query from each task; two steps, so that no task holds them all
    found = map_arrow(held, run, "item int, doc_id long, score long")
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    first = F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))
    some = salted.withColumn("place", first).where(F.col("place") <= k)
    place = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    ranked = some.withColumn("rank", place).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item) for i, (item, *_) in enumerate(wanted)], "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, and flat arrays of the postings, of documents with about ``BLOCK_POSTINGS`` postings together."""
    ids, parts, n = [], [], 0

    def block():
        terms, owners, counts, lengths = (np.concatenate(p) for p in zip(*parts, strict=True))
        return ids, terms, owners, counts, lengths

    for batch in slices(batches, 4096):
        terms, counts = batch["terms"], batch["counts"]
        sizes = np.diff(terms.offsets.to_numpy())
        owners = np.repeat(np.arange(len(ids), len(ids) + batch.num_rows), sizes)
        flat = [a.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for a in (terms, counts)]
        parts.append((flat[0], owners, flat[1], batch["n"].to_numpy(zero_copy_only=False)))
        ids += batch["doc_id"].to_pylist()
        n += len(owners)
        if n >= BLOCK_POSTINGS:
            yield block()
            ids, parts, n = [], [], 0
    if ids:
        yield block()


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents with a score above 0 for each query.

    A document's score for a query adds, over the query's terms with repeats, a weight that falls
    with the documents holding the term times a share that rises with its count in the document and falls
    with the document's length. Highest score first, equal scores by ascending id.

    Every row of ``docs`` is a document: repeated rows count as often and each takes a rank of its own;
    a row without an id ranks after equal scores and has a null id. Null and empty texts, and those
    without a term, are no documents. Queries without an id, a text or a term give no rows, nor do
    empty tables; equal query rows are one, and two texts of one id are ranked apart. Only the named columns are
    read. Postings of the queries' terms are written once; queries beyond ``PASS_BYTES`` take several passes.
    """
    if k < 1:
        raise ValueError("k is at least 1")
    found = None
    for items in _passes(queries, item_column, item_text_column):
        part = _search_pass(docs, items, k, id_column, text_column)
        if part is not None:
            found = part if found is None else found.union(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found

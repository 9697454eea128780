"""Exact nearest-neighbour classification as a blocked, pruned join."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.operators.split import key_hash
from trendspark.staging import release, stage

# functions of this module travel to the executors whole: only numpy and pandas, not this
# package, have to be installed there (where the package is shipped, e.g. by addPyFile, this changes nothing)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BROADCAST_BYTES = 64 * 1024 * 1024
MAX_PIVOTS = 16_384
MAX_BLOCKS = 250_000
# relative slack of the pruning bound, far above the rounding of a double
_SLACK = 1e-6
# cells of a difference array that one numpy step may hold
_STEP_CELLS = 4_000_000


def nearest_neighbour(
    train: DataFrame,
    test: DataFrame,
    *,
    vector: str = "embedding",
    label: str = "label",
    train_id: str = "vec_id",
    test_id: str = "vec_id",
    pivots: int | None = None,
    train_block: int = 4096,
    test_block: int = 4096,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Nearest training row of every test row: ``test_id, train_id, prediction``.

    Squared Euclidean distance; among equally near rows the least training id wins.
    Vectors are arrays of finite numbers of one length, and test ids are unique. A vector
    that is null, has a null, NaN or infinite component or another length is an error that
    names ids. Without training rows, or without test rows, the result is empty.

    Equal training vectors are one candidate, the one of the least id. If the candidates
    take up to ``broadcast_bytes`` they are sent to the test rows, which are then not
    shuffled. Beyond that, or if ``pivots`` is given:

    * ``pivots`` training rows (by default the square root of their number, ``MAX_PIVOTS`` at
      most) are picked by hash. They hang below the square root of as many top pivots, each below the
      nearest. A row goes to its nearest top pivot and there to the cell of the nearest pivot, so it
      meets two square roots of the pivots. Cells are
      cut into blocks of about ``train_block`` rows by the distance to the pivot, so a block
      is a shell: a range of distances around a pivot.
    * A test row first meets the one block of its cell in whose range it lies. The best
      row there is a bound: by the triangle inequality another block is needed only if its
      range meets ``[d - bound, d + bound]``, with ``d`` the distance to the pivot of the block. The same
      holds for all rows below a top pivot, so the pivots there are compared only if their top cannot be ruled out.
      Those blocks come second, and nothing else is left out: the result is exact.
    * The test rows that need a block are cut into shares of about ``test_block``, so each
      group is bounded on both sides however many rows want the same block. A group gives
      one candidate per test row, and the least candidate wins.

    Pairs of rows are never emitted; they exist only inside a numpy step. The driver holds
    the pivots, two distances per top pivot and two per block, at most ``MAX_BLOCKS`` blocks and as many more
    as there are pivots: beyond that blocks grow.
    """
    labelled = stage(train.select(F.col(train_id).alias("id"), _doubles(vector), F.col(label).alias("label")), "nn-train")
    q = stage(test.select(F.col(test_id).alias("id"), _doubles(vector)), "nn-test")
    id_kind, test_kind = labelled.schema["id"].dataType.simpleString(), q.schema["id"].dataType.simpleString()
    found_schema = f"test_id {test_kind}, distance double, train_id {id_kind}"
    labels = labelled.groupBy(F.col("id").alias("train_id")).agg(F.min("label").alias("prediction"))
    size = _check_vectors(q, _check_vectors(labelled, None, "training"), "test")
    t = stage(labelled.groupBy("v").agg(F.min("id").alias("id")), "nn-candidates")

    rows = t.count()
    if rows == 0:
        found = t.sparkSession.createDataFrame([], found_schema)
    elif pivots is None and rows * 8 * (size + 8) <= broadcast_bytes:
        found = _search_all(q, t, found_schema)
    else:
        found = _search_blocks(q, t, rows, pivots, max(train_block, rows // MAX_BLOCKS), test_block, found_schema)
    return found.join(labels, "train_id").select("test_id", "train_id", "prediction")


def _check_vectors(rows: DataFrame, size: int | None, name: str) -> int | None:
    """The common length of the vectors; an error that names the ids of bad ones."""
    if size is None:
        size = rows.agg(F.max(F.size("v"))).first()[0]
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    bad = rows.where(~F.coalesce(finite & (F.size("v") == F.lit(size)), F.lit(False))).select("id")
    ids = [str(r[0]) for r in bad.orderBy("id").limit(10).collect()]
    if ids and size is not None:
        raise ValueError(f"{name} vectors that are not {size} finite numbers, the first by id: {', '.join(ids)}")
    return size


def _search_all(q: DataFrame, t: DataFrame, found_schema: str) -> DataFrame:
    """Best training row of every test row, the training rows being few enough to send."""
    few = t.orderBy("id").toPandas()
    shared = t.sparkSession.sparkContext.broadcast((_matrix(few["v"]), few["id"].to_numpy()))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix, ids = shared.value
        for rows in batches:
            if len(rows):
                nearest, distance = _first_nearest(_matrix(rows["v"]), matrix)
                yield pd.DataFrame({"test_id": rows["id"].to_numpy(), "distance": distance, "train_id": ids[nearest]})

    return q.mapInPandas(search, found_schema)


def _search_blocks(
    q: DataFrame, t: DataFrame, rows: int, pivots: int | None, train_block: int, test_block: int, found_schema: str
) -> DataFrame:
    id_kind, test_kind = t.schema["id"].dataType.simpleString(), q.schema["id"].dataType.simpleString()
    tree = PivotTree(_pivot_matrix(t, pivots or min(math.isqrt(rows), MAX_PIVOTS)))
    placed = t.mapInPandas(_place(tree), f"id {id_kind}, v array<double>, cell int, far double, top int, wide double")
    parts = max(1, -(-rows // (64 * train_block)))
    ranged = stage(placed.repartitionByRange(parts, "cell", "far").withColumn("part", F.spark_partition_id()), "nn-cells")
    place = F.row_number().over(Window.partitionBy("part", "cell").orderBy("far", "id"))
    piece = F.floor((place - 1) / train_block)
    block = F.col("part").cast("long") * (1 << 44) + F.col("cell") * (1 << 24) + piece
    blocked = stage(ranged.select("id", "v", "cell", "far", "top", "wide", block.alias("block")), "nn-blocks")
    shells = (
        blocked.groupBy("block", "cell").agg(F.min("far"), F.max("far")).orderBy("cell", F.min("far"), "block").collect()
    )
    blocks, cells = np.array([r[0] for r in shells], np.int64), np.array([r[1] for r in shells], np.int64)
    low, high = np.array([r[2] for r in shells]), np.array([r[3] for r in shells])
    reach = np.tile([np.inf, -np.inf], (len(tree.tops), 1))
    for top, least, most in blocked.groupBy("top").agg(F.min("wide"), F.max("wide")).collect():
        reach[top] = least, most
    index = ShellIndex(tree, reach, blocks, cells, low, high)
    release(ranged)

    home = stage(q.mapInPandas(_home_block(index), f"id {test_kind}, v array<double>, shell int, block long"), "nn-home")
    found = _search(home, blocked, test_block, found_schema)
    if len(blocks) == 1:
        return found
    found = stage(found, "nn-found")
    bounds = home.join(found.select(F.col("test_id").alias("id"), F.col("distance").alias("bound")), "id")
    others = bounds.select("id", "v", "shell", "bound").mapInPandas(
        _other_blocks(index), f"id {test_kind}, v array<double>, blocks array<bigint>"
    )
    wanted = stage(others, "nn-others").select("id", "v", F.explode("blocks").alias("block"))
    return _least(found.union(_search(wanted, blocked, test_block, found_schema)))


def _search(wanted: DataFrame, blocked: DataFrame, test_block: int, found_schema: str) -> DataFrame:
    """Best training row of the wanted blocks for every test row."""
    # one row per block
    shares = F.broadcast(stage(wanted.groupBy("block").agg(F.ceil(F.count("*") / test_block).alias("shares")), "nn-shares"))
    left = wanted.join(shares, "block").withColumn("share", F.pmod(F.xxhash64("id"), "shares"))
    right = blocked.join(shares, "block").withColumn(
        "share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))
    )
    found = (
        left.select("block", "share", "id", "v")
        .groupBy("block", "share")
        .cogroup(right.select("block", "share", "id", "v").groupBy("block", "share"))
        .applyInPandas(_nearest_in_block, found_schema)
    )
    return _least(found)


def _least(found: DataFrame) -> DataFrame:
    best = F.min(F.struct("distance", "train_id")).alias("best")
    return found.groupBy("test_id").agg(best).select("test_id", "best.*")


def _doubles(vector: str) -> F.Column:
    return F.col(vector).cast("array<double>").alias("v")


def _pivot_matrix(t: DataFrame, pivots: int) -> np.ndarray:
    """The vectors of the ``pivots`` training rows with the least hash: a fixed number."""
    rows = t.select("v", key_hash(["id"]).alias("hash"), "id").orderBy("hash", "id").limit(pivots).collect()
    return np.array([r["v"] for r in rows], dtype=float)


def _squared(points: np.ndarray, others: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Squared distances of slices of ``points`` to all ``others``."""
    step = max(1, _STEP_CELLS // max(1, others.size))
    for start in range(0, len(points), step):
        part = slice(start, start + step)
        yield part, ((points[part, None, :] - others[None, :, :]) ** 2).sum(axis=-1)


def _first_nearest(points: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the first nearest of ``others`` for each point.

    The expanded square (one matrix product) only sorts out what is clearly farther;
    the rest is compared by the direct sum, in which equal vectors are equally far.
    """
    norms, sizes = (others**2).sum(axis=1), (points**2).sum(axis=1)
    nearest = np.empty(len(points), dtype=np.int64)
    distance = np.empty(len(points))
    step = max(1, _STEP_CELLS // len(others))
    for start in range(0, len(points), step):
        part = points[start : start + step]
        rough = sizes[start : start + step, None] + norms[None, :] - 2.0 * (part @ others.T)
        slack = 1e-9 * (sizes[start : start + step] + norms.max())
        rows, close = np.nonzero(rough <= (rough.min(axis=1) + slack)[:, None])
        exact = np.empty(len(rows))
        pairs = max(1, _STEP_CELLS // others.shape[1])
        for at in range(0, len(rows), pairs):
            exact[at : at + pairs] = ((part[rows[at : at + pairs]] - others[close[at : at + pairs]]) ** 2).sum(axis=1)
        least = np.minimum.reduceat(exact, np.searchsorted(rows, np.arange(len(part))))
        best = np.flatnonzero(exact == least[rows])
        first = np.unique(rows[best], return_index=True)[1]
        nearest[start : start + step], distance[start : start + step] = close[best[first]], least
    return nearest, distance


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def _distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.sqrt(np.concatenate([squared for _, squared in _squared(points, others)])) if len(points) else np.zeros((0, len(others)))


class PivotTree:
    """Pivots below the square root of as many top pivots, each below the nearest."""

    def __init__(self, pivots: np.ndarray):
        self.tops = pivots[: max(1, math.isqrt(len(pivots)))]
        top_of = _distances(pivots, self.tops).argmin(axis=1)
        order = np.argsort(top_of, kind="stable")
        # the cells of a top are neighbours
        self.centres = pivots[order]
        numbers = np.arange(len(self.tops))
        self.begins, self.ends = (np.searchsorted(top_of[order], numbers, side) for side in ("left", "right"))

    def nearest(self, points: np.ndarray, used: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Top, distance to it, cell and distance to its pivot of each point; ``used`` cells only.

        The cell is the nearest below the nearest top, which need not be the nearest of all:
        bounds by distances hold for any pivot.
        """
        to_tops = _distances(points, self.tops)
        if used is not None:
            empty = [not used[b:e].any() for b, e in zip(self.begins, self.ends, strict=True)]
            to_tops[:, empty] = np.inf
        top = to_tops.argmin(axis=1)
        cell, far = np.empty(len(points), np.int64), np.empty(len(points))
        for t in np.unique(top):
            rows = np.flatnonzero(top == t)
            below = np.arange(self.begins[t], self.ends[t])
            below = below if used is None else below[used[below]]
            distance = _distances(points[rows], self.centres[below])
            best = distance.argmin(axis=1)
            cell[rows], far[rows] = below[best], distance[np.arange(len(rows)), best]
        return top, to_tops[np.arange(len(points)), top], cell, far


class ShellIndex:
    """The tree with the range of distances of its rows: around each top, and of each shell around its pivot."""

    def __init__(
        self, tree: PivotTree, reach: np.ndarray, blocks: np.ndarray, cells: np.ndarray, low: np.ndarray, high: np.ndarray
    ):
        self.tree, self.reach, self.blocks, self.cells, self.low, self.high = tree, reach, blocks, cells, low, high
        numbers = np.arange(len(tree.centres))
        self.firsts, self.lasts = (np.searchsorted(cells, numbers, side) for side in ("left", "right"))

    def home(self, points: np.ndarray) -> np.ndarray:
        """The shell of each point's cell in which it lies."""
        _, _, cell, far = self.tree.nearest(points, self.firsts < self.lasts)
        return np.array([
            max(self.firsts[c], self.firsts[c] + np.searchsorted(self.low[self.firsts[c] : self.lasts[c]], d, "right") - 1)
            for c, d in zip(cell, far, strict=True)
        ], np.int64)

    def others(self, points: np.ndarray, bound: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
        """The shells but the own one that may hold a row within ``bound`` of each point."""
        tree = self.tree
        wanted: list[list[np.ndarray]] = [[] for _ in points]
        near = _needed(_distances(points, tree.tops), bound, np.arange(len(tree.tops)), *self.reach.T)
        for top in np.flatnonzero(near.any(axis=0)):
            below = slice(tree.begins[top], tree.ends[top])
            shells = np.arange(self.firsts[below.start], self.lasts[below.stop - 1])
            rows = np.flatnonzero(near[:, top])
            step = max(1, _STEP_CELLS // max(1, len(shells)))
            for part in (rows[i : i + step] for i in range(0, len(rows), step)):
                distance = _distances(points[part], tree.centres[below])
                found = _needed(distance, bound[part], self.cells[shells] - below.start, self.low[shells], self.high[shells])
                for row, held in zip(part, found, strict=True):
                    wanted[row].append(shells[held])
        joined = [np.concatenate(found) if found else np.zeros(0, np.int64) for found in wanted]
        return [found[found != shell] for found, shell in zip(joined, own, strict=True)]


def _place(tree: PivotTree):
    """Add the cell and the distance ``far`` to its pivot, and the top pivot with the distance ``wide`` to it."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                top, wide, cell, far = tree.nearest(_matrix(rows["v"]))
                yield rows.assign(cell=cell.astype(np.int32), far=far, top=top.astype(np.int32), wide=wide)

    return place


def _home_block(index: ShellIndex):
    """Add the place of the own block: of the nearest pivot's shells the one that the row lies in."""

    def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                shell = index.home(_matrix(rows["v"]))
                yield rows.assign(shell=shell.astype(np.int32), block=index.blocks[shell])

    return home


def _needed(distance: np.ndarray, bound: np.ndarray, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether a shell may hold a row within ``bound``, by rows and shells; ``distance`` is to each pivot."""
    to_pivot = distance[:, cells]
    reach = bound[:, None] + _SLACK * (1.0 + to_pivot + bound[:, None])
    return (low <= to_pivot + reach) & (high >= to_pivot - reach)


def _other_blocks(index: ShellIndex):
    """The blocks but the own one that may hold a row as near as ``bound``."""

    def other_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                bound, own = np.sqrt(rows["bound"].to_numpy()), rows["shell"].to_numpy()
                wanted = index.others(_matrix(rows["v"]), bound, own)
                yield rows[["id", "v"]].assign(blocks=[index.blocks[shells] for shells in wanted])

    return other_blocks


def _nearest_in_block(test: pd.DataFrame, train: pd.DataFrame) -> pd.DataFrame:
    columns = ["test_id", "distance", "train_id"]
    if not len(test) or not len(train):
        return pd.DataFrame(columns=columns)
    # in id order, the first of several equally near rows has the least id
    train = train.sort_values("id", ignore_index=True)
    nearest, distance = _first_nearest(_matrix(test["v"]), _matrix(train["v"]))
    return pd.DataFrame(
        {
            "test_id": test["id"].to_numpy(),
            "distance": distance,
            "train_id": train["id"].to_numpy()[nearest],
        }
    )

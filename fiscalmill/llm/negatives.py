"""Hard negatives of anchors by inner product, with cover trees.

Candidates get one more component, so that all are of one length; for an anchor, which
gets a zero there, a larger inner product then means a smaller distance, and a metric tree
serves. In a cover tree a node covers its members within its radius; its children are a
net of smaller radius, each further than that from the others, and hold the members near
them. An anchor's inner products with the members of a node lie between bounds that follow
from the node's centre and radius.

1. The top level is a net of at most ``CELLS`` centres, fitted on at most ``SAMPLE``
   candidates. Every candidate goes to its nearest centre; rows are laid out by centre
   and a hash of the id, so that a cell of any size (copies, say) spreads over tasks.
2. A task builds a tree of each ``SHARD`` rows it reads and searches it for a block of
   anchors together, best bound first. A node is left out for an anchor when its bounds
   lie outside of the anchor's windows or below what the anchor has found. The rows of
   leaves are scored exactly.
3. Anchors come in blocks of about ``BLOCK``. A first pass finds each anchor's positives,
   its nearest rows of the same label; their scores open one window each for the negatives,
   which a second pass finds. A task gives no more than the answers of a block.

Components are rounded down after scaling, so scores are whole numbers: exact below
2**43, rounded to double precision beyond, and held at the ends of a long.

Rows take no part with a null id, label or vector, or a component that is null or not
finite (scaled or not). Vectors of different length are not compared. A row never finds
its own id; rows that repeat an id are candidates each; a repeated anchor row is answered
once. Equal scores go by smaller id. Without positives an anchor has no rows. Other columns are
not read. An empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.llm.common import stored

SAMPLE = 4096
CELLS = 64
SHARD = 4096
TASK_ROWS = 2 * SHARD
BLOCK = 4096
LEAF = 128
#: A child's radius is at most its parent's divided by this.
BASE = 1.3
_LARGEST = 2**63 - 1024
_FOUND = "anchor int, nth int, vec_id long, score double"
_MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Node:
    centre: int
    radius: float
    children: list[Node]
    rows: np.ndarray  # of a leaf


class CoverTree:
    """Over the rows of a matrix of whole numbers."""

    def __init__(self, rows: np.ndarray):
        squares = np.einsum("ij,ij->i", rows, rows)
        self.rows, self.top = rows, float(squares.max())
        self.points = np.column_stack([rows, np.sqrt(self.top - squares)])
        self.slack = 1e-7 * math.sqrt(self.top)
        every = np.arange(len(rows))
        self.root = self._grow(every, 0, float(self._away(every, 0).max()))

    def _away(self, members: np.ndarray, centre: int) -> np.ndarray:
        """Distances, from the inner products of points of one length."""
        return np.sqrt(np.maximum(2 * (self.top - self.points[members] @ self.points[centre]), 0))

    def _leaves(self, members: np.ndarray, centre: int) -> list[Node]:
        """Leaves of at most ``LEAF`` rows, around their first row or the parent's centre, whichever is nearer to all."""
        out = []
        for i in range(0, len(members), LEAF):
            rows = members[i : i + LEAF]
            radius, at = min((float(self._away(rows, c).max()), c) for c in (int(rows[0]), centre))
            out.append(Node(at, radius + self.slack, [], rows))
        return out

    def _grow(self, members: np.ndarray, centre: int, radius: float) -> Node:
        children: list[Node] = []
        if len(members) > LEAF and radius > self.slack:
            small, rest, at = [], members, centre
            while len(rest):
                away = self._away(rest, at)
                near = away <= radius / BASE
                near |= rest == at
                if near.sum() > LEAF:
                    children.append(self._grow(rest[near], at, float(away[near].max())))
                else:
                    small.append(rest[near])
                rest = rest[~near]
                at = int(rest[0]) if len(rest) else -1
            if small:  # small children next to each other share leaves
                children += self._leaves(np.concatenate(small), centre)
        elif len(members) > LEAF:
            children = self._leaves(members, centre)
        return Node(centre, radius + self.slack, children, members if not children else members[:0])

    def bounds(self, anchors: np.ndarray, squares: np.ndarray, nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible inner product of each anchor with the members of each node."""
        radius = np.array([n.radius for n in nodes])
        products = anchors @ self.rows[[n.centre for n in nodes]].T
        both = squares[:, None] + self.top
        away = np.sqrt(np.maximum(both - 2 * products, 0))
        reach = np.sqrt(squares)[:, None] * radius
        upper = np.minimum(products + reach, (both - np.maximum(away - radius, 0) ** 2) / 2)
        lower = np.maximum(products - reach, (both - (away + radius) ** 2) / 2)
        rounding = 0.5 + 1e-9 * both
        return lower - rounding, upper + rounding


class Search:
    """The best rows of each anchor in each of its windows, over any number of trees.

    ``low`` and ``high`` (anchors x windows): the scores a window takes.
    """

    def __init__(self, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool, low: np.ndarray, high: np.ndarray, k: int):
        self.anchors, self.ids, self.labels, self.same, self.low, self.high, self.k = anchors, ids, labels, same, low, high, k
        self.squares = np.einsum("ij,ij->i", anchors, anchors)
        self.scores = np.full((low.size, k), -np.inf)
        self.found = np.full((low.size, k), np.iinfo(np.int64).max)
        self.visited = 0

    def _least(self) -> np.ndarray:
        """What a score must reach for each anchor and window."""
        return np.maximum(self.scores[:, -1].reshape(self.low.shape), self.low)

    def tree(self, tree: CoverTree, ids: np.ndarray, labels: np.ndarray) -> None:
        every = np.arange(len(self.anchors))
        lower, upper = tree.bounds(self.anchors, self.squares, [tree.root])
        heap = [(0.0, 0, tree.root, every, lower[:, 0], upper[:, 0])]
        pushed = 0
        while heap:
            _, _, node, active, lower, upper = heapq.heappop(heap)
            least = self._least()[active]
            inside = ((upper[:, None] >= least) & (lower[:, None] <= self.high[active]) & (self.low[active] <= self.high[active])).any(axis=1)
            active = active[inside]
            if not len(active):
                continue
            if not node.children:
                self.visited += len(node.rows)
                self._verify(tree, node.rows, active, ids, labels)
                continue
            lower, upper = tree.bounds(self.anchors[active], self.squares[active], node.children)
            least, high = self._least()[active], self.high[active]
            for c, child in enumerate(node.children):
                low, up = lower[:, c], upper[:, c]
                some = ((up[:, None] >= least) & (low[:, None] <= high)).any(axis=1)
                if some.any():
                    pushed += 1
                    best = float(np.minimum(up[some], high[some].max(axis=1)).max())
                    heapq.heappush(heap, (-best, pushed, child, active[some], low[some], up[some]))

    def _verify(self, tree: CoverTree, rows: np.ndarray, active: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """Score the rows of a leaf exactly and keep the best."""
        products = self.anchors[active] @ tree.rows[rows].T
        fits = (self.labels[active][:, None] == labels[rows]) == self.same
        fits &= self.ids[active][:, None] != ids[rows]
        least, high, windows = self._least()[active], self.high[active], self.low.shape[1]
        query, score, found = [], [], []
        for j in range(windows):
            a, r = np.nonzero(fits & (products >= least[:, j : j + 1]) & (products <= high[:, j : j + 1]))
            query.append(active[a] * windows + j)
            score.append(products[a, r])
            found.append(ids[rows[r]])
        query, score, found = np.concatenate(query), np.concatenate(score), np.concatenate(found)
        if not len(query):
            return
        met = np.unique(query)
        query = np.concatenate([np.repeat(met, self.k), query])
        score = np.concatenate([self.scores[met].ravel(), score])
        found = np.concatenate([self.found[met].ravel(), found])
        order = np.lexsort((found, -score, query))
        query, score, found = query[order], score[order], found[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        best = place < self.k
        self.scores[query[best], place[best]] = score[best]
        self.found[query[best], place[best]] = found[best]

    def batches(self) -> Iterator[pa.RecordBatch]:
        query, place = np.nonzero(np.isfinite(self.scores))
        windows = self.low.shape[1]
        columns = [(query // windows).astype(np.int32), (query % windows).astype(np.int32), self.found[query, place], self.scores[query, place]]
        for i in range(0, len(query), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 16)]) for c in columns], names=["anchor", "nth", "vec_id", "score"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _search(shared, dim: int):
    """Search the rows that a task reads, in trees of at most ``SHARD`` rows of a cell."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*shared.value)
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
            search.tree(CoverTree(_matrix(table.column("vec"), dim)), ids, labels)

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            edges = np.flatnonzero(np.diff(cells)) + 1
            for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                while start < stop:
                    if held and held[0].column("cell")[0].as_py() != cells[start]:
                        flush()
                    some = batch.slice(start, min(stop - start, SHARD - sum(h.num_rows for h in held)))
                    held.append(some)
                    start += some.num_rows
                    if sum(h.num_rows for h in held) == SHARD:
                        flush()
        if held:
            flush()
        yield from search.batches()

    return work


def _net(sample: np.ndarray) -> np.ndarray:
    """At most ``CELLS`` rows of the sample, each the furthest from those before it."""
    if not len(sample):
        return sample
    chosen = [0]
    away = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(CELLS, len(sample) // 16) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _long(column: str) -> F.Column:
    return F.greatest(F.least(F.col(column), F.lit(float(_LARGEST))), F.lit(-float(_LARGEST))).cast("long")


def mine(
    vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 10, scale: float = 256.0, window: tuple[int, int] = (30, 90), block: int = BLOCK
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors``: (vec_id, vec, label); ``is_anchor``: a condition on vec_id; ``window``: the
    negative's score in percent of the positive's, both ends included.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("vec").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & finite)
    rows = rows.withColumn("dim", F.size("vec"))
    lengths = rows.groupBy("dim").count().orderBy("dim").collect()  # lengths of vectors: one, as a rule
    parts = [_of_length(rows.where(F.col("dim") == r["dim"]), r["dim"], r["count"], is_anchor, positives, negatives, scale, window, block) for r in lengths]
    out = parts[0] if parts else vectors.sparkSession.createDataFrame([], _MINED)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _of_length(rows: DataFrame, dim: int, n: int, is_anchor, positives: int, negatives: int, scale: float, window: tuple[int, int], block: int) -> DataFrame:
    spark = rows.sparkSession
    # about SAMPLE rows, by a hash: bounded whatever the table
    key = F.xxhash64("vec_id", "vec", "label")
    share = min(1.0, SAMPLE / n)
    sample = rows.select("vec", key.alias("key")).where(F.pmod("key", F.lit(1_000_003)) < math.ceil(1_000_003 * share)).orderBy("key").limit(2 * SAMPLE).collect()
    centres = _net(np.floor(scale * np.array([r["vec"] for r in sample], float).reshape(len(sample), dim)))
    lengths = (centres**2).sum(axis=1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled = np.floor(scale * _matrix(batch.column("vec"), dim)) + 0.0  # one zero
            cell = (lengths - 2 * scaled @ centres.T).argmin(axis=1).astype(np.int32) if len(centres) else np.zeros(len(scaled), np.int32)
            offsets = pa.array(np.arange(0, scaled.size + 1, dim) if dim else np.zeros(len(scaled) + 1), pa.int32())
            vec = pa.ListArray.from_arrays(offsets, pa.array(scaled.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), vec, pa.array(cell)], names=["vec_id", "label", "vec", "cell"])

    placed = rows.select("vec_id", "label", "vec").mapInArrow(place, "vec_id long, label long, vec array<double>, cell int")
    placed = placed.withColumn("key", F.xxhash64("vec_id", "vec"))
    placed = placed.repartitionByRange(max(1, math.ceil(n / TASK_ROWS)), "cell", "key").sortWithinPartitions("cell", "key")
    placed = stored(placed, "cells")
    anchors = stored(placed.where(is_anchor(F.col("vec_id"))).select("vec_id", "label", "vec", "key").distinct(), "anchors")
    blocks = max(1, math.ceil(anchors.count() / block))
    parts = [
        _block(placed, anchors.where(F.pmod("key", F.lit(blocks)) == b), dim, positives, negatives, window)
        for b in range(blocks)
    ]
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], _MINED)
    if len(parts) == 1:
        return parts[0]
    paths = [stored(p, "mined") for p in parts]
    out = paths[0]
    for path in paths[1:]:
        out = out.unionByName(path)
    return out


def _block(placed: DataFrame, anchors: DataFrame, dim: int, positives: int, negatives: int, window: tuple[int, int]) -> DataFrame | None:
    """The rows of one block of anchors; what the driver holds is bounded by the block."""
    spark = placed.sparkSession
    asked = anchors.select("vec_id", "label", "vec").orderBy("vec_id", "label", "key").toArrow()
    if not asked.num_rows:
        return None
    ids, labels = asked.column("vec_id").to_numpy(), asked.column("label").to_numpy()
    matrix = _matrix(asked.column("vec").combine_chunks(), dim)

    def best(same: bool, low: np.ndarray, high: np.ndarray, k: int) -> DataFrame:
        shared = spark.sparkContext.broadcast((matrix, ids, labels, same, low, high, k))
        order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "vec_id")
        found = placed.select("vec_id", "label", "vec", "cell").mapInArrow(_search(shared, dim), _FOUND)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    every = np.full((len(ids), 1), np.inf)
    good = best(True, -every, every, positives).toArrow()
    scores, names = np.full((len(ids), positives), np.nan), np.zeros((len(ids), positives), np.int64)
    at = good.column("anchor").to_numpy(), good.column("rank").to_numpy() - 1
    scores[at], names[at] = good.column("score").to_numpy(), good.column("vec_id").to_numpy()
    # whole numbers within the percentages; a missing positive has a window that takes nothing
    low = np.nan_to_num(np.ceil(window[0] * scores / 100), nan=np.inf, posinf=np.inf, neginf=-np.inf)
    high = np.nan_to_num(np.floor(window[1] * scores / 100), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
    a, j = np.nonzero(~np.isnan(scores))
    opened = spark.createDataFrame(
        pa.table({"a": a.astype(np.int32), "j": j.astype(np.int32), "anchor_id": ids[a], "positive_id": names[a, j], "positive_score": scores[a, j]}),
    )
    found = best(False, low, high, negatives)
    joined = found.join(F.broadcast(opened), (F.col("anchor") == F.col("a")) & (F.col("nth") == F.col("j")))
    return joined.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        _long("positive_score").alias("positive_score"), _long("score").alias("negative_score"),
    )

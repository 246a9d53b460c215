"""Nearest neighbours by cosine, with vantage-point trees.

On the unit sphere cosine falls as Euclidean distance grows, so a metric tree serves.

1. A small tree, fitted on at most ``SAMPLE`` vectors, deals all vectors into shards:
   at each node by their distance to a vantage point. Only the cuts come from the
   sample; every vector is indexed. A shard of more than ``CELL`` vectors is dealt
   into cells by a hash, so a cell stays small however many vectors there are.
2. Vectors and queries meet sorted by cell, vectors first: a task builds the full tree
   of a cell and answers the queries that stream by in blocks. Each vector is shuffled
   once for a search, whatever the number of queries. A subtree is left out for the
   queries whose best distances, by the triangle inequality, it cannot beat.
3. A query first searches its own shard, and then, with the distance that it has got,
   those other shards that the triangle inequality leaves. ``factor`` relaxes the
   pruning: a part is skipped when factor times its least possible distance is not
   below the best so far. With factor one the search is exact; a larger one skips more.

Equal vectors, and their multiples by powers of two, (of any number of ids) are one
entry that keeps as many smallest ids as an answer can hold. Of other entries all that
rounding cannot part from the last place are scored, however many. Scores are sums in
exact arithmetic, rounded once, on the original vectors; components of any finite size
are fine, as vectors are scaled by powers of two before they are squared.

Vectors that are null, zero, or hold nulls or numbers that are not finite take no
part, nor do null ids. Vectors of different length are not compared. Rows of one id
are one candidate each when their vectors differ; a query never finds its own id, and
a repeated query is answered once per distinct vector. Equal scores go to the smaller
id. Other columns, of whatever name, are not read. An empty table gives none.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.llm.common import stored

SAMPLE = 8192
SHARD = 16384
#: Vectors that a cell of a shard holds, about.
CELL = 32768
LEAF = 256
QUERY_BLOCK = 8192
#: Places that a block of queries holds for its finds.
BLOCK_PLACES = 1 << 19
#: Cosines nearer than this may be equal.
SLACK = 1e-12
_FOUND = "query_id long, qkey long, vec_id long, score double"


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * points @ centre, 0))


class Cuts:
    """The upper tree: inner nodes (centre, median distance), leaves that are shards."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.nodes: list[tuple | None] = []
        self.leaves: list[int] = []
        self._grow(sample, shards)

    def _grow(self, points: np.ndarray, shards: int) -> int:
        number = len(self.nodes)
        self.nodes.append(None)
        if shards <= 1 or len(points) < 4:
            self.nodes[number] = (len(self.leaves),)
            self.leaves.append(number)
            return number
        # of some candidates the vantage point that sees the others most spread out
        tries = points[:: max(1, len(points) // 16)][:16]
        centre = max(tries, key=lambda c: (float(np.var(_distances(points, c))), tuple(c)))
        away = _distances(points, centre)
        cut = float(np.median(away))
        near = away <= cut
        if near.all():
            self.nodes[number] = (len(self.leaves),)
            self.leaves.append(number)
            return number
        left = self._grow(points[near], shards // 2)
        right = self._grow(points[~near], shards - shards // 2)
        self.nodes[number] = (centre, cut, left, right)
        return number

    def home(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        stack = [(0, np.arange(len(points)))]
        while stack:
            number, rows = stack.pop()
            node = self.nodes[number]
            if len(node) == 1:
                out[rows] = node[0]
                continue
            near = _distances(points[rows], node[0]) <= node[1]
            stack += [(node[2], rows[near]), (node[3], rows[~near])]
        return out

    def reach(self, points: np.ndarray, best: np.ndarray, factor: float) -> list[np.ndarray]:
        """For each shard the rows of the points that may find something nearer than their best there."""
        out = [np.empty(0, np.int64)] * len(self.leaves)
        stack = [(0, np.arange(len(points)))]
        while stack:
            number, rows = stack.pop()
            node = self.nodes[number]
            if len(node) == 1:
                out[node[0]] = rows
                continue
            away = _distances(points[rows], node[0])
            stack += [(node[2], rows[factor * (away - node[1]) <= best[rows]]), (node[3], rows[factor * (node[1] - away) <= best[rows]])]
        return out


class Tree:
    """A vantage-point tree over one shard, searched by many queries at once."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.root = self._grow(np.arange(len(points)))

    def _grow(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        centre, rest = rows[0], rows[1:]
        away = _distances(self.points[rest], self.points[centre])
        cut = float(np.median(away))
        near = away <= cut
        if near.all():
            return rows
        bounds = (float(away[near].min()), float(away[near].max()), float(away[~near].min()), float(away[~near].max()))
        return centre, bounds, self._grow(rest[near]), self._grow(rest[~near])

    def search(self, queries: np.ndarray, best: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k nearest points of each query (with -1 where there are fewer)."""
        self.queries, self.k, self.factor = queries, k, factor
        self.cosines = np.full((len(queries), k), -np.inf)
        self.rows = np.full((len(queries), k), -1, np.int64)
        self.best = best.copy()
        self.others: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_others, self.limit = 0, 1 << 20
        self._visit(self.root, np.arange(len(queries)))
        return self.rows, self.cosines

    def tied(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the last search the queries and rows of the points beyond the k that rounding cannot part from the last of them."""
        if not self.others:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        query, row, cosine = (np.concatenate(c) for c in zip(*self.others))
        near = cosine >= self.cosines.min(axis=1)[query] - SLACK
        self.others = [(query[near], row[near], cosine[near])]
        self.n_others = int(near.sum())
        return query[near], row[near]

    def _offer(self, active: np.ndarray, rows: np.ndarray):
        cosines = np.concatenate([self.cosines[active], self.queries[active] @ self.points[rows].T], axis=1)
        candidates = np.concatenate([self.rows[active], np.broadcast_to(rows, (len(active), len(rows)))], axis=1)
        if cosines.shape[1] > self.k:
            top = np.argpartition(-cosines, self.k - 1, axis=1)[:, : self.k]
            beyond = cosines >= np.take_along_axis(cosines, top, 1).min(axis=1, keepdims=True) - SLACK
            np.put_along_axis(beyond, top, False, 1)
            query, place = np.nonzero(beyond & (candidates >= 0))
            if len(query):
                self.others.append((active[query], candidates[query, place], cosines[query, place]))
                self.n_others += len(query)
                if self.n_others > self.limit:
                    self.tied()
                    self.limit = max(self.limit, 2 * self.n_others)
            cosines, candidates = np.take_along_axis(cosines, top, 1), np.take_along_axis(candidates, top, 1)
        self.cosines[active], self.rows[active] = cosines, candidates
        worst = cosines.min(axis=1)
        # a little slack, so that rounding never prunes an equal
        self.best[active] = np.minimum(self.best[active], np.sqrt(np.maximum(2 - 2 * worst, 0) + SLACK) + 1e-9)

    def _visit(self, node, active: np.ndarray):
        if not len(active):
            return
        if isinstance(node, np.ndarray):
            self._offer(active, node)
            return
        centre, (low_a, high_a, low_b, high_b), near, far = node
        self._offer(active, np.array([centre]))
        away = _distances(self.queries[active], self.points[centre])
        first = away <= (high_a + low_b) / 2
        for side in (first, ~first):  # the side a query lies on comes first for it
            for child, low, high in ((near, low_a, high_a), (far, low_b, high_b)) if side is first else ((far, low_b, high_b), (near, low_a, high_a)):
                own = active[side]
                least = np.maximum(np.maximum(low - away[side], away[side] - high), 0)
                self._visit(child, own[self.factor * least <= self.best[own]])


def _exact(a: list[float], b: list[float]) -> float:
    """Cosine from sums that are rounded once; products of single-precision numbers are exact."""
    dot = math.fsum(x * y for x, y in zip(a, b))
    return dot / (math.sqrt(math.fsum(x * x for x in a)) * math.sqrt(math.fsum(x * x for x in b)))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _even(flat.reshape(len(array), -1) if len(array) else np.empty((0, 1)))


def _even(rows: np.ndarray) -> np.ndarray:
    """The vectors, each times the power of two that brings its largest component near one: angles stay as they are."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True, initial=0))[1])


class Cell:
    """The tree of a cell's vectors and the exact answers that it gives."""

    def __init__(self, points: pa.Table, k: int, factor: float):
        self.raw, self.ids = _matrix(points.column("vec")), points.column("ids").to_pylist()
        self.tree, self.k, self.factor = Tree(_unit(self.raw)), k, factor
        self.held = Counter(v for some in self.ids for v in set(some))

    def answers(self, queries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Queries whose own id has many vectors here look for more places, so fewer of them go together."""
        own = np.array([self.held.get(q, 0) for q in queries.column("query_id").to_pylist()])
        order = np.argsort(own, kind="stable")
        at = 0
        while at < len(order):
            stop = min(len(order), at + QUERY_BLOCK)
            while stop > at + 1 and (stop - at) * (self.k + 1 + own[order[stop - 1]]) > BLOCK_PLACES:
                stop = at + (stop - at) // 2
            yield self._block(queries.take(pa.array(order[at:stop])), int(own[order[stop - 1]]))
            at = stop

    def _block(self, queries: pa.RecordBatch, own: int) -> pa.RecordBatch:
        found: list[tuple] = []
        asked = _matrix(queries.column("vec"))
        q_ids, q_keys = queries.column("query_id").to_pylist(), queries.column("qkey").to_pylist()
        # besides an answer the entries of the query's own id
        width = min(len(self.raw), self.k + 1 + own)
        rows, _ = self.tree.search(_unit(asked), queries.column("best").to_numpy(), width, self.factor)
        more: dict[int, list[int]] = {}
        for i, r in zip(*(a.tolist() for a in self.tree.tied())):
            more.setdefault(i, []).append(r)
        for i in range(len(asked)):
            vector = asked[i].tolist()
            scored = []
            for r in rows[i][rows[i] >= 0].tolist() + more.get(i, []):
                score = _exact(vector, self.raw[r].tolist())
                scored += [(-score, v) for v in self.ids[r] if v != q_ids[i]]
            found += [(q_ids[i], q_keys[i], v, -s) for s, v in sorted(scored)[: self.k]]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        columns = list(zip(*found)) or [()] * 4
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "qkey", "vec_id", "score"])


def _answer(k: int, factor: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by cell, vectors before queries: holds one cell's vectors and a batch of queries."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, points, cell = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, ask = batch.column("cell").to_numpy(), batch.column("ask").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(cells) != 0) | (ask[1:] != ask[:-1])) + 1
            for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                some = batch.slice(start, stop - start)
                if cells[start] != number:
                    number, points, cell = cells[start], [], None
                if not ask[start]:
                    points.append(some.select(["ids", "vec"]))
                elif points or cell:
                    if cell is None:
                        cell, points = Cell(pa.Table.from_batches(points), k, factor), []
                    yield from cell.answers(some)

    return answer


def nearest(vectors: DataFrame, is_query, k: int = 5, factor: float = 1.0) -> DataFrame:
    """(query_id, rank, vec_id, score). ``vectors``: (vec_id, vec); ``is_query``: a condition on vec_id."""
    clean = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec"))
    # bounds of a double: what is beyond them or not a number fails the comparison
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    clean = clean.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    clean = clean.withColumn("vec", F.transform("vec", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))  # one zero
    clean = clean.select("vec_id", "vec", F.size("vec").alias("dim"), F.xxhash64("vec").alias("vkey"))
    # of vectors equal up to a power of two the smallest ids: one more than an answer, which may hold the query itself
    ids = clean.dropDuplicates(["vec_id", "vec"])
    largest = F.array_max(F.transform("vec", F.abs))
    folded = ids.withColumn("scale", F.when(largest.between(1e-100, 1e100), F.pow(F.lit(2.0), F.floor(F.log2(largest)))).otherwise(1.0))
    folded = folded.withColumn("vec", F.transform("vec", lambda x: x / F.col("scale")))
    folded = folded.select("vec_id", "vec", "dim", F.xxhash64("vec").alias("vkey"))
    first, same = Window.partitionBy("dim", "vkey", "vec").orderBy("vec_id"), Window.partitionBy("dim", "vkey", "vec", "vec_id").orderBy("vec_id")
    entries = folded.withColumn("nth", F.dense_rank().over(first)).where(F.col("nth") <= k + 1).withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k)
    entries = stored(entries.groupBy("dim", "vkey", "vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "entries")
    queries = ids.where(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), F.col("vkey").alias("qkey"), "vec", "dim")

    parts = []
    for row in entries.groupBy("dim").count().orderBy("dim").collect():  # lengths of vectors: one, as a rule
        parts.append(_of_length(entries.where(F.col("dim") == row["dim"]), queries.where(F.col("dim") == row["dim"]), row["count"], k, factor))
    if not parts:
        found = vectors.sparkSession.createDataFrame([], _FOUND)
    else:
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
    best = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _of_length(entries: DataFrame, queries: DataFrame, n: int, k: int, factor: float) -> DataFrame:
    # the sample is bounded whatever the table: about SAMPLE rows, by a hash of the vector
    share = min(1.0, SAMPLE / n)
    sample = entries.where(F.pmod("vkey", F.lit(1_000_003)) < F.lit(math.ceil(1_000_003 * share))).select("vkey", "vec").orderBy("vkey").limit(2 * SAMPLE).collect()
    points = _even(np.array([r["vec"] for r in sample], float)) if sample else np.empty((0, 1))
    cuts = Cuts(_unit(points) if len(points) else np.empty((0, 1)), max(1, math.ceil(n / SHARD)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                home = cuts.home(_unit(_matrix(batch.column("vec"))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], names=[*batch.schema.names, "shard"])

    placed = stored(entries.select("ids", "vec", "vkey").mapInArrow(place, "ids array<long>, vec array<double>, vkey long, shard long"), "shards")
    asked = queries.select("query_id", "qkey", "vec").mapInArrow(place, "query_id long, qkey long, vec array<double>, shard long")
    asked = stored(asked, "queries")
    # as many shards as the upper tree has leaves, which its sample bounds
    sizes = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    cells = np.array([-(-sizes.get(s, 0) // CELL) for s in range(len(cuts.leaves))], np.int64)
    before = np.concatenate(([0], np.cumsum(cells)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                shard, key = batch.column("shard").to_numpy(), batch.column("vkey").to_numpy()
                cell = before[shard] + (key // 1_000_003) % cells[shard]
                yield pa.RecordBatch.from_arrays([batch.column("ids"), batch.column("vec"), pa.array(cell)], names=["ids", "vec", "cell"])

    def spread(reached: Callable[[pa.RecordBatch], list[np.ndarray]]):
        """A query once for each cell of the shards that it goes to."""

        def into(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, rows in enumerate(reached(batch) if batch.num_rows else []):
                    some = batch.take(pa.array(rows)) if len(rows) else None
                    for cell in range(before[shard], before[shard + 1]) if some else ():
                        columns = [*(some.column(c) for c in ("query_id", "qkey", "vec", "best")), pa.array(np.full(len(rows), cell))]
                        yield pa.RecordBatch.from_arrays(columns, names=["query_id", "qkey", "vec", "best", "cell"])

        return into

    def at_home(batch: pa.RecordBatch) -> list[np.ndarray]:
        home = batch.column("shard").to_numpy()
        order = np.argsort(home, kind="stable")
        return np.split(order, np.searchsorted(home[order], np.arange(1, len(cells))))

    def elsewhere(batch: pa.RecordBatch) -> list[np.ndarray]:
        home = batch.column("shard").to_numpy()
        reached = cuts.reach(_unit(_matrix(batch.column("vec"))), batch.column("best").to_numpy(), factor)
        return [rows[home[rows] != shard] for shard, rows in enumerate(reached)]

    def search(of: DataFrame, where: Callable) -> DataFrame:
        points = placed.mapInArrow(deal, "ids array<long>, vec array<double>, cell long")
        questions = of.select("query_id", "qkey", "vec", "shard", "best").mapInArrow(spread(where), "query_id long, qkey long, vec array<double>, best double, cell long")
        sides = points.withColumn("ask", F.lit(False)).unionByName(questions.withColumn("ask", F.lit(True)), allowMissingColumns=True)
        return sides.repartition(int(before[-1]), "cell").sortWithinPartitions("cell", "ask").mapInArrow(_answer(k, factor), _FOUND)

    own = stored(search(asked.withColumn("best", F.lit(3.0)), at_home), "found")
    if len(cells) == 1:
        return own
    # the last place in the own shard bounds the search of the others; too few finds bound nothing
    bound = own.groupBy("query_id", "qkey").agg(F.sort_array(F.collect_list("score"), asc=False).alias("found"))
    last = F.get("found", F.lit(k - 1))
    bound = bound.select(F.col("query_id").alias("q"), F.col("qkey").alias("x"), F.when(last.isNotNull(), F.sqrt(F.greatest(2 - 2 * last, F.lit(0.0)) + SLACK) + 1e-9).alias("bound"))
    bounded = asked.join(bound, (F.col("query_id") == F.col("q")) & (F.col("qkey") == F.col("x")), "left")
    bounded = bounded.withColumn("best", F.coalesce("bound", F.lit(3.0)))
    return own.unionByName(search(bounded, elsewhere))

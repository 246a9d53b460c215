"""Near copies by SimHash, searched by a generalised pigeonhole principle.

Two fingerprints that differ in at most ``t`` bits, cut into m groups of bits with
thresholds t1 + ... + tm = t - m + 1, differ in at most ti bits in some group i. A
threshold of -1 leaves a group out. Bits that go together are put into one group,
and the thresholds (and m) come from dynamic programming on the estimated numbers of
probes and candidates; the estimates rest on the bits of all fingerprints.

Each distinct fingerprint is searched once. In a bucket (group, value) the links are
found in memory and only a spanning forest of them leaves it, so a large group of
near copies gives as many rows as it has members, not pairs. Buckets beyond ``HOT``
are first dealt by a second level of keys: four parts of the bits outside the group,
of which a pair within three bits must share one whole.

Text: A-Z lower-cased, words are runs without ASCII white space, shingles of
``shingle`` words with repeats; fewer words are one shingle; none (or null) give
fingerprint zero. Repeated rows get equal results; null ids take part and never name
a component unless all its ids are null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.llm.common import slices, stored
from fiscalmill.llm.components import components

BITS = 64
HOT = 20_000
SHARD_ROWS = 1 << 18
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _counters() -> np.ndarray:
    """For each byte, its eight bits as eight counters within 64 bits, most significant bit first in memory."""
    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).copy().view(np.uint64).ravel()


def majority(hashes: np.ndarray, table: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    raw = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(raw), 1 << 14):
        some = raw[at : at + (1 << 14)]
        cuts = np.arange(0, len(some), 255)  # a counter of one byte holds as many
        for k in range(8):
            packed = np.add.reduceat(table[some[:, k]], cuts)
            counts[8 * k : 8 * k + 8] += packed.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(raw)).tobytes(), "big")


def fingerprint(text: str | None, shingle: int, table: np.ndarray) -> int:
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return majority(np.array([digest(joined[a:b], 42) for a, b in pairs], np.uint64), table)


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """Each row's id, text key and fingerprint (as a signed 64-bit number)."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _counters()
        for batch in slices(batches, "text"):
            marks = np.array([fingerprint(t, shingle, table) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(marks.view(np.int64))], names=["id", "key", "fp"])

    return docs.select("id", "text", "key").mapInArrow(mark, "id long, key long, fp long")


# -- how to probe ---------------------------------------------------------------------------


def bit_sums(classes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each pair of bits in how many both are set. 4096 sums leave a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((BITS, BITS))
        for batch in batches:
            marks = batch.column("fp").to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(marks, axis=1, bitorder="little").astype(np.float32)
            n += len(bits)
            total += bits.T @ bits
        at = np.append(np.arange(BITS * BITS), -1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total.ravel(), n).astype(np.int64))], names=["at", "n"])

    sums = dict(classes.select("fp").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect())
    return sums.get(-1, 0), np.array([sums.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)


def _correlation(n: int, both: np.ndarray) -> np.ndarray:
    p = np.diag(both) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    return np.abs(both / n - np.outer(p, p)) / np.outer(spread, spread)


def bit_groups(correlation: np.ndarray, m: int) -> list[list[int]]:
    """m groups of nearly equal size; each takes next the bit most correlated with its own."""
    left, groups = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        start = min(left, key=lambda i: (-sum(correlation[i][j] for j in left if j != i), i))
        group = [start]
        left.remove(start)
        while len(group) < size:
            best = min(left, key=lambda i: (-sum(correlation[i][j] for j in group), i))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def _differ_at_most(group: list[int], p: np.ndarray, correlation: np.ndarray, t: int) -> float:
    """Share of random pairs that differ in at most t bits of the group; correlated bits count as fewer independent ones."""
    own = correlation[np.ix_(group, group)]
    count = max(1, round(len(group) ** 2 / max(own.sum(), 1)))
    differ = float(np.mean([2 * p[i] * (1 - p[i]) for i in group]))
    return sum(comb(count, k) * differ**k * (1 - differ) ** (count - k) for k in range(min(t, count) + 1))


def plan(n: int, both: np.ndarray, t: int) -> list[tuple[list[int], int]]:
    """Groups of bits and their thresholds with the least estimated probes and candidates."""
    if not n:
        return [(list(range(BITS)), t)]
    p, correlation = np.diag(both) / n, _correlation(n, both)
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    for m in range(1, t + 3):
        groups = bit_groups(correlation, m)
        # reach[s]: least cost of thresholds of the groups so far that add up to s
        reach: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            step: dict[int, tuple[float, list[int]]] = {}
            for total, (cost, chosen) in reach.items():
                for own in range(-1, t + 1):
                    probes = n * (sum(comb(len(group), k) for k in range(own + 1)) + (own > 0)) if own >= 0 else 0
                    candidates = n * n / 2 * _differ_at_most(group, p, correlation, own) if own >= 0 else 0
                    # a probe is a shuffled row, a candidate one comparison of two numbers in memory
                    now = (cost + 200 * probes + candidates, chosen + [own])
                    if total + own not in step or now < step[total + own]:
                        step[total + own] = now
            reach = step
        if t - m + 1 in reach and reach[t - m + 1][0] < best[0]:
            best = (reach[t - m + 1][0], [(g, own) for g, own in zip(groups, reach[t - m + 1][1]) if own >= 0])
    return best[1]


# -- probe and verify -----------------------------------------------------------------------


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _parts(bits: list[int], n: int) -> list[int]:
    """Masks of n nearly equal parts of the bits."""
    return [_mask(bits[k::n]) for k in range(n)]


def _probe(groups: list[tuple[list[int], int]]):
    """Rows (slot, value, fp, own): own is true where the value is the fingerprint's own and not one within reach."""
    plans = [(_mask(bits), [np.uint64(_mask(list(flip))) for k in range(1, t + 1) for flip in combinations(bits, k)]) for bits, t in groups]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for slot, (mask, flips) in enumerate(plans):
                for flip in [np.uint64(0), *flips]:
                    value = (fps & np.uint64(mask)) ^ flip
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(fps), slot, np.int32)), pa.array(value.view(np.int64)), pa.array(fps.view(np.int64)), pa.array(np.full(len(fps), not flip))],
                        names=["slot", "value", "fp", "own"],
                    )

    return probe


def forest(fps: np.ndarray, own: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links between fingerprints of one bucket, of which one at least is its own."""
    root = np.arange(len(fps))
    heads, tails = [], []
    step = max(1, (1 << 22) // max(1, len(fps)))
    for at in range(0, len(fps), step):
        near = np.bitwise_count(fps[at : at + step, None] ^ fps[None, :]) <= t
        near &= own[at : at + step, None] | own[None, :]
        rows, columns = np.nonzero(near)
        upper = rows + at < columns
        rows, columns = rows[upper] + at, columns[upper]
        while len(rows):
            # one link for each root, then all roots it joins are one: a few rounds for any number of links
            a, b = root[rows], root[columns]
            different = a != b
            rows, columns, a, b = rows[different], columns[different], a[different], b[different]
            if not len(rows):
                break
            high, low = np.maximum(a, b), np.minimum(a, b)
            order = np.lexsort((low, high))
            first = order[np.concatenate(([True], np.diff(high[order]) != 0))]
            heads.append(fps[rows[first]])
            tails.append(fps[columns[first]])
            root[high[first]] = low[first]
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
    none = np.empty(0, np.uint64)
    return (np.concatenate(heads), np.concatenate(tails)) if heads else (none, none)


def _small_buckets(fps: np.ndarray, own: np.ndarray, starts: np.ndarray, counts: np.ndarray, t: int):
    """All pairs of many small buckets at once: each row with the 1st, 2nd, ... after it in its bucket."""
    heads, tails = [], []
    end = np.repeat(starts + counts, counts)
    at = np.concatenate([np.arange(s, s + c) for s, c in zip(starts, counts)]) if len(starts) else np.empty(0, np.int64)
    for ahead in range(1, int(counts.max(initial=0))):
        keep = at + ahead < end
        at, end = at[keep], end[keep]
        near = (np.bitwise_count(fps[at] ^ fps[at + ahead]) <= t) & (own[at] | own[at + ahead])
        heads.append(fps[at[near]])
        tails.append(fps[at[near] + ahead])
    return heads, tails


def _verify(t: int):
    def verify(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        slot, sub, fps, own = (table.column(c).to_numpy() for c in ("slot", "sub", "fp", "own"))
        value = table.column("value").to_numpy()
        order = np.lexsort((fps, sub, value, slot))
        slot, sub, value, fps, own = slot[order], sub[order], value[order], fps[order].view(np.uint64), own[order]
        new = np.concatenate(([True], (np.diff(slot) != 0) | (np.diff(value) != 0) | (np.diff(sub) != 0)))
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(fps)))
        few = (counts > 1) & (counts <= 16)
        heads, tails = _small_buckets(fps, own, starts[few], counts[few], t)
        for s, c in zip(starts[counts > 16], counts[counts > 16]):
            a, b = forest(fps[s : s + c], own[s : s + c], t)
            heads.append(a)
            tails.append(b)
        u = np.concatenate([*heads, np.empty(0, np.uint64)]).view(np.int64)
        v = np.concatenate([*tails, np.empty(0, np.uint64)]).view(np.int64)
        return pa.table({"u": pa.array(u), "v": pa.array(v)})

    return verify


def links(classes: DataFrame, t: int) -> DataFrame:
    """Edges (u, v) between distinct fingerprints within t bits: enough of them to join all that are linked."""
    n, both = bit_sums(classes)
    groups = plan(n, both, t)
    probes = classes.select("fp").mapInArrow(_probe(groups), "slot int, value long, fp long, own boolean")
    # buckets too large for one task: a pair within t bits agrees on one of t + 1 parts of the bits outside the group
    hot = probes.groupBy("slot", "value").count().where(F.col("count") > HOT).select(F.col("slot").alias("s"), F.col("value").alias("x"), F.lit(True).alias("hot"))
    marked = probes.join(hot, (F.col("slot") == F.col("s")) & (F.col("value") == F.col("x")), "left")
    outside = [_parts([b for b in range(BITS) if b not in bits] or bits, t + 1) for bits, _ in groups]
    part = lambda k: F.element_at(F.array(*[F.lit(np.uint64(o[k]).astype(np.int64).item()) for o in outside]), F.col("slot") + 1)
    subs = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(part(k))) for k in range(t + 1)])
    keyed = marked.select("slot", "value", "fp", "own", F.explode(F.when(F.col("hot"), subs).otherwise(F.array(F.lit(0).cast("long")))).alias("sub"))
    probed = n * sum(comb(len(bits), k) for bits, own in groups for k in range(own + 1))
    shards = max(1, -(-probed // SHARD_ROWS))
    keyed = keyed.withColumn("shard", F.pmod(F.xxhash64("slot", "value", "sub"), F.lit(shards)))
    return keyed.groupBy("shard").applyInArrow(_verify(t), "u long, v long")


def row_keys(id_column: str, text_column: str) -> tuple[Column, Column]:
    """What tells rows apart: the id, nulls last, and a hash of the text."""
    return F.coalesce(F.col(id_column).cast("long"), F.lit((1 << 63) - 1)), F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))


def near_copies(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, key, fp, component, root): for each row the smallest id that its fingerprint reaches over links of at most ``max_bits`` bits."""
    _, key = row_keys(id_column, text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"), key.alias("key"))
    marked = stored(fingerprints(rows, shingle), "fingerprints")
    classes = marked.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(classes, max_bits))
    placed = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component"))
    component = placed.join(named.select(F.col("root").alias("r"), "component"), F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component", "root")
    return marked.join(component, F.col("fp") == F.col("f")).select("id", "key", "fp", "component", "root")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near copies: the smallest id, of its rows the first by text key; equal rows count as one."""
    found = near_copies(docs, **options)
    first = found.groupBy("root").agg(F.min(F.struct(F.coalesce("id", F.lit((1 << 63) - 1)).alias("id"), "key")).alias("s")).select("s.*")
    ids, key = row_keys(options.get("id_column", "doc_id"), options.get("text_column", "text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), ids.alias("row_id"), key.alias("row_text"))
    kept = rows.join(first, (F.col("row_id") == F.col("id")) & (F.col("row_text") == F.col("key")), "left_semi")
    nth = F.row_number().over(Window.partitionBy("row_id", "row_text").orderBy("row_id"))
    return kept.withColumn("nth", nth).where("nth = 1").select("row.*").select(*[F.col(f"`{c}`") for c in docs.columns])


def components_of(docs: DataFrame) -> DataFrame:
    found = near_copies(docs)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )

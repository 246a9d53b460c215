"""Passages that documents share, found by factoring each document against all earlier ones.

Relative Lempel-Ziv parsing: a document is cut greedily into factors, each a run
of words that stands in one place of a document with a smaller id. Only factors
of at least ``window`` words count.

1. Documents are dealt into blocks of bounded text. Each block sends its anchors
   (the smallest 5-word hash of every window) to the shards of an index; anchors
   that stand in several documents come back.
2. Windows over such anchors are hashed. A block keeps one document per window,
   the one with the smallest id, before it sends them to the shards, so a passage
   in a third of all documents moves one entry per block. A shard returns the
   place of each window's first document to the blocks that hold later ones.
3. Each block parses its documents into factors, one for each run of windows whose first
   document and place go on: a factor names the first document of its windows and ends
   where that changes, also where another earlier document would go on. Windows at
   both ends of a factor are found like all others, so the words that the factors cover
   are exactly those that earlier documents hold. Window hashes have 64 bits and a
   separate 16-bit check.

Null text counts as empty. A null id counts as larger than all ids. Rows with the
same id never shorten each other; repeated rows get the same result each. Texts of
fewer words than the window stay whole. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import row_key, text_arrays
from fiscalmill.llm.words import window_hashes, word_hashes, word_spans

WINDOW = 13
ANCHOR_WORDS = 5
BLOCK_BYTES = 4 << 20
SHARD_WORDS = 1 << 20
_LAST = (1 << 63) - 1
_BLOB = "shard long, block long, blob binary"


def _planes(values: np.ndarray) -> bytes:
    """Equal bytes of neighbours side by side, so that Spark's own compression of shuffles finds them."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _from_planes(blob: bytes, kind, n: int, at: int) -> tuple[np.ndarray, int]:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(blob, np.uint8, n * size, at).reshape(size, n)
    return np.ascontiguousarray(raw.T).view(kind).ravel(), at + n * size


def _pack(*arrays: np.ndarray) -> bytes:
    return struct.pack("<q", len(arrays[0])) + b"".join(_planes(np.ascontiguousarray(a)) for a in arrays)


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    n, at, out = struct.unpack_from("<q", blob)[0], 8, []
    for kind in kinds:
        values, at = _from_planes(blob, kind, n, at)
        out.append(values)
    return out


_ANCHOR = (np.uint64, np.uint8)
_ENTRY = (np.uint64, np.uint16, np.int64, np.uint32, np.uint32)
_FLAG = (np.uint32, np.uint32, np.int64, np.uint32)


class _Block:
    """The documents of a block in an order that depends on their rows alone."""

    def __init__(self, table: pa.Table, window: int):
        table = table.sort_by([("did", "ascending"), ("rid", "ascending")]).combine_chunks()
        self.table, self.window = table, window
        self.ids = table.column("did").to_numpy()
        column = table.column("text").combine_chunks()
        self.data, self.offsets = text_arrays(column)
        self.starts, ends, self.first = word_spans(self.data, self.offsets)
        self.words = word_hashes(self.data, self.starts, ends)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchor of every window that fits into a text, and the window's first word."""
        grams, width = self.words, min(ANCHOR_WORDS, self.window)
        n = len(grams) - self.window + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        with np.errstate(over="ignore"):
            total = np.zeros(len(grams) - width + 1, np.uint64)
            for k in range(width):
                total = total * np.uint64(0x9FB21C651E98DF25) + grams[k : k + len(total)]
        total ^= total >> np.uint64(29)
        least = total[:n].copy()
        for k in range(1, self.window - width + 1):
            np.minimum(least, total[k : k + n], out=least)
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))[:n]
        fits = np.flatnonzero(np.arange(n) + self.window <= self.first[text + 1])
        return least[fits], fits


def _by_shard(hashes: np.ndarray, bits: int) -> list[tuple[int, slice]]:
    """Slices of sorted hashes for each shard."""
    if not len(hashes):
        return []
    shard = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]))
    return [(int(shard[a]), slice(int(a), int(b))) for a, b in zip(cuts[:-1], cuts[1:])]


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    shard, block, blob = zip(*rows) if rows else ((), (), ())
    return pa.table({"shard": pa.array(shard, pa.int64()), "block": pa.array(block, pa.int64()), "blob": pa.array(blob, pa.binary())})


def _send_anchors(window: int, bits: int):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        block = _Block(table, window)
        hashes, at = block.anchors()
        owner = block.ids[np.searchsorted(block.first, at, "right") - 1]
        order = np.lexsort((owner, hashes))
        hashes, owner = hashes[order], owner[order]
        starts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.empty(0, np.int64)
        last = np.concatenate((starts[1:], [len(hashes)])) - 1 if len(starts) else starts
        several, hashes = (owner[starts] != owner[last]).astype(np.uint8), hashes[starts]
        return _blobs([(s, key[0].as_py(), _pack(hashes[cut], several[cut])) for s, cut in _by_shard(hashes, bits)])

    return send


def _shared_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """To each block, its anchors that stand in more than one document."""
    parts = [_unpack(b, *_ANCHOR) for b in table.column("blob").to_pylist()]
    blocks = table.column("block").to_pylist()
    hashes = np.concatenate([p[0] for p in parts])
    several = np.concatenate([p[1] for p in parts])
    origin = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.argsort(hashes, kind="stable")
    hashes, several, origin = hashes[order], several[order], origin[order]
    starts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    counts = np.diff(np.concatenate((starts, [len(hashes)])))
    keep = np.repeat((counts > 1) | (np.maximum.reduceat(several, starts) > 0), counts)
    hashes, origin = hashes[keep], origin[keep]
    order = np.argsort(origin, kind="stable")
    hashes, cuts = hashes[order], np.searchsorted(origin[order], np.arange(len(parts) + 1))
    return _blobs([(key[0].as_py(), blocks[i], _pack(hashes[a:b])) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a])


def _send_windows(window: int, bits: int):
    def send(key: tuple[pa.Scalar, ...], docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows or not shared.num_rows:
            return _blobs([])
        name = docs.column("block")[0].as_py()
        block = _Block(docs, window)
        wanted = np.unique(np.concatenate([_unpack(b, np.uint64)[0] for b in shared.column("blob").to_pylist()]))
        anchors, at = block.anchors()
        near = np.searchsorted(wanted, anchors)
        at = at[wanted[np.minimum(near, len(wanted) - 1)] == anchors]
        # window_hashes() lists the same windows in the same order as anchors() does, from word numbers
        hashes, text, place = window_hashes(block.words, block.first, window)
        number = block.first[text] + place
        pick = np.searchsorted(number, at)
        hashes, text, place = hashes[pick], text[pick], place[pick]
        check = window_hashes(block.words, block.first, window, seed=77)[0][pick].astype(np.uint16)
        owner = block.ids[text]
        order = np.lexsort((place, owner, check, hashes))
        hashes, check, text, place, owner = hashes[order], check[order], text[order].astype(np.uint32), place[order].astype(np.uint32), owner[order]
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (check[1:] != check[:-1]))) if len(hashes) else np.empty(0, bool)
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        later = owner > owner[head][group] if len(head) else np.empty(0, bool)
        source, source_at = (owner[head][group], place[head][group]) if len(head) else (owner, place)
        # the rest is decided once the index has named the first document; until then an earlier one of this block stands for it
        rows = [(-1 - name, name, _pack(text[later], place[later], source[later], source_at[later]))] if later.any() else []
        hashes, check, owner, text, place = (a[~later] for a in (hashes, check, owner, text, place))
        return _blobs(rows + [(s, name, _pack(hashes[c], check[c], owner[c], text[c], place[c])) for s, c in _by_shard(hashes, bits)])

    return send


def _later_windows(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """To each block, its windows that also start in a document with a smaller id, and where."""
    if key[0].as_py() < 0:
        return table.select(["shard", "block", "blob"])
    parts = [_unpack(b, *_ENTRY) for b in table.column("blob").to_pylist()]
    blocks = table.column("block").to_pylist()
    hashes, check, owner, text, place = (np.concatenate([p[i] for p in parts]) for i in range(5))
    origin = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.lexsort((place, owner, check, hashes))
    new = np.concatenate(([True], (np.diff(hashes[order]) != 0) | (check[order][1:] != check[order][:-1])))
    head, group = np.flatnonzero(new), np.cumsum(new) - 1
    source, source_at = owner[order][head][group], place[order][head][group]
    later = owner[order] > source
    picked = order[later]
    source, source_at = source[later], source_at[later]
    sort = np.argsort(origin[picked], kind="stable")
    picked, source, source_at = picked[sort], source[sort], source_at[sort]
    cuts = np.searchsorted(origin[picked], np.arange(len(parts) + 1))
    return _blobs(
        [
            (key[0].as_py(), blocks[i], _pack(text[picked[a:b]], place[picked[a:b]], source[a:b], source_at[a:b]))
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
            if b > a
        ]
    )


def _factors(place: np.ndarray, source: np.ndarray, source_at: np.ndarray, window: int) -> list[dict]:
    """Greedy factors of one document from its later windows in order: as long as the source goes on, so does the factor."""
    order = np.argsort(place, kind="stable")
    place, source, source_at = place[order].astype(np.int64), source[order], source_at[order].astype(np.int64)
    goes_on = (np.diff(place) == 1) & (np.diff(source) == 0) & (np.diff(source_at) == 1)
    starts = np.concatenate(([0], np.flatnonzero(~goes_on) + 1))
    ends = np.concatenate((starts[1:], [len(place)])) - 1
    return [
        {"start": int(place[a]), "length": int(place[b] - place[a]) + window, "source_id": int(source[a]), "source_start": int(source_at[a])}
        for a, b in zip(starts, ends)
    ]


def _cut(window: int, schema: pa.Schema):
    def cut(key: tuple[pa.Scalar, ...], docs: pa.Table, flags: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        docs = docs.sort_by([("did", "ascending"), ("rid", "ascending")]).combine_chunks()
        parts = [_unpack(b, *_FLAG) for b in flags.column("blob").to_pylist()]
        rows, place, source, source_at = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, _FLAG[i]) for i in range(4))
        order = np.argsort(rows, kind="stable")
        rows, place, source, source_at = rows[order], place[order], source[order], source_at[order]
        cuts = np.searchsorted(rows, np.arange(docs.num_rows + 1))
        n_words, n_removed, kept, factors = [], [], [], []
        for i, text in enumerate(docs.column("text").to_pylist()):
            words = (text or "").encode().split()
            a, b = cuts[i], cuts[i + 1]
            found = _factors(place[a:b], source[a:b], source_at[a:b], window) if b > a else []
            n_words.append(len(words))
            if found:
                gone = np.zeros(len(words) + 1, np.int64)
                np.add.at(gone, [f["start"] for f in found], 1)
                np.add.at(gone, [f["start"] + f["length"] for f in found], -1)
                stay = np.cumsum(gone[:-1]) == 0
                words = [w for w, s in zip(words, stay.tolist()) if s]
            kept.append(b" ".join(words).decode())
            n_removed.append(n_words[-1] - len(words))
            factors.append(found)
        columns = {"rest": docs.column("rest"), "text": docs.column("text"), "n_words": n_words, "n_removed": n_removed, "kept": kept, "factors": factors}
        return pa.table([columns[f.name] if f.name in ("rest", "text") else pa.array(columns[f.name], f.type) for f in schema], schema=schema)

    return cut


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """Each row with the words of long repeated factors removed.

    Returns ``rest`` (struct of the other columns), ``text``, ``n_words``,
    ``n_removed``, ``kept`` (words left, joined by one space) and ``factors``
    (start, length, source_id, source_start; in words).
    """
    # read from here on by column position, so no name of the input can clash
    frame = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)).alias("did"), row_key(id_column, text_column).alias("rid"),
        F.col(text_column).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("rest"),
    )
    size = docs.select(F.coalesce(F.sum(F.octet_length(text_column)), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    blocks = max(1, math.ceil((size["b"] + 50 * size["n"]) / BLOCK_BYTES))
    bits = max(0, math.ceil(math.log2(max(1, size["b"] / 6 / SHARD_WORDS))))
    frame = frame.select(F.pmod("rid", F.lit(blocks)).alias("block"), "*")

    in_blocks = lambda df: df.groupBy("block")
    anchors = in_blocks(frame).applyInArrow(_send_anchors(window, max(0, bits - 2)), _BLOB)
    shared = anchors.groupBy("shard").applyInArrow(_shared_anchors, _BLOB)
    windows = in_blocks(frame).cogroup(in_blocks(shared)).applyInArrow(_send_windows(window, bits), _BLOB)
    later = windows.groupBy("shard").applyInArrow(_later_windows, _BLOB)
    factor = "array<struct<start:long,length:long,source_id:long,source_start:long>>"
    out = frame.select("rest", "text", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.col("text").alias("kept"), F.lit(None).cast(factor).alias("factors")).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    return in_blocks(frame).cogroup(in_blocks(later)).applyInArrow(_cut(window, to_arrow_schema(out)), out)


def repeats_of(docs: DataFrame) -> DataFrame:
    """Per document: how many words it has, how many were removed, and a digest of the rest."""
    return remove_repeats(docs.select("doc_id", "text")).select(
        F.col("rest.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )

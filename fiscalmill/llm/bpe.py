"""Byte-level BPE: texts to token ids and back.

A text is cut into pieces by the vocabulary's pattern; a piece that is a token is that
token. Any other one starts as its single bytes, and the leftmost pair of neighbours
whose joined bytes have the smallest rank becomes one token, again and again, until no
pair is a token.

Pieces are cut with array operations over whole slices of text; each distinct piece of a
slice is merged once. Pieces of like length lie in padded matrices of ids: in each round
every row finds its leftmost smallest rank, merges there, and moves what follows to the
left; the two new pairs are looked up in a hash table of all pairs. Rows that are done
leave the matrix. A piece beyond ``LONG`` bytes is a row of its own that keeps the least
rank of each block of columns, so that a round costs little more than a block.

A slice holds about ``slice_bytes`` of text, and a longer text is cut where white space
begins with a plain space, which is always the start of a piece: memory does not grow
with the text, but for its ids.

Null text counts as empty and gives no ids. Null and repeated doc_ids are kept: a row in
is a row out. Other columns, whatever their names, are not read. An empty table gives an
empty one. Equal ranks do not occur: of equal pairs in a piece the leftmost is merged
first. Ids that the vocabulary does not hold cannot be decoded and raise an error.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import slices, text_arrays
from fiscalmill.llm.hashing import HashTable
from fiscalmill.llm.words import word_hashes

SLICE = 2 << 20
#: Cells of a matrix, and bytes of a piece that is merged by itself.
CELLS = 1 << 19
LONG = 1024
#: No pair: larger than every rank.
_NONE = np.int32(2**31 - 1)
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
#: The pattern whose pieces ``piece_starts`` finds.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _kinds() -> np.ndarray:
    """For each code point whether it is white space, letter, number or other."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_SPACE, r"\s"), (_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}")):
        kinds[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return kinds


@dataclass
class Vocabulary:
    """What the tasks need of a rank file; its size does not depend on the documents."""

    pool: bytes
    first: np.ndarray
    known: np.ndarray
    pairs: np.ndarray
    joined: np.ndarray
    kinds: np.ndarray

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read on the driver: lines of a token in base64 and its rank."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"no token for the bytes {missing}")
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        splits = [(token[:i], token[i:], rank) for token, rank in ranks.items() for i in range(1, len(token))]
        found = [(ranks[a] << 32 | ranks[b], rank) for a, b, rank in splits if a in ranks and b in ranks]
        pairs, joined = (np.array(c, np.uint64) for c in zip(*found)) if found else (np.empty(0, np.uint64), np.empty(0, np.uint64))
        first = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int64)
        return cls(b"".join(tokens), first, np.array([bool(t) for t in tokens]), pairs, joined.astype(np.int64), _kinds())


def piece_starts(points: np.ndarray, heads: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """For each code point whether a piece begins there. ``heads``: where texts begin, all of them not empty."""
    kind = kinds[points]
    begins = np.ones(len(points), bool)
    begins[1:] = kind[1:] != kind[:-1]
    begins[heads] = True
    head = np.zeros(len(points) + 1, bool)
    head[heads] = head[-1] = True
    # the last white space before anything else: a plain space joins what follows, another one stands alone
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~head[1:-1])
    begins[last] = True
    begins[last[points[last] == 32] + 1] = False
    # 's and its like, where a piece begins with the sign
    sign = np.flatnonzero((points[:-1] == ord("'")) & begins[:-1] & ~head[1:-1])
    after = points[sign + 1]
    short = sign[np.isin(after, [ord(c) for c in "stmd"])]
    begins[short + 1] = False
    begins[(short + 2)[short + 2 < len(points)]] = True
    pair = sign[sign + 2 < len(points)]
    pair = pair[~head[pair + 2]]
    a, b = points[pair + 1], points[pair + 2]
    long = pair[((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))]
    begins[long + 1] = False
    begins[(long + 3)[long + 3 < len(points)]] = True
    return begins


def _spread(pool: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs pool[first[i]:first[i + 1]] for each i of ``which``, one after another, and their lengths."""
    lengths = first[which + 1] - first[which]
    stops = np.cumsum(lengths)
    shift = np.repeat(first[which] - stops + lengths, lengths)
    return pool[shift + np.arange(len(shift))], lengths


class Encoder:
    """A task's encoder."""

    def __init__(self, vocabulary: Vocabulary, long: int = LONG):
        self.kinds, self.long = vocabulary.kinds, long
        pool, first = vocabulary.pool, vocabulary.first.tolist()
        self.tokens = {pool[a:b]: i for i, (a, b) in enumerate(zip(first, first[1:])) if a < b}
        self.bytes = np.array([self.tokens[bytes([b])] for b in range(256)], np.int32)
        self.pairs = HashTable(len(vocabulary.pairs))
        self.pairs.put(vocabulary.pairs, vocabulary.joined)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of neighbours; none where one of the two is padding."""
        found = self.pairs.get(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        return np.where((found < 0) | (right < 0), _NONE, found).astype(np.int32)

    def merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """Merge each row of a matrix of byte ids, padded at the right with -1, as far as it goes."""
        ids, out, rows = ids.copy(), np.full_like(ids, -1), np.arange(len(ids))
        ranks = self._ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            least = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), _NONE)
            done = least == _NONE
            if done.any():
                out[rows[done], : ids.shape[1]] = ids[done]
                rows, ids, ranks, at, least = rows[~done], ids[~done], ranks[~done], at[~done], least[~done]
                if not len(rows):
                    break
            n, width = np.arange(len(rows)), ids.shape[1]
            # each row loses one id, so the matrix loses its last column
            columns = np.arange(width - 1)
            ids[n, at] = least
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
            ranks = np.take_along_axis(ranks, columns[:-1] + (columns[:-1] >= at[:, None]), axis=1) if width > 2 else ranks[:, :0]
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self._ranks(ids[before, at[before] - 1], ids[before, at[before]])
            after = np.flatnonzero(at < width - 2)
            ranks[after, at[after]] = self._ranks(ids[after, at[after]], ids[after, at[after] + 1])
        return out

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """The same for one long row: blocks of columns keep their least rank, ids that are merged away stay as gaps."""
        n, block = len(ids), 512
        blocks = -(-n // block)
        ranks = np.full(blocks * block, _NONE)
        ranks[: n - 1] = self._ranks(ids[:-1], ids[1:])
        grid = ranks.reshape(blocks, block)
        least = grid.min(axis=1)
        ids, left, right = ids.tolist(), list(range(-1, n - 1)), list(range(1, n + 1))
        known: dict[tuple[int, int], int] = {}
        while True:
            b = int(least.argmin())
            if least[b] == _NONE:
                break
            i = b * block + int(grid[b].argmin())
            j = right[i]
            ids[i], ids[j] = int(ranks[i]), -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
            ranks[j] = _NONE
            for x, y in ((left[i], i), (i, k)):
                if x >= 0:
                    pair = (ids[x], ids[y]) if y < n else None
                    if pair not in known:
                        known[pair] = int(self._ranks(np.array(pair[:1]), np.array(pair[1:]))[0]) if pair else int(_NONE)
                    ranks[x] = known[pair]
            for c in {b, j // block, max(left[i], 0) // block}:
                least[c] = grid[c].min()
        ids = np.array(ids, np.int32)
        return ids[ids >= 0]

    def _merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that are no tokens, one piece after another, and how many each has."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(sizes, kind="stable")
        sizes, counts, parts = sizes[order], np.zeros(len(pieces), np.int64), []
        start, ordered = 0, [pieces[i] for i in order.tolist()]
        while start < len(order):
            if sizes[start] > self.long:
                stop = start + 1
                ids = self.merge_long(self.bytes[np.frombuffer(ordered[start], np.uint8)])
                counts[start] = len(ids)
            else:
                # a bucket: lengths up to a quarter more than its shortest, as many rows as the cells allow
                widest = min(sizes[start] + sizes[start] // 4, self.long)
                stop = min(int(np.searchsorted(sizes, widest, "right")), start + max(1, CELLS // int(widest)))
                matrix = np.full((stop - start, sizes[stop - 1]), -1, np.int32)
                filled = np.arange(matrix.shape[1]) < sizes[start:stop, None]
                matrix[filled] = self.bytes[np.frombuffer(b"".join(ordered[start:stop]), np.uint8)]
                merged = self.merge_rows(matrix)
                kept = merged >= 0
                ids, counts[start:stop] = merged[kept], kept.sum(axis=1)
            parts.append(ids)
            start = stop
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return _spread(np.concatenate(parts), np.concatenate(([0], np.cumsum(counts))), back)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts one after another, and how many each text has."""
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        raw = data.tobytes()
        places = np.flatnonzero((data & 0xC0) != 0x80)
        points = data if len(places) == len(data) else np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        heads = np.searchsorted(places, np.unique(offsets[:-1][offsets[:-1] < offsets[1:]]))
        starts = places[piece_starts(points, heads, self.kinds)]
        del places, points
        ends = np.append(starts[1:], len(data))
        _, at, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at, which = self._apart(data, starts, ends, at, which)
        pieces = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        tokens = [self.tokens.get(p, -1) for p in pieces]
        whole = np.array(tokens, np.int64)
        others = np.flatnonzero(whole < 0)
        counts = np.ones(len(pieces), np.int64)
        if len(others):
            merged, counts[others] = self._merged([pieces[i] for i in others.tolist()])
        first = np.concatenate(([0], np.cumsum(counts)))
        pool = np.empty(first[-1], np.int32)
        pool[first[:-1][whole >= 0]] = whole[whole >= 0]
        if len(others):
            pool[np.repeat(whole < 0, counts)] = merged
        ids, lengths = _spread(pool, first, which)
        total = np.concatenate(([0], np.cumsum(lengths)))
        return ids, np.diff(total[np.searchsorted(starts, offsets)])

    @staticmethod
    def _apart(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of one hash whose bytes differ become pieces of their own."""
        example = at[which]
        wrong = ends - starts != ends[example] - starts[example]
        alike = np.where(wrong, np.arange(len(starts)), example)
        shift = np.repeat(starts[alike] - starts, ends - starts)
        differs = data[np.arange(len(data)) + shift] != data
        wrong |= np.add.reduceat(differs, starts) > 0
        lone = np.flatnonzero(wrong)
        which = which.copy()
        which[lone] = len(at) + np.arange(len(lone))
        return np.concatenate([at, lone]), which

    def cuts(self, data: np.ndarray, limit: int) -> list[int]:
        """Where to cut one long text: plain spaces after anything but white space, about ``limit`` bytes apart."""
        out, raw = [0], data.tobytes() if len(data) > limit else b""
        while len(data) - out[-1] > limit:
            at = raw.find(b" ", out[-1] + limit)
            while at >= 0 and self.kinds[ord(raw[max(0, at - 4) : at].decode(errors="ignore")[-1])] == _SPACE:
                at = raw.find(b" ", at + 1)
            if at < 0:
                break
            out.append(at)
        return [*out, len(data)]

    def encode_long(self, data: np.ndarray, limit: int) -> np.ndarray:
        cuts = self.cuts(data, limit)
        return np.concatenate([self.encode(data[a:b], np.array([0, b - a]))[0] for a, b in zip(cuts, cuts[1:])])


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())


def encode(docs: DataFrame, vocabulary: Vocabulary, slice_bytes: int = SLICE) -> DataFrame:
    """(doc_id, ids): the ids of each row's whole text, as little-endian unsigned 32-bit numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in slices(batches, "text", slice_bytes):
            encoder = encoder or Encoder(shared.value)
            data, offsets = text_arrays(batch.column("text"))
            if batch.num_rows == 1:
                ids = encoder.encode_long(data, slice_bytes)
                counts = np.array([len(ids)])
            else:
                ids, counts = encoder.encode(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _binary(ids.astype("<u4"), 4 * counts)], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, "doc_id long, ids binary")


def decode(encoded: DataFrame, vocabulary: Vocabulary, slice_bytes: int = SLICE) -> DataFrame:
    """The rows of ``encode`` with the bytes of their ids as ``decoded``."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, first, known = np.frombuffer(shared.value.pool, np.uint8), shared.value.first, shared.value.known
        for batch in slices(batches, "ids", slice_bytes):
            column = batch.column("ids").cast(pa.large_binary())
            sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1])
            ids = np.frombuffer(b"".join(column.to_pylist()), "<u4").astype(np.int64)
            if len(ids) and (ids.max() >= len(known) or not known[ids].all()):
                raise ValueError("ids that the vocabulary does not hold")
            per_id = first[ids + 1] - first[ids]
            total = np.concatenate(([0], np.cumsum(per_id)))
            lengths = np.diff(total[np.concatenate(([0], np.cumsum(sizes // 4)))])
            parts = [_spread(pool, first, ids[i : i + CELLS])[0] for i in range(0, len(ids), CELLS)]
            decoded = np.concatenate(parts) if parts else np.empty(0, np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), _binary(decoded, lengths)], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id long, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """Number and digests of ids and decoded bytes."""
    n = (F.octet_length("ids") / 4).cast("long")
    return decoded.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

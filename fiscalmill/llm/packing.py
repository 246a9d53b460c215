"""Packing: documents as token ids, cut into pieces and laid into sequences with little padding.

First-fit decreasing over a tournament tree: a leaf holds the room left in a bin,
each node the larger of its two children, so the first bin with room for a piece
is found from the root in as many steps as the tree is high. It runs on its own in
randomised groups of about ``GROUP`` pieces, so no group grows with the input; each
group leaves at most a few bins half empty.

Null text counts as empty; such a document is its end token alone. Null and
repeated ids are kept, every row is a document of its own. An empty table gives no
pieces. A long document is cut at every ``capacity`` tokens; its pieces may go to
different groups.
"""

from __future__ import annotations

import math
import os
import re
import string
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import slices, text_arrays
from fiscalmill.llm.hashing import HashTable
from fiscalmill.llm.words import mix, word_hashes, word_spans

CAPACITY = 4096
GROUP = 2048
CACHED_WORDS = 250_000
SLICE = 2 << 20
_OTHER = re.compile("[^\0-\u012f\u0131-\u024f]")  # beyond Latin; and the dotted capital I, which lower-cases to two letters
_PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, grp long"
_PACKED = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long, padded_to long"


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes other than visible Latin-1 ones (and the space)."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + n) for n, b in enumerate(hidden) if b != 32}


class WordTokenizer:
    """Ids of many texts; each distinct word is encoded once.

    Holds for tokenizers that drop white space, lower-case and part letters from
    all else, as the one with word ends does; words are cut at the ASCII white
    space. Latin letters, with or without signs after them, go to the vocabulary's
    merges directly, any other word through the whole tokenizer. Texts with letters
    that may be lower-cased or composed by rules of their own, or with what looks
    like a special token, are encoded whole, as are all texts for other tokenizers.

    One tokenizer is loaded, with or without its first steps in place. Known words
    lie in a hash table by 64-bit hash, which starts anew when it is full: besides
    that a call holds arrays of the words and ids of its texts alone.
    """

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.tokenizer = Tokenizer.from_file(path)
        self.steps = {True: (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer), False: (None, Split(" ", "removed"))}
        self.letters, self.cached_words = _byte_letters(), cached_words
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        del vocabulary
        self._clear()
        probe = "Word words, été!! it's a1"
        self.by_word = np.array_equal(self._by_word([probe])[0], self._whole([probe])[0])

    def _clear(self):
        """A known word is two parts, as one number; the ids of part i are pool[first[i] : first[i + 1]]. Part 0 is empty."""
        self.words = HashTable(self.cached_words)
        self.parts: dict[str, int] = {"": 0}
        self.pool, self.first = np.empty(0, np.uint32), np.zeros(2, np.int64)

    def _encode(self, texts: list[str], whole: bool) -> list[np.ndarray]:
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.steps[whole]
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return self._encode(texts, True)

    def _merged(self, letters: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of lower-case letters, and how many each has: its last one alone ends a word."""
        ids = [np.empty(0, np.uint32)]
        for i in range(0, len(letters), 1000):
            joined = " ".join(letters[i : i + 1000])
            ids += self._encode([joined if joined.isascii() else joined.encode().decode("latin-1").translate(self.letters)], False)
        ids = np.concatenate(ids)
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """The two parts of each new word, as one number."""
        texts = [w.decode() for w in words]
        cores = [t.rstrip(string.punctuation) for t in texts]
        cores = [c if c.isalpha() else t for c, t in zip(cores, texts)]
        tails = [t[len(c) :] for c, t in zip(cores, texts)]
        new = list(set(cores).union(tails).difference(self.parts))
        letters = [p for p in new if p.isascii() and p.isalpha()] + [p for p in new if not p.isascii() and p.isalpha()]
        others = [p for p in new if not p.isalpha()]
        ids, counts = self._merged(letters)
        whole = self._whole(others)
        self.pool = np.concatenate([self.pool, ids, *whole])
        counts = np.concatenate([counts, np.fromiter(map(len, whole), np.int64, len(whole))]).astype(np.int64)
        self.parts.update(zip(letters + others, range(len(self.parts), len(self.parts) + len(new))))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])
        number = self.parts.__getitem__
        return np.array([number(c) << 32 | number(t) for c, t in zip(cores, tails)], np.int64)

    def encode(self, texts: list[str | None], limit: int = SLICE) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many of them are each text's.

        One text that is longer than ``limit`` is cut at plain spaces, where words end in any case.
        """
        texts = [t or "" for t in texts]
        if len(texts) == 1 and len(texts[0]) > limit and self._plain(texts[0]):
            text, cuts = texts[0], [0]
            while len(text) - cuts[-1] > limit and (at := text.find(" ", cuts[-1] + limit)) >= 0:
                cuts.append(at)
            ids = np.concatenate([self._by_word([text[a:b]])[0] for a, b in zip(cuts, [*cuts[1:], len(text)])])
            return ids, np.array([len(ids)])
        plain = [self._plain(t) for t in texts]
        if all(plain):
            return self._by_word(texts)
        flat, counts = self._by_word([t for t, p in zip(texts, plain) if p])
        quick = iter(np.split(flat, np.cumsum(counts)[:-1]))
        whole = iter(self._whole([t for t, p in zip(texts, plain) if not p]))
        ids = [next(quick if p else whole) for p in plain]
        return np.concatenate(ids), np.array([len(i) for i in ids])

    def _plain(self, text: str) -> bool:
        return self.by_word and "<|" not in text and (text.isascii() or not _OTHER.search(text) and is_normalized("NFC", text))

    def _by_word(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_arrays(pa.array([t.lower() for t in texts], pa.large_string()))
        starts, ends, first = word_spans(data, offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        hashes = word_hashes(data, starts, ends)
        pairs = self.words.get(hashes)
        unknown = np.flatnonzero(pairs < 0)
        if len(unknown):
            new, at, which = np.unique(hashes[unknown], return_index=True, return_inverse=True)
            if self.words.used + len(new) > self.cached_words:  # start anew; texts with more words than that get room for them
                self._clear()
                self.words = HashTable(max(self.cached_words, len(starts)))
                unknown, (new, at, which) = np.arange(len(hashes)), np.unique(hashes, return_index=True, return_inverse=True)
            raw, at = data.tobytes(), unknown[at]
            learned = self._learn([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            self.words.put(new, learned)
            pairs[unknown] = learned[which]
        del starts, ends, hashes, data
        parts = np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1).astype(np.int32).ravel()
        begins = self.first[parts].astype(np.int32)
        lengths = (self.first[parts + 1] - begins).astype(np.int32)
        del pairs, parts
        stops = np.cumsum(lengths, dtype=np.int64)
        shift = np.repeat((begins - (stops - lengths)).astype(np.int32), lengths)
        shift += np.arange(stops[-1], dtype=np.int32)
        return self.pool[shift], np.diff(np.concatenate(([0], stops))[2 * first])


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece. Longest first; each goes to the first bin with room."""
    leaves = 1 << max(0, (len(lengths) - 1).bit_length())
    room = [capacity] * (2 * leaves)  # node i has children 2i and 2i + 1; unused bins are empty ones
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need, node = lengths[i], 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        placed[i] = (node - leaves, capacity - room[node])
        room[node] -= need
        node //= 2
        while node:
            best = room[2 * node] if room[2 * node] >= room[2 * node + 1] else room[2 * node + 1]
            if room[node] == best:
                break
            room[node] = best
            node //= 2
    return placed


def _tokenize(path: str, end_id: int, capacity: int, groups: int, cached_words: int, slice_bytes: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, names = WordTokenizer(path, cached_words), [f.split()[0] for f in _PIECES.split(", ")]
        for batch in slices(batches, "text", slice_bytes):
            ids, counts = reader.encode(batch.column("text").to_pylist(), slice_bytes)
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            totals = counts + 1
            n_pieces = -(-totals // capacity)
            doc = np.repeat(np.arange(len(counts)), n_pieces)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = number * capacity
            length = np.minimum(totals[doc] - start, capacity)
            with np.errstate(over="ignore"):
                salt = mix(batch.column("salt").to_numpy().view(np.uint64)[doc] + number.astype(np.uint64))
            ends = np.cumsum(length, dtype=np.int64) * 4
            binary = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(np.concatenate(([0], ends))), pa.py_buffer(ids)])
            columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(totals[doc]), binary.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array((salt % np.uint64(groups)).astype(np.int64))], names=names)

    return pieces


def _pack(capacity: int):
    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending")])
        lengths = table.column("length").to_pylist()
        placed = first_fit_decreasing(lengths, capacity)
        filled = np.bincount([b for b, _ in placed], weights=lengths).astype(np.int64)
        padded = [int(n) if n & (n - 1) == 0 else capacity for n in filled.tolist()]
        first = key[0].as_py() << 24
        table = table.select(["doc_id", "start", "length", "doc_tokens", "ids"])
        table = table.append_column("sequence_id", pa.array([first + b for b, _ in placed], pa.int64()))
        table = table.append_column("offset", pa.array([o for _, o in placed], pa.int64()))
        return table.append_column("padded_to", pa.array([padded[b] for b, _ in placed], pa.int64()))

    return pack


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY, group: int = GROUP, cached_words: int = CACHED_WORDS, slice_bytes: int = SLICE
) -> DataFrame:
    """One row per piece: where its ids (little-endian unsigned 32 bit) stand in the document and in which sequence.

    Rows are numbered as they are read, to spread repeated ones over the groups: give a stored
    table, which a task that runs again reads in the same order.
    ``cached_words`` and ``slice_bytes`` trade a task's memory against its time; the result does not depend on them.
    """
    # a row's number within the scan spreads repeated rows over the groups like any others
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    size = docs.select(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    groups = max(1, math.ceil((size["n"] + size["b"] / 3 / capacity) / group))
    pieces = rows.mapInArrow(_tokenize(tokenizer, end_id, capacity, groups, cached_words, slice_bytes), _PIECES)
    return pieces.groupBy("grp").applyInArrow(_pack(capacity), _PACKED)


def piece_digests(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to")

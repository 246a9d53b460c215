"""Benchmark items in documents, also reworded ones, by latent semantic retrieval.

1. Every text becomes word hashes (letters and digits, lower-cased). Passages of
   ``PASSAGE`` words give the passage frequency of each of ``TERMS`` hashed terms, and
   with it the weights (inverse frequency) of the TF-IDF matrix of all passages.
2. A randomised SVD of that matrix: each task multiplies its passages with random
   numbers, ``EXTRA`` columns more than needed, the products are summed over all tasks,
   and the leading ``RANK`` directions of the sum stand for the right singular vectors.
   Its size is fixed (``TERMS`` x ``RANK``).
3. Windows of the documents, about as long as an item, are candidates when their cosine
   with the item in that space is at least ``NEAR``. Window vectors are sums of blocks of
   a few words, so the cosines of a text with a group of items are one matrix product.
   Without a basis there are no candidates.
4. Candidates are confirmed by the longest common subsequence with the item,
   ``LEAST_COMMON`` of whose words they must hold in order, and by its answer: of the
   item's last sentence as well. Two counts that bound the subsequence from above (the
   window's words that stand in the item, the item's that stand in the window) spare
   those that cannot succeed. The better cosine is tried first.

The benchmark is taken in blocks of at most about ``ITEM_BLOCK`` items, each small
enough to send to all tasks. Frequent terms weigh little, but never nothing: an item of
frequent words alone, or one that most passages hold, is found like any other.

Null and empty texts and items match nothing, nor do items without words. Null ids are
kept; repeated rows give repeated results. Long texts are searched whole, in segments
that overlap. Empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import slices, stored, text_arrays
from fiscalmill.llm.words import word_hashes, word_spans

TERMS = 1 << 15
RANK = 32
EXTRA = 8
#: Least cosine of a candidate. With a third of an item's words swapped 99 in 100 stand above it, of unrelated windows about a third (sf0.1).
NEAR = 0.4
PASSAGE = 32
ITEM_BLOCK = 2000
LEAST_COMMON = 0.65
LEAST_ANSWER = 0.5
_SLOTS = 16
_TOGETHER = 256
SEGMENT = 1 << 17
_FOUND = "doc_id long, item_id long, n_common int, n_item_words int, first_word long"


def _apart() -> np.ndarray:
    """ASCII other than letters and digits parts words."""
    return np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of all words, and the number of the first one of each text (one more at the end)."""
    data, offsets = text_arrays(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))
    starts, ends, first = word_spans(data, offsets, _apart())
    return (word_hashes(data, starts, ends) >> np.uint64(32)).astype(np.uint32), first


def _passages(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Terms of each passage, a row each; filled up with TERMS, which weighs nothing."""
    place = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    row = np.cumsum(place % PASSAGE == 0) - 1
    out = np.full((int(row[-1]) + 1 if len(row) else 0, PASSAGE), TERMS, np.int32)
    out[row, place % PASSAGE] = words & (TERMS - 1)
    return out


def _words_and_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: a document's words; of kind 1, at the end: a part of the task's passage frequencies."""
    names = ["kind", "doc_id", "slot", "data"]
    counts = np.zeros(TERMS + 1, np.int64)
    for batch in slices(batches, "text"):
        words, first = hashed_words(batch.column("text"))
        n = batch.num_rows
        offsets = pa.py_buffer((first * 4).astype(np.int32))
        data = pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(words)])
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), batch.column("doc_id"), pa.array(np.zeros(n, np.int32)), data], names=names)
        rows = np.sort(_passages(words, first), axis=1)
        own = np.ones(rows.shape, bool)
        own[:, 1:] = rows[:, 1:] != rows[:, :-1]
        counts[:TERMS] += np.bincount(rows[own & (rows < TERMS)], minlength=TERMS)
        counts[TERMS] += len(rows)
    parts = np.array_split(counts, _SLOTS)
    yield pa.RecordBatch.from_arrays([pa.array([1] * _SLOTS, pa.int32()), pa.nulls(_SLOTS, pa.int64()), pa.array(range(_SLOTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=names)


def _summed(rows: DataFrame, kind: str) -> np.ndarray:
    """Sum of all tasks' parts, slot by slot; a vector of fixed size comes to the driver."""

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, kind).astype(np.float64) for b in table.column("data").to_pylist())
        return pa.table({"slot": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select("slot", "data").groupBy("slot").applyInArrow(add, "slot int, data binary").collect()
    return np.concatenate([np.frombuffer(r["data"]) for r in sorted(parts, key=lambda r: r["slot"])] or [np.zeros(0)])


def _terms(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Each word's term; a word that one of the four before it repeats weighs nothing, or runs of one word would drown what stands beside."""
    terms = (words & (TERMS - 1)).astype(np.int64)
    for k in range(1, 5):
        terms[k:][(words[k:] == words[:-k]) & (text[k:] == text[:-k])] = TERMS
    return terms


def _documents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("data")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return np.frombuffer(data.tobytes(), np.uint32), (offsets - offsets[0]) // 4


def basis(words: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Orthonormal columns (TERMS x RANK) of the randomised SVD of the weighted passages."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TERMS + 1, RANK + EXTRA), np.float32)
        for batch in slices(batches, "data", 524288):
            rows = _passages(*_documents(batch))
            used = np.flatnonzero(rows.ravel() < TERMS)
            if not len(used):
                continue
            # the same numbers whenever a task runs again
            noise = np.random.default_rng([len(rows), int(rows[0, 0]), int(rows[-1, 0])]).standard_normal((len(rows), RANK + EXTRA), np.float32)
            weight = np.take(weights, rows)
            noise /= np.maximum(np.sqrt(np.einsum("ps,ps->p", weight, weight)), 1e-9)[:, None]
            terms = rows.ravel()[used].astype(np.uint16)  # sorted by counting
            order = np.argsort(terms, kind="stable")
            used, terms = used[order], terms[order]
            passage = used // PASSAGE
            for at in range(0, len(terms), 8192):  # as much as a processor's cache holds
                some = terms[at : at + 8192]
                cuts = np.flatnonzero(np.concatenate(([True], some[1:] != some[:-1])))
                total[some[cuts]] += np.add.reduceat(np.take(noise, passage[at : at + 8192], axis=0), cuts, axis=0)
        parts = np.array_split(total[:TERMS] * weights[:TERMS, None], _SLOTS)  # a term weighs the same in all passages
        yield pa.RecordBatch.from_arrays([pa.array(range(_SLOTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["slot", "data"])

    product = _summed(words.mapInArrow(sketch, "slot int, data binary"), "f4").reshape(-1, RANK + EXTRA)
    if not product.any():
        return np.zeros((TERMS, RANK))
    return np.linalg.svd(product, full_matrices=False)[0][:, :RANK]


def common(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel steps. ``masks``: where each word of the other text stands."""
    full = (1 << n) - 1
    state = full
    for w in words:
        hit = state & masks.get(w, 0)
        state = ((state + hit) | (state - hit)) & full
    return n - state.bit_count()


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


class Items:
    """A block of benchmark items, ready to be searched for."""

    def __init__(self, rows: list[tuple[int, str]], projection: np.ndarray):
        rows = [(i, t) for i, t in rows if t and re.search(r"[^\W_]", t)]
        words, first = hashed_words(pa.array([t for _, t in rows], pa.large_string()))
        answers, at = hashed_words(pa.array([_last_sentence(t) for _, t in rows], pa.large_string()))
        keep = [k for k in range(len(rows)) if first[k + 1] > first[k]]
        self.ids = [rows[k][0] for k in keep]
        self.words = [words[first[k] : first[k + 1]].tolist() for k in keep]
        self.answers = [answers[at[k] : at[k + 1]].tolist() for k in keep]
        self.masks, self.answer_masks = [_masks(w) for w in self.words], [_masks(a) for a in self.answers]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        terms = [_terms(np.array(w, np.uint32), np.zeros(len(w))) for w in self.words]
        vectors = np.array([projection[t].sum(axis=0) for t in terms], np.float32).reshape(-1, RANK)
        self.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        # what the longest common subsequence must reach
        self.least = np.array([next(c for c in range(n + 1) if c >= LEAST_COMMON * n) for n in self.sizes.tolist()], np.int64)
        # short items need windows at finer steps
        self.steps = np.where(self.sizes < 24, 4, 8)
        # items of one step and about one length are counted together: (step, items, which terms each holds)
        self.groups: list[tuple[int, np.ndarray, np.ndarray]] = []
        for step in (4, 8):
            chosen = np.flatnonzero(self.steps == step)
            chosen = chosen[np.argsort(self.sizes[chosen], kind="stable")]
            for at in range(0, len(chosen), _TOGETHER):
                own = chosen[at : at + _TOGETHER]
                holds = np.zeros((TERMS + 1, len(own)), np.uint8)
                for k, i in enumerate(own.tolist()):
                    holds[np.array(self.words[i]) & (TERMS - 1), k] = 1
                self.groups.append((step, own, holds))


def _last_sentence(text: str) -> str:
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if re.search(r"[^\W_]", p)]
    return parts[-1] if parts else text


def _item_side(items: Items, own: np.ndarray, columns: np.ndarray, terms: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """How many of the item's words stand in each window: the other bound of the common subsequence."""
    wanted = np.full((len(own), width), TERMS, np.int64)
    for k, i in enumerate(own.tolist()):
        wanted[k, : len(items.words[i])] = np.array(items.words[i]) & (TERMS - 1)
    out = np.empty(len(columns), np.int64)
    present = np.zeros((min(_TOGETHER, len(columns)), TERMS + 1), bool)
    for at in range(0, len(columns), _TOGETHER):
        part = slice(at, at + _TOGETHER)
        place = begin[part, None] + np.arange(width)
        window = np.where(place < end[part, None], terms[np.minimum(place, len(terms) - 1)], TERMS)
        line = np.arange(len(window))[:, None]
        present[line, window] = True
        present[:, TERMS] = False
        out[part] = present[line, wanted[columns[part]]].sum(axis=1)
        present[line, window] = False
    return out


class _Sums:
    """Sums of consecutive rows, put together from sums of 1, 2, 4, ... of them."""

    def __init__(self, rows: np.ndarray):
        self.powers = [rows]

    def _parts(self, width: int) -> Iterator[tuple[int, np.ndarray]]:
        at = 0
        for k in range(width.bit_length()):
            if len(self.powers) <= k:
                last, half = self.powers[-1], 1 << (k - 1)
                self.powers.append(last[:-half] + last[half:])
            if width >> k & 1:
                yield at, self.powers[k]
                at += 1 << k

    def windows(self, width: int, stop: np.ndarray) -> np.ndarray:
        """For each row the sum of it and those after it, ``width`` together; none from ``stop`` on."""
        n = len(self.powers[0])
        out = np.zeros(self.powers[0].shape, self.powers[0].dtype)
        whole = max(0, n - width + 1)
        for at, part in self._parts(width):
            out[:whole] += part[at : at + whole]
        length = stop - np.arange(n)
        short = np.flatnonzero(length < width)
        for fewer in range(1, width):
            rows = short[length[short] == fewer]
            if len(rows):
                out[rows] = sum(part[rows + at] for at, part in self._parts(fewer))
        return out


def _block_vectors(projection: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Sums of four terms' vectors each, some blocks at a time."""
    out = np.empty((len(terms) // 4, RANK), np.float32)
    for at in range(0, len(out), 2048):
        four = np.take(projection, terms[4 * at : 4 * at + 8192], axis=0).reshape(-1, 4 * RANK)
        half = four[:, : 2 * RANK] + four[:, 2 * RANK :]
        np.add(half[:, :RANK], half[:, RANK:], out=out[at : at + 2048])
    return out


def _near(windows: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of the windows with the items, and what each window's must reach for the least cosine."""
    return windows @ vectors.T, NEAR * np.maximum(np.sqrt(np.einsum("wr,wr->w", windows, windows)), 1e-9)[:, None]


def _search(items: Items, projection: np.ndarray, words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, item, common words, first word) of confirmed windows, the best of each text and item."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    if not len(words):
        return []
    # each text filled up to whole blocks of 8 words; what is filled in weighs nothing
    sizes = np.diff(first)
    blocks = -(-sizes // 8)
    at = np.concatenate(([0], np.cumsum(blocks)))
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(words)) + (8 * at[:-1] - first[:-1])[text]
    terms = np.full(8 * int(at[-1]), TERMS, np.int64)
    terms[place] = words & (TERMS - 1)
    weighed = np.full(len(terms), TERMS, np.int64)
    weighed[place] = _terms(words, text)
    sums = _block_vectors(projection, weighed)
    vectors = {step: _Sums(sums if step == 4 else sums[0::2] + sums[1::2]) for step in {step for step, _, _ in items.groups}}
    # (text, item, start, most words in common) of all candidates that can succeed, and their cosines
    found: list[np.ndarray] = []
    nearness: list[np.ndarray] = []
    for step, group, holds in items.groups:
        held = np.take(holds, terms, axis=0)
        while len(held) * step > len(terms):
            held = held[0::2] + held[1::2]
        owner = np.repeat(np.arange(len(sizes)), blocks * (8 // step))
        last = (at[1:] * (8 // step))[owner]  # a text's blocks end here
        widths = -(-items.sizes[group] // step) + 1
        kind = np.uint8 if int(widths.max()) * step < 256 else np.uint32
        for width in np.unique(widths).tolist():
            low, high = np.searchsorted(widths, [width, width + 1])
            stop = np.minimum(np.arange(len(held)) + width, last)
            near, least = _near(vectors[step].windows(width, stop), items.vectors[group[low:high]])
            counts = _Sums(np.ascontiguousarray(held[:, low:high], kind)).windows(width, stop)
            rows, columns = np.divmod(np.flatnonzero((near >= least) & (counts >= items.least[group[low:high]].astype(kind))), high - low)
            if not len(rows):
                continue
            item, begin, end = group[low:high][columns], rows * step, np.minimum(rows + width, last[rows]) * step
            most = np.minimum(counts[rows, columns], _item_side(items, group[low:high], columns, terms, begin, end, width * step))
            good = np.flatnonzero(most >= items.least[item])
            found.append(np.stack([owner[rows], item, begin, most], axis=1)[good])
            nearness.append((near[rows, columns] / least[rows, 0])[good])
    if not found:
        return []
    order = np.argsort(-np.concatenate(nearness), kind="stable")
    for t, i, a, most in np.concatenate(found)[order].tolist():
        n, key = int(items.sizes[i]), (t, i)
        if key in best and most < -best[key][0]:
            continue
        low = a - 8 * int(at[t])
        width = (-(-n // int(items.steps[i])) + 1) * int(items.steps[i])
        some = words[int(first[t]) + low : min(int(first[t]) + low + width, int(first[t + 1]))].tolist()
        same = common(items.masks[i], n, some)
        if same < LEAST_COMMON * n:
            continue
        answer = len(items.answers[i])
        if answer and common(items.answer_masks[i], answer, some) < LEAST_ANSWER * answer:
            continue
        if key not in best or (-same, low) < best[key]:
            best[key] = (-same, low)
    return [(t, i, -found, at) for (t, i), (found, at) in sorted(best.items())]


def _segments(ids: list, words: np.ndarray, first: np.ndarray, overlap: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, list[int]]]:
    """Groups of texts of about SEGMENT words; a longer text in overlapping parts (with the word each begins at)."""
    group: list[tuple] = []
    size = 0
    for k, doc in enumerate(ids):
        a, b = int(first[k]), int(first[k + 1])
        for low in range(a, max(b, a + 1), SEGMENT):
            part = words[low : min(b, low + SEGMENT + overlap)]
            group.append((doc, part, low - a))
            size += len(part)
            if size >= SEGMENT:
                yield _joined(group)
                group, size = [], 0
    if group:
        yield _joined(group)


def _joined(group: list[tuple]) -> tuple[list, np.ndarray, np.ndarray, list[int]]:
    docs, parts, at = zip(*group)
    return list(docs), np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts]))), list(at)


def find_items(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, item_id, n_common, n_item_words, first_word): each item that a document holds, at its best window."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    words = stored(rows.mapInArrow(_words_and_counts, "kind int, doc_id long, slot int, data binary"), "words")
    counts = _summed(words.where("kind = 1"), "i8")
    words = words.where("kind = 0").select("doc_id", "data")
    n, df = (counts[TERMS], counts[:TERMS]) if len(counts) else (0.0, np.zeros(TERMS))
    weights = np.append(np.log((n + 1) / (df + 0.5)), 0).astype(np.float32)  # above 0 even for a term of all passages
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    blocks = max(1, math.ceil(items.count() / ITEM_BLOCK))
    found, projection = None, None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        taken = sorted(((r["item_id"], r["text"]) for r in part.collect()), key=str)
        if projection is None:
            projection = np.concatenate([basis(words, weights), np.zeros((1, RANK))]).astype(np.float32) * weights[:, None]
        index = Items(taken, projection)
        if index.ids:
            result = words.mapInArrow(_finder(index, projection), _FOUND)
            found = result if found is None else found.unionByName(result)
    return found if found is not None else docs.sparkSession.createDataFrame([], _FOUND)


def _finder(items: Items, projection: np.ndarray):
    overlap = 2 * int(items.sizes.max(initial=0)) + 16

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        for batch in slices(batches, "data", 2 << 20):
            best: dict[tuple, tuple] = {}
            ids = list(enumerate(batch.column("doc_id").to_pylist()))
            for docs, words, first, at in _segments(ids, *_documents(batch), overlap):
                for text, item, n, place in _search(items, projection, words, first):
                    key, value = (docs[text], item), (-n, at[text] + place)
                    if key not in best or value < best[key]:
                        best[key] = value
            rows = [(doc[1], items.ids[i], -n, int(items.sizes[i]), place) for (doc, i), (n, place) in best.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in _FOUND.split(", ")])

    return find

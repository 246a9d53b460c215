"""Toxicity from misspelled and exact terms in their context.

* The lexicon is a list of known insults and what labelled texts teach: words that
  stand in toxic texts far more often than in clean ones, after many different
  words (copies of one labelled text always repeat the same neighbours), and stems
  (written ``stem*``, of ``STEM_LETTERS`` letters) that toxic texts use at least twice
  far more often. Each stands in ``LEAST_SHARE`` of the toxic texts of the sample, so
  there are at most 1 / ``LEAST_SHARE`` times as many as a text has different words;
  none that qualifies is left out.
* Its terms form a trie. A Levenshtein automaton of a word runs down the trie and
  keeps only branches that can still end within the allowed edits: none below five
  letters, one from five, two from ten.
* Each hit is weighed in a window of ``CONTEXT`` words: quotation marks around it or
  a verb of speech before it speak for a quotation, an address (you, du, tu ...) for
  abuse.
* A logistic model over these counts, fitted on the same labelled texts, gives the
  score.

At most about ``SAMPLE`` labelled texts are used for training (a documented bound,
drawn by a hash of the text); repeated texts count once. The text alone is scored;
empty and null texts get the score of a text without any hit. Repeated rows get
equal scores; other columns, of whatever name, are only carried along. Long texts are
read whole, and of terms at equal edits the first in order counts. Without labelled
texts the known insults and a fixed model serve; an empty table gives an empty one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import slices, stored, text_arrays
from fiscalmill.llm.words import word_hashes, word_spans

SAMPLE = 20_000
CONTEXT = 5
#: A learned word or stem marks at least this share of the toxic texts, and so many of them.
LEAST_SHARE, LEAST_TEXTS = 0.01, 5
#: Letters of a learned stem; a learned word has at least as many as the shortest.
STEM_LETTERS = (3, 8)
THRESHOLD = 0.7
#: Bytes of text whose words and pairs of words a task counts at once.
COUNTED_BYTES = 1 << 20
#: Known insults, one line per language; a parameter of ``Lexicon``.
INSULTS = """
idiot idiots moron morons stupid dumb dumbass loser losers scum trash clown pathetic worthless disgusting imbecile bastard asshole bitch whore retard pig vermin
dummkopf vollidiot arschloch schlampe abschaum hurensohn miststück
connard connasse salope abruti débile ordure crétin imbécile
gilipollas imbécil estúpido basura cabrón zorra puta
""".split()
#: Words that introduce speech of others, and words that address the reader.
SPEECH = set("said says say called calls wrote writes quoted quote term word words slur insult sagte nannte schrieb zitat wort dit appelé écrit mot dijo llamó escribió palabra".split())
ADDRESS = set("you your youre you're u ur yourself du dich dir dein deine ihr euch tu toi te ton ta vous votre tú usted ustedes tus vosotros".split())
_QUOTES = "\"“”„«»‘’'`"
_EDGE = ".,;:!?()[]{}<>*#%&$|~^=+/\\-_…" + _QUOTES
FEATURES = ("abuse", "quoted", "addressed", "terms", "stems", "stem share")


class Trie:
    """A lexicon trie and, with it, the Levenshtein automata of all its terms at once.

    A state is a set of (trie node, edits so far); it is worked out when a word first
    leads there and kept, so each further word costs one step per letter until no
    term can be reached any more.
    """

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int | None] = [None]
        self.allowed = [0]  # most edits of any term below the node
        self.stems: set[int] = set()  # nodes from which any letters may follow
        given, terms = terms, [t.removesuffix("*") for t in terms]
        self.most = [0 if g.endswith("*") else edits(len(g)) for g in given]
        for number, (term, most) in enumerate(zip(terms, self.most)):
            node = 0
            self.allowed[0] = max(self.allowed[0], most)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.allowed.append(0)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], most)
            if self.term[node] is None or self.most[self.term[node]] < most:
                self.term[node] = number
            if given[number].endswith("*"):
                self.stems.add(node)
        self.letters = set("".join(terms))
        self.numbers: dict[tuple, int] = {(): 0}  # state 0: nothing left
        self.states, self.steps, self.accepts = [()], [{}], [None]
        self.start = self._number({0: 0})

    def _number(self, reached: dict[int, int]) -> int:
        """The state of these nodes and all that follow by leaving letters of a term out."""
        todo = list(reached.items())
        while todo:
            node, used = todo.pop()
            for child in self.children[node].values():
                if used < self.allowed[child] and reached.get(child, 99) > used + 1:
                    reached[child] = used + 1
                    todo.append((child, used + 1))
        key = tuple(sorted(reached.items()))
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            ends = [(used, self.term[node]) for node, used in key if self.term[node] is not None and used <= self.most[self.term[node]]]
            self.accepts.append(min(ends) if ends else None)
        return self.numbers[key]

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for node, used in self.states[state]:
            for own, child in self.children[node].items():
                now = used + (own != letter)
                if now <= self.allowed[child] and reached.get(child, 99) > now:
                    reached[child] = now
            if node in self.stems and reached.get(node, 99) > used:
                reached[node] = used
            if used < self.allowed[node] and reached.get(node, 99) > used + 1:  # a letter too many
                reached[node] = used + 1
        return self._number(reached)

    def nearest(self, word: str) -> tuple[int, int] | None:
        """(number, edits) of the term with the fewest edits, the first of equals."""
        state = self.start
        for letter in word:
            letter = letter if letter in self.letters else ""
            following = self.steps[state].get(letter)
            if following is None:
                following = self.steps[state][letter] = self._step(state, letter)
            if not following:
                return None
            state = following
        found = self.accepts[state]
        return None if found is None else (found[1], found[0])


def edits(length: int) -> int:
    """How many edits a term of this length allows."""
    return 0 if length < 5 else 1 if length < 10 else 2


def bare(word: str) -> str:
    return word.strip(_EDGE).lower()


class Lexicon:
    """Terms with weights in 0..1, and ordinary words that only look like misspelled terms."""

    def __init__(self, terms: dict[str, float], innocent: frozenset[str] = frozenset()):
        self.terms = sorted(terms)
        self.weights = [terms[t] for t in self.terms]
        self.innocent = innocent


class Matcher:
    """Counts of hits in texts, by term and context."""

    def __init__(self, lexicon: Lexicon):
        self.trie, self.weights, self.innocent = Trie(lexicon.terms), lexicon.weights, lexicon.innocent
        self.stem = [t.endswith("*") for t in lexicon.terms]
        self.known: dict[bytes, int] = {}

    def _code(self, word: bytes) -> int:
        """0 for no hit, else 1 + 4 * term + edits."""
        code = self.known.get(word)
        if code is None:
            plain = bare(word.decode())
            hit = self.trie.nearest(plain)
            code = self.known[word] = 0 if hit is None or (hit[1] and plain in self.innocent) else 1 + 4 * hit[0] + hit[1]
        return code

    def features(self, column: pa.Array) -> np.ndarray:
        data, offsets = text_arrays(column)
        starts, ends, first = word_spans(data, offsets)
        out = np.zeros((len(column), len(FEATURES)))
        if not len(starts):
            return out
        if len(self.known) > 200_000:
            self.known.clear()
        raw = data.tobytes()
        _, at, index = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        codes = np.array([self._code(raw[a:b]) for a, b in zip(starts[at].tolist(), ends[at].tolist())], np.int64)[index]
        hits = np.flatnonzero(codes)
        text = np.searchsorted(first, hits, "right") - 1
        seen: set[tuple[int, int]] = set()
        for place, t in zip(hits.tolist(), text.tolist()):
            term, distance = divmod(int(codes[place]) - 1, 4)
            if self.stem[term]:
                out[t, 4] += self.weights[term]
                continue
            low, high = max(int(first[t]), place - CONTEXT), min(int(first[t + 1]), place + CONTEXT + 1)
            around = [raw[starts[i] : ends[i]].decode() for i in range(low, high)]
            weight = self.weights[term] * (0.5 if distance else 1.0)
            out[t, 1 if self._quoted(around, place - low) else 0] += weight
            words = {bare(w) for w in around}
            out[t, 2] += weight * bool(words & ADDRESS)
            if (t, term) not in seen:
                seen.add((t, term))
                out[t, 3] += 1
        out[:, 5] = np.minimum(1, 20 * out[:, 4] / np.maximum(np.diff(first), 20))
        out[:, :5] = np.log1p(out[:, :5])
        return out

    @staticmethod
    def _quoted(around: list[str], at: int) -> bool:
        """Quotation marks that open at or before the word and close at or after it, or a verb of speech just before."""
        before, after = around[: at + 1], around[at:]
        opens = any(w[:1] in _QUOTES for w in before if w)
        closes = any(w.rstrip(".,;:!?")[-1:] in _QUOTES for w in after if w.rstrip(".,;:!?"))
        return (opens and closes) or any(bare(w) in SPEECH for w in around[max(0, at - 3) : at])


def _sampled(labelled: DataFrame) -> DataFrame:
    """(text, toxic) of about ``SAMPLE`` distinct texts at most."""
    rows = labelled.where(F.col("toxic").isNotNull() & F.col("text").isNotNull()).select("text", F.col("toxic").cast("int").alias("toxic"))
    n = rows.count()
    key = F.xxhash64("text")
    if n > SAMPLE:
        rows = rows.where(F.pmod(key, F.lit(1_000_000)) < F.lit(int(1_000_000 * SAMPLE / n)))
    return rows.groupBy(key.alias("key")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Known insults plus words that mark toxic texts; a learned word must follow many different words there."""
    shortest, longest = STEM_LETTERS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", COUNTED_BYTES):
            marks: tuple[dict, dict] = ({}, {})
            pairs = set()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = [bare(w) for w in (text or "").split()]
                stems: dict[str, int] = {}
                into = marks[bool(label)]
                for word, n in Counter(words).items():
                    if shortest <= len(word) and word.isalpha():
                        into[word] = into.get(word, 0) + 1
                        for k in range(shortest, min(len(word), longest) + 1):
                            stems[word[:k]] = stems.get(word[:k], 0) + n
                for stem, n in stems.items():
                    if n > 1:
                        into[stem + "*"] = into.get(stem + "*", 0) + 1
                if label:
                    pairs.update((w, b) for b, w in zip(["", *words], words))
            clean, toxic = marks
            rows = [(w, toxic.get(w, 0), clean.get(w, 0), None) for w in {**toxic, **clean}]
            rows += [(w, 0, 0, b) for w, b in pairs if w in toxic]
            if rows:
                names = ["word", "toxic", "clean", "before"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=names)

    totals = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    n_toxic, n_clean = totals["t"], totals["n"] - totals["t"]
    terms = {w: 1.0 for w in INSULTS}
    if n_toxic and n_clean:
        counts = sample.mapInArrow(count, "word string, toxic long, clean long, before string")
        words = stored(counts.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"), F.countDistinct("before").alias("b")), "words")
        odds = (F.col("t") + 0.5) / (n_toxic + 1) / ((F.col("c") + 0.5) / (n_clean + 1))
        stem = F.col("word").endswith("*")
        marked = words.where((F.col("t") >= F.lit(max(LEAST_TEXTS, LEAST_SHARE * n_toxic))) & (stem | (F.col("b") >= 0.75 * F.col("t"))) & (odds > 10))
        ranked = [r.asDict() for r in marked.collect()]  # bounded by their share of the sample
        weight = {r["word"]: min(1.0, (r["t"] + 1) / (r["t"] + r["c"] * n_toxic / n_clean + 2)) for r in ranked}
        chosen: set[str] = set()
        within = {w[:k] for w in terms for k in range(1, len(w) + 1)}  # beginnings of what is chosen or known
        # of stems that mark the same texts the longest; none within another
        for r in sorted((r for r in ranked if r["word"].endswith("*")), key=lambda r: (-r["t"], -len(r["word"]), r["word"])):
            new = r["word"][:-1]
            begun = [new[:k] for k in range(1, len(new) + 1)]
            if new not in within and not any(b in chosen or b in terms for b in begun):
                chosen.add(new)
                within.update(begun)
        single = [r["word"] for r in ranked if not r["word"].endswith("*")]
        single = [w for w in single if w not in terms and not any(w[:k] in chosen for k in range(1, len(w) + 1))]
        terms.update({w: weight[w] for w in single})
        terms.update({c + "*": weight[c + "*"] for c in chosen})
        # misspellings that clean texts use about as often are words of their own; no more than lie within two edits of the terms
        near = sorted(terms)

        def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trie = Trie(near)
            for batch in batches:
                found = [w for w in batch.column("word").to_pylist() if (hit := trie.nearest(w)) and hit[1]]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["word"])

        ordinary = words.where(~stem & (F.col("c") > 0) & (odds < 3)).select("word").mapInArrow(alike, "word string")
        return Lexicon(terms, frozenset(r["word"] for r in ordinary.collect()))
    return Lexicon(terms)


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge. Only a quotation may lower a score: other features that would are left out."""
    use = list(range(x.shape[1]))
    while True:
        own = np.column_stack([np.ones(len(x)), x[:, use]])
        w = np.zeros(own.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(own @ w, -30, 30)))
            gradient = own.T @ (p - y) + 0.5 * np.r_[0, w[1:]]
            hessian = (own * (p * (1 - p))[:, None]).T @ own + 0.5 * np.diag(np.r_[1e-6, np.ones(len(w) - 1)])
            move = np.linalg.solve(hessian, gradient)
            w -= move
            if np.abs(move).max() < 1e-6:
                break
        wrong = [(w[k + 1], k) for k, f in enumerate(use) if w[k + 1] < 0 and FEATURES[f] != "quoted"]
        if not wrong:
            out = np.zeros(x.shape[1] + 1)
            out[[0, *(f + 1 for f in use)]] = w
            return out
        del use[min(wrong)[1]]


#: Used when nothing is labelled: one plain hit is toxic, a quoted one is not.
DEFAULT_MODEL = np.array([-3.0, 6.0, 0.5, 1.0, 1.0, 0.0, 0.0])


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def scores(self, matcher: Matcher, column: pa.Array) -> np.ndarray:
        x = matcher.features(column)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))


def train(labelled: DataFrame) -> Model:
    """Fit on rows (text, toxic 0/1)."""
    sample = stored(_sampled(labelled), "labelled")
    lexicon = learn_lexicon(sample)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in slices(batches, "text"):
            x = matcher.features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(list(x), pa.list_(pa.float64()))], names=["toxic", "x"])

    rows = sample.mapInArrow(measure, "toxic int, x array<double>").groupBy("toxic", "x").count().collect()  # SAMPLE rows at most
    y = np.array([r["toxic"] for r in rows], float)
    if not len(rows) or y.min() == y.max():
        return Model(lexicon, DEFAULT_MODEL)
    x = np.array([r["x"] for r in rows])
    weights = np.array([r["count"] for r in rows])
    order = np.lexsort((y, *x.T))  # sums in one order, whatever order the rows came in
    return Model(lexicon, _fit(np.repeat(x[order], weights[order], axis=0), np.repeat(y[order], weights[order])))


def score(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """(rest, score): every row's score, its other columns as a struct."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"), F.col(text_column).alias("text"))
    out = rows.select("rest", F.lit(0.5).alias("score")).schema
    schema = to_arrow_schema(out)
    lexicon = model.lexicon

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in slices(batches, "text"):
            found = model.scores(matcher, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(found, pa.float64())], schema=schema)

    return rows.mapInArrow(mark, out)


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows: labelled documents that are not held out."""
    marks = labels.where(F.col("toxic").isNotNull()).select(F.col("doc_id").cast("long").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
    training = marks.where(F.crc32(F.col("labelled").cast("string")) % 3 != 1).groupBy("labelled").agg(F.max("toxic").alias("toxic"))
    return docs.select("doc_id", "text").join(training, F.col("doc_id") == F.col("labelled")).select("text", "toxic")


def scores_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = score(docs.select("doc_id", "text"), train(labelled_rows(docs, labels)))
    held_out = F.coalesce(F.crc32(F.col("rest.doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select(
        F.col("rest.doc_id").alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

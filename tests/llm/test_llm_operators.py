"""The operators of the subpackage against brute force, and their defined results for odd input."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fiscalmill.llm import ann, chat, decontaminate, html, licenses, packing, queries, simhash, substrings, toxicity, urls

SPACE = r"[^\x20\x09-\x0D]+"
NULL = 1 << 63


def by_text(rows):
    return sorted(rows, key=str)


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture
def odd_documents(spark, sf_dir):
    """Documents with nulls, empty texts, repeated rows and an extra column named like an operator's own."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    one = docs.where("text is not null").orderBy("doc_id").first()
    odd = [(None, None), (None, one["text"]), (7777777, " \t"), (7777778, "A b"), (7777779, "a B"), (7777779, "a B"), (7777780, "")]
    return docs.unionByName(spark.createDataFrame(odd, docs.schema))


def windows_by_hand(rows, size=13):
    words = [re.findall(SPACE, t or "") for _, t in rows]
    first: dict = {}
    for (d, _), w in zip(rows, words):
        for j in range(len(w) - size + 1):
            gram = tuple(w[j : j + size])
            first[gram] = min(first.get(gram, NULL), NULL if d is None else d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = {k for j in range(len(w) - size + 1) if first[tuple(w[j : j + size])] < (NULL if d is None else d) for k in range(j, j + size)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_substrings_match_brute_force(odd_documents, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 50_000)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 10_000)
    rows = [tuple(r) for r in odd_documents.collect()]
    assert by_text(map(tuple, substrings.repeats_of(odd_documents).collect())) == by_text(windows_by_hand(rows))


def test_substrings_name_their_source(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"x {passage} y", 5), (2, f"a b {passage}", 6)], "doc_id long, text string, block int")
    got = {r["rest"]["doc_id"]: r for r in substrings.remove_repeats(docs).collect()}
    assert got[1]["factors"] == [] and got[1]["rest"]["block"] == 5
    assert [f.asDict() for f in got[2]["factors"]] == [{"start": 2, "length": 20, "source_id": 1, "source_start": 1}]
    assert got[2]["kept"] == "a b"


def fingerprints_by_hand(rows):
    prints = []
    for _, t in rows:
        w = re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0)
    marks, root = np.array(prints, np.uint64), list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(marks)):
        for j in np.flatnonzero(np.bitwise_count(marks[i] ^ marks) <= 3):
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), NULL), NULL if d is None else d)
    return [(d, f"{prints[i]:016x}", None if least[find(i)] == NULL else least[find(i)]) for i, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("hot", [20_000, 3])
def test_simhash_matches_brute_force(odd_documents, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    rows = [tuple(r) for r in odd_documents.collect()]
    assert by_text(map(tuple, simhash.components_of(odd_documents).collect())) == by_text(fingerprints_by_hand(rows))


@pytest.mark.parametrize("groups", [[(16, 0)] * 4, [(32, 1), (32, 1)], [(40, 3), (24, -1)], [(20, 1), (44, 1)]])
def test_simhash_thresholds_lose_no_link(spark, monkeypatch, groups):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = base + [b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 4))) for b in base for _ in range(3)]
    values = np.unique(np.array(near, np.uint64))
    at, plan = 0, []
    for size, own in groups:
        plan.append((list(range(at, at + size)), own))
        at += size
    assert sum(own for _, own in plan) == 3 - len(plan) + 1
    monkeypatch.setattr(simhash, "plan", lambda n, both, t: [g for g in plan if g[1] >= 0])
    found = simhash.links(spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long"), 3).collect()
    root = {int(v): int(v) for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found:
        u, v = (int(np.int64(x).astype(np.uint64)) for x in r)
        assert (u ^ v).bit_count() <= 3
        root[find(u)] = find(v)
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if int(a ^ b).bit_count() <= 3:
                assert find(int(a)) == find(int(b))


def test_simhash_keeps_one_of_each(spark):
    rows = [(3, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", "y"), (None, "A b c d", "z"), (9, "quite another text", "q"), (None, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string")
    kept = [tuple(r) for r in simhash.one_of_each(docs).collect()]
    assert by_text(kept) == by_text([(1, "a b c d", "y"), (9, "quite another text", "q"), (None, None, "n")])


def test_packing_round_trip(odd_documents):
    path = public_tokenizers.path("word_bpe_49k.json")
    reader = Tokenizer.from_file(path)
    got = packing.piece_digests(packing.pack_documents(odd_documents, path)).collect()
    want: collections.Counter = collections.Counter()
    for d, t in odd_documents.collect():
        ids = np.array(reader.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        for s in range(0, len(ids), 4096):
            want[(d, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes()), len(ids))] += 1
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096
    total = sum(n for b in bins.values() for _, n in b)
    assert len(bins) <= total / 4096 * 1.03 + 2


@pytest.mark.parametrize("text", ["don't <|endoftext|> we'll", "ÉTÉ é Straße ǅ İstanbul ΑΣ ſ \u212b", "x_y _a 1a2 \xad ª ŉ", "日本 “q”—a", "%%% É?", " \x1c a\x1cb \x85", ""])
def test_word_tokenizer_equals_the_library(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    flat, counts = packing.WordTokenizer(path).encode([text, None, "plain words"])
    reader = Tokenizer.from_file(path)
    assert flat[: counts[0]].tolist() == reader.encode(text, add_special_tokens=False).ids and counts[1] == 0


def test_first_fit_decreasing_is_first_fit():
    rng = random.Random(3)
    lengths = [rng.randint(1, 100) for _ in range(300)]
    room, want = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        b = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        if b == len(room):
            room.append(100)
        want[i] = (b, 100 - room[b])
        room[b] -= lengths[i]
    assert packing.first_fit_decreasing(lengths, 100) == want


@pytest.mark.parametrize("budget, history", [(1024, 256), (60, 20), (5, 0)])
def test_chat_round_trip(spark, sf_dir, budget, history):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (None, 5, None, None), (None, 5, None, None),
           (9000, 3000, "assistant", "x\\<s>y\\"), (9000, 0, "system", "be\n<nice>"), (9000, 70000, "a\n<s>b", "z" * 9000)]
    rows = rows.unionByName(spark.createDataFrame(odd, rows.schema))
    windows = chat.format_windows(rows, public_tokenizers.path("byte_bpe_50k.json"), budget, history)
    turns = collections.defaultdict(list)
    for c, t, r, x in rows.collect():
        turns[c].append((-1 if t is None else t, r or "", x or ""))
    want = []
    for c, own in turns.items():
        loss = "".join(x for _, r, x in sorted(own) if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for _, r, x in sorted(own))
        want.append((c, len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    assert by_text(tuple(r)[:5] for r in chat.digests(windows).collect()) == by_text(want)
    for r in windows.where("not over_budget").collect():
        assert r["n_tokens"] <= budget


def test_chat_repeats_system_and_history(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "a b c"), (1, 2, "assistant", "d e f"), (1, 3, "user", "g h i"), (1, 4, "assistant", "j k l")]
    windows = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), public_tokenizers.path("byte_bpe_50k.json"), 45, 14)
    got = windows.orderBy("window").collect()
    assert len(got) > 1
    for r in got:
        read_back = chat.read_back(r["text"])
        assert read_back[0] == ("system", "s")
        masked = "".join(chat.unescape(r["text"][s["start"] : s["end"]]) for s in r["loss"])
        assert masked == "".join(t for role, t in read_back[r["n_repeated"] :] if role == "assistant")
    assert any(r["n_repeated"] > 1 for r in got[1:])


def nearest_by_hand(rows, every, k=5):
    fit = [(i, [float(x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    fit = list({(i, tuple(v)): None for i, v in fit})
    out = []
    for i, v in fit:
        if i % every == 0:
            scored = sorted((-ann._exact(v, w), j) for j, w in fit if j != i and len(w) == len(v))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return out


@pytest.mark.parametrize("shard,cell", [(16384, 32768), (16384, 50), (60, 40)])
def test_nearest_matches_brute_force(spark, sf_dir, monkeypatch, shard, cell):
    monkeypatch.setattr(ann, "SHARD", shard)
    monkeypatch.setattr(ann, "CELL", cell)
    monkeypatch.setattr(ann, "LEAF", 16)
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    some = [r["vec"] for r in vectors.orderBy("vec_id").limit(3).collect()]
    odd = [(None, some[0]), (100000, None), (100050, [0.0] * 64), (100100, some[0][:63] + [float("nan")]), (100150, some[0][:63] + [None]),
           (100200, some[1]), (100201, some[1]), (100200, some[1]), (100250, [1.0, 2.0]), (100251, [2.0, 4.0])] + [(200000 + i, some[2]) for i in range(30)]
    vectors = vectors.unionByName(spark.createDataFrame(odd, vectors.schema))
    got = sorted(map(tuple, ann.nearest(vectors, lambda v: v % 50 == 0).collect()))
    assert got == sorted(nearest_by_hand([tuple(r) for r in vectors.collect()], 50))


@pytest.mark.parametrize("shard", [16384, 60])
def test_nearest_settles_ties_of_distinct_vectors(spark, monkeypatch, shard):
    monkeypatch.setattr(ann, "SHARD", shard)
    monkeypatch.setattr(ann, "LEAF", 16)
    rng = random.Random(4)
    scaled = [[x * 2.0 ** (k % 41 - 20) for x in (1.0, 2.0, 3.0, -1.0, 0.5, 0.0, 0.0, 1.0)] for k in range(300)]
    binary = [[float(rng.random() < 0.4) for _ in range(8)] for _ in range(150)]
    one_hot = [[float(j == k % 8) * (1 + k // 8) for j in range(8)] for k in range(100)]
    rows = [*scaled, *binary, *one_hot, *([2.0**k, 2.0**k, 0.0, 0.0, 0.0, 0.0, 0.0, 3 * 2.0**k] for k in range(9))]
    ids = rng.sample(range(5000), len(rows) - 9) + [5000] * 9  # one id with many vectors of one direction
    vectors = spark.createDataFrame(list(zip(ids, rows)), "vec_id long, vec array<double>")
    got = sorted(map(tuple, ann.nearest(vectors, lambda v: v % 10 == 0).collect()))
    assert got == sorted(nearest_by_hand([tuple(r) for r in vectors.collect()], 10))


def test_nearest_takes_components_of_any_size(spark):
    rows = [(0, [1e200, 0.0]), (1, [3e-200, 3e-200]), (2, [1e300, 1e299]), (3, [-1.0, 5e-324]), (50, [0.0, 2e250])]
    vectors = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.nearest(vectors, lambda v: v % 50 == 0, k=2).collect()}
    assert {key: v for key, (v, _) in got.items()} == {(0, 1): 2, (0, 2): 1, (50, 1): 1, (50, 2): 2}
    assert got[0, 2][1] == pytest.approx(math.sqrt(0.5)) and got[50, 2][1] == pytest.approx(0.1 / math.sqrt(1.01))


def test_a_cell_takes_few_queries_whose_own_id_has_many_vectors(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ann, "BLOCK_PLACES", 200)
    rng = np.random.default_rng(2)
    vectors, ids = rng.standard_normal((90, 4)), [0] * 60 + list(range(1, 31))
    cell = ann.Cell(pa.table({"ids": [[i] for i in ids], "vec": vectors.tolist()}), 5, 1.0)
    asked = pa.record_batch({"query_id": ids, "qkey": list(range(90)), "vec": vectors.tolist(), "best": [3.0] * 90})
    blocks = list(cell.answers(asked))
    assert len(blocks) > 2
    got = sorted(tuple(r.values()) for b in blocks for r in b.to_pylist())
    want = []
    for n, (i, v) in enumerate(zip(ids, vectors.tolist())):
        scored = sorted((-ann._exact(v, w), j) for j, w in zip(ids, vectors.tolist()) if j != i)[:5]
        want += [(i, n, j, -s) for s, j in scored]
    assert got == sorted(want)


def test_relaxed_pruning_keeps_recall():
    rng = np.random.default_rng(1)
    points = ann._unit(rng.standard_normal((4000, 16)))
    asked = points[:50]
    exact = np.argsort(-(asked @ points.T), axis=1)[:, :5]
    rows, _ = ann.Tree(points).search(asked, np.full(50, 3.0), 5, 1.5)
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(rows.tolist(), exact.tolist())]) >= 0.9


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        step = [i]
        for j, y in enumerate(b, 1):
            step.append(min(step[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = step
    return row[-1]


def test_automaton_finds_the_nearest_term():
    rng, terms = random.Random(3), sorted(set(toxicity.INSULTS))
    trie = toxicity.Trie(terms)
    for _ in range(1500):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at, kind = rng.randint(0, len(word)), rng.randint(0, 2)
            word = word[:at] + [rng.choice("aeioustx")] + word[at + (kind == 0) :] if kind < 2 else word[:at] + word[at + 1 :]
        want = min(((d, i) for i, t in enumerate(terms) if (d := distance(word, t)) <= toxicity.edits(len(t))), default=None)
        assert trie.nearest("".join(word)) == (None if want is None else (want[1], want[0]))


def test_stems_match_any_ending():
    trie = toxicity.Trie(["abcd*", "idiot"])
    assert [trie.nearest(w) for w in ("abcd", "abcdxyz", "abce", "idiots", "")] == [(0, 0), (0, 0), None, (1, 1), None]


def test_toxicity_learns_and_leaves_labels_out(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    odd = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(None, None), (None, "you idiot, you pathetic worthless loser"), (5555555, "")], "doc_id long, text string"))
    rows = toxicity.scores_of(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert max(r["score"] for r in rows if r["doc_id"] is None) > 0.7 > min(r["score"] for r in rows if r["doc_id"] is None)


def test_quoted_insults_weigh_apart():
    import pyarrow as pa

    matcher = toxicity.Matcher(toxicity.Lexicon({"idiot": 1.0}))
    x = matcher.features(pa.array(['he said "idiot" to them', "you idiot", "an idoit idiott", None], pa.string()))
    abuse, quoted, addressed = (toxicity.FEATURES.index(n) for n in ("abuse", "quoted", "addressed"))
    assert x[0, quoted] > 0 == x[0, abuse] and x[1, abuse] > 0 == x[1, quoted] and x[1, addressed] > 0
    assert x[2, abuse] > 0 and not x[3].any()


PAGE = """<html><head><title>x</title></head><body class="home"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div>
<main><article class="post"><h1>T &amp;amp; <b>i</b>t</h1><p>One<br>two <i>th</i>ree<p>Four&nbsp;five<div class="ad-slot">Buy</div><ul><li>a<li>b</ul>
<section id="comments"><p>nice</p></section></article><form><p>mail</p></form></main><aside>s</aside><script>if(a<b){"</p>"}</script><footer>f</footer>"""


def test_markup_parts_the_article_from_the_rest():
    assert " ".join(t for t, sure in html.blocks(PAGE) if sure) == "T &amp; it One two three Four five a b"
    assert html.blocks(None) == [] and html.blocks("a < b and c > d <3") == [("a < b and c > d <3", False)]


def test_host_boilerplate_goes_and_unique_text_stays(spark):
    rows = [(i, "http://a.b/x", f"<body><div>Home News Sport Weather Shop Travel More About</div><p>unique text {i} stands here</p>") for i in range(6)]
    rows += [(None, None, None), (3, None, ""), (7, "x", "<p>q")]
    got = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert by_text((r["page_id"], r["text"]) for r in got) == by_text([(i, f"{i} stands here") for i in range(6)] + [(None, ""), (3, ""), (7, "q")])


def test_groups_of_a_host_decide_as_the_whole_host(spark, monkeypatch):
    # one line stands on 6 of 90 distinct texts (of 5 % of them: boilerplate), one on 4; groups alone would see other shares
    common, rare = "Home News Sport Weather Shop Travel More About", "one two three four five six seven eight"
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(12))
    rows = []
    for i in range(90):
        extra = common if i % 15 == 0 else rare if i % 25 == 1 else ""
        rows.append((i, f"http://a.b/{i}", f"<body><div>{extra}</div><p>{own(i)}</p>"))
    rows += [(100 + i, f"http://a.b/{i}", rows[2][2]) for i in range(60)]  # copies count once, in whatever group they are
    rows += [(300 + i, "http://c.d/", "<body><div>" + common + f"</div><p>text {i}</p>") for i in range(3)] + [(400, None, None), (401, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = html.main_text(pages).collect()
    assert {r["page_id"] for r in whole if r["n_boilerplate"]} == {*range(0, 90, 15), 300, 301, 302}
    for size in (40, 9):
        monkeypatch.setattr(html, "HOST_PAGES", size)
        assert by_text(html.main_text(pages).collect()) == by_text(whole)


def test_pages_give_their_articles(spark, sf_dir):
    import html as decode

    pages = read(spark, sf_dir, "pages")
    got = {r["page_id"]: r["text"] for r in html.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        assert got[r["page_id"]] == " ".join(decode.unescape(re.sub(r"<[^>]*>", " ", article)).split())


def test_repeated_runs_match_brute_force():
    rng = np.random.default_rng(7)
    tokens = rng.integers(0, 3, 400).astype(np.uint64)
    page = np.sort(rng.integers(0, 12, 400))
    runs = collections.defaultdict(set)
    spots = [i for i in range(400 - html.RUN + 1) if page[i] == page[i + html.RUN - 1]]
    for i in spots:
        runs[tuple(tokens[i : i + html.RUN])].add(page[i])
    want = np.zeros(400, bool)
    for i in spots:
        if len(runs[tuple(tokens[i : i + html.RUN])]) >= 3:
            want[i : i + html.RUN] = True
    assert np.array_equal(html.repeated(tokens, page, 3), want)


def test_url_rules_and_odd_urls(spark):
    rows = [(1, "HTTP://A.Com/x/Y?z"), (2, None), (3, "nourl"), (4, "http://www.example.com/en/1"), (5, "http://q.example.com/en/1#a"),
            (6, "https://example.com"), (7, "a://net/fr/"), (8, "a://xnet/fr/"), (9, "a://b.net/fr"), (10, "x://h:80?u=://q/w"), (None, "")]
    none = spark.createDataFrame([], "page_id long, bad int")
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), none, queries.URL_RULES).collect()
    assert by_text(tuple(r)[:5] for r in got) == by_text([
        (1, "a.com", "/x/Y", "com/", "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (5, "q.example.com", "/en/1", "example.com/en/", "block"), (6, "example.com", "", None, "allow"), (7, "net", "/fr/", "net/fr/", "block"),
        (8, "xnet", "/fr/", None, "allow"), (9, "b.net", "/fr", None, "allow"), (10, "h:80", "", None, "allow"), (None, "", "", None, "allow"),
    ])


def test_url_templates_of_bad_branches_are_rejected(spark):
    rows = [(i, f"http://h.org/spam/{i}") for i in range(40)] + [(100 + i, f"http://h.org/news/{i}") for i in range(40)]
    labels = [(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)] + [(5, None)]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int"), []).collect()
    assert {(r["template"], r["verdict"]) for r in got} == {("/spam/<n>", "block"), ("/news/<n>", "allow")} and len(got) == 80


def test_url_plan_has_no_python(spark, sf_dir):
    plan = queries.op6_urls(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_licenses_in_documents_and_reworded(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    odd = [(None, None), (None, "this work is Licensed under the gnu General Public License version 3"), (81, "foo " * 200 + "Licensed under CC BY-NC 4.0. " + "bar " * 300),
           (82, "Copyright 2020. All rights reserved. Released under the MIT License. More."), (83, "Licensed under the Apache Licence, Version 2.0"), (84, "licensed to kill"), (84, "")]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    got = collections.Counter((r["doc_id"], r["license"]) for r in licenses.find_notices(docs).collect())
    want = collections.Counter((d, n) for d, t in docs.collect() for n, wording in licenses.TEMPLATES.items() for _ in range((t or "").count(wording)))
    want.update([(None, "GPL-3.0"), (83, "Apache-2.0")])
    assert got == want
    for r in licenses.find_notices(docs).where("doc_id = 82").collect():
        assert odd[3][1][r["start"] : r["start"] + r["length"]] == r["text"]


LICENSE_PROBES = [
    ("x " * 30 + "general conditions " + "y " * 55 + "Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n"
     " * file, You can obtain one at https://mozilla.org/MPL/2.0/. */", ["MPL-2.0"]),
    ("# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met:\n", ["BSD-3-Clause"]),
    ("MIT License\n\nCopyright (c) 2020 Some One\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
     "documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:", ["MIT", "MIT"]),
    ("This program is free software; you can redistribute it and/or\nmodify it under the terms of the GNU General Public License\nas published by the Free Software "
     "Foundation; either version 2\nof the License, or (at your option) any later version.", ["GPL-2.0"]),
    ("Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
     "copyright notice and this permission notice appear in all copies.", ["ISC"]),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0"]),
    ("Licensed under CC BY-SA 4.0. Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"] * 2),
    ("Licensed under CC BY-XX 4.0. Licensed to kill by Apache helicopters, version 2.0", []),
    ("GNU LESSER GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007", ["LGPL-3.0"]),
]


def test_licenses_in_published_wordings(monkeypatch):
    scanner = licenses.Scanner(licenses.all_wordings())
    for text, want in LICENSE_PROBES:
        assert [n[0] for n in scanner.notices(text)] == want, text
    for own in scanner.wordings:  # every wording is recognised as its own license, wherever it stands
        text = "foo bar baz qux " * 2000 + own.text + " lorem ipsum dolor " * 2000
        assert [n[0] for n in scanner.notices(text)] == [own.name], own.text
    two, three = (licenses._BSD + end for end in ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS", licenses.PUBLISHED["BSD-3-Clause"][1].removeprefix(licenses._BSD)))
    assert [n[0] for n in scanner.notices(two)] == ["BSD-2-Clause"] and [n[0] for n in scanner.notices(three)] == ["BSD-3-Clause"]
    # the compression decides: without savings nothing is a notice
    monkeypatch.setattr(licenses.Scanner, "saved", lambda self, block, own: 0)
    assert not any(list(scanner.notices(text)) for text, _ in LICENSE_PROBES)


def leaks_by_hand(docs, items):
    plain = lambda s: " " + " ".join(re.findall(r"[^\W_]+", (s or "").lower())) + " "
    texts = [(d, plain(t)) for d, t in docs]
    return {(d, i) for i, x in items if plain(x).strip() for d, t in texts if plain(x) in t}


def test_decontamination_finds_leaks_and_paraphrases(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    items = [tuple(r) for r in read(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    rng = random.Random(1)
    vocabulary = " ".join(r["text"] for r in docs.limit(50).collect()).split()
    reworded = []
    for i, text in items:
        words = [rng.choice(vocabulary) if rng.random() < 0.1 else w for w in text.split()]
        around = rng.sample(vocabulary, 200)
        reworded.append((900_000 + i, " ".join(around[:100] + words + around[100:])))
    more = docs.unionByName(spark.createDataFrame([*reworded, (None, None), (None, items[3][1]), (77, "")], docs.schema))
    bench = spark.createDataFrame([*items, (None, None), (999, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(more, bench).collect()}
    exact = leaks_by_hand([tuple(r) for r in docs.collect()], items)
    assert exact <= got and (None, items[3][0]) in got
    found = {k for k in got if k[0] is not None and k[0] >= 900_000}
    assert all(d - 900_000 == i for d, i in found) and len(found) >= 0.85 * len(items)
    assert len({k for k in got - exact if k[0] is not None and k[0] < 900_000}) <= 1


@pytest.mark.parametrize("shape", ["third", "three", "frequent"])
def test_decontamination_finds_items_of_frequent_words(spark, sf_dir, shape):
    docs = read(spark, sf_dir, "documents").where("text is not null").orderBy("doc_id").select("doc_id", "text").collect()
    item = read(spark, sf_dir, "benchmark").orderBy("item_id").first()["text"]
    if shape == "third":  # short texts, a third of them copies of one that holds the item
        rows = [(k, f"{docs[0]['text'][:300]} {item}" if k % 3 == 0 else r["text"]) for k, r in enumerate(docs)]
        want = {k for k in range(len(docs)) if k % 3 == 0}
    elif shape == "three":
        rows, want = [(0, docs[0]["text"][:400]), (1, f"{docs[1]['text'][:200]} {item} {docs[2]['text'][:200]}"), (2, item)], {1, 2}
    else:  # each word of the item is in every text, in another order
        words = item.split()
        rows = [(k, " ".join(random.Random(k).sample(words, len(words)))) for k in range(40)] + [(40, item)]
        want = {40}
    got = decontaminate.find_items(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    found = {r["doc_id"]: r["n_common"] for r in got.collect()}
    assert want <= set(found) and all(found[k] == len(re.findall(r"[^\W_]+", item)) for k in want)


def test_decontamination_matches_brute_force(spark, sf_dir):
    rng = random.Random(3)
    docs = [tuple(r) for r in read(spark, sf_dir, "documents").where("text is not null").orderBy("doc_id").select("doc_id", "text").limit(40).collect()]
    items = [tuple(r) for r in read(spark, sf_dir, "benchmark").orderBy("item_id").select("item_id", "text").limit(30).collect()]
    plain = lambda s: re.findall(r"[^\W_]+", s.lower())
    vocabulary = [w for _, t in docs for w in plain(t)]
    count = collections.Counter(vocabulary)
    rows = [(d, " ".join(plain(t)[:400])) for d, t in docs]
    for i, text in items:  # a third of the words swapped: the rarest, or any
        words = plain(text)
        for kind, order in enumerate((sorted(range(len(words)), key=lambda k: count[words[k]]), rng.sample(range(len(words)), len(words)))):
            swapped = list(words)
            for k in order[: len(words) // 3]:
                swapped[k] = rng.choice(vocabulary)
            rows.append((1000 * (kind + 1) + i, " ".join(rng.sample(vocabulary, 30) + swapped + rng.sample(vocabulary, 30))))
    want = {}
    for d, text in rows:
        words = plain(text)
        for i, item in items:
            whole, last = plain(item), plain(decontaminate._last_sentence(item))
            step = 4 if len(whole) < 24 else 8
            width = (-(-len(whole) // step) + 1) * step
            for at in range(0, len(words), step):
                window = words[at : at + width]
                same = decontaminate.common(decontaminate._masks(whole), len(whole), window)
                if same >= 0.65 * len(whole) and decontaminate.common(decontaminate._masks(last), len(last), window) >= 0.5 * len(last):
                    want[d, i] = max(want.get((d, i), (0, 0)), (same, -at))
    got = decontaminate.find_items(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): (r["n_common"], -r["first_word"]) for r in got} == want and len(want) > 40


def test_decontamination_candidates_come_from_the_basis(spark, monkeypatch, sf_dir):
    item = read(spark, sf_dir, "benchmark").orderBy("item_id").first()
    docs = spark.createDataFrame([(1, item["text"]), (2, "some other words"), (3, "none of them")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item["text"])], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(docs, bench).collect()] == [(1, 7)]
    monkeypatch.setattr(decontaminate, "basis", lambda words, weights: np.zeros((decontaminate.TERMS, decontaminate.RANK)))
    assert decontaminate.find_items(docs, bench).count() == 0


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(50):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(1, 20))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0, *(v for v in _steps(row, x, b))]
        assert decontaminate.common(decontaminate._masks(a), len(a), b) == row[-1]


def _steps(row, x, b):
    left = 0
    for j, y in enumerate(b, 1):
        left = row[j - 1] + 1 if x == y else max(left, row[j])
        yield left


def test_long_texts_are_searched_in_segments(spark, monkeypatch, sf_dir):
    monkeypatch.setattr(decontaminate, "SEGMENT", 50)
    item = read(spark, sf_dir, "benchmark").orderBy("item_id").first()
    text = "word " * 90 + item["text"] + " word" * 500
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").unionByName(spark.createDataFrame([(88, text)], "doc_id long, text string"))
    got = decontaminate.find_items(docs, read(spark, sf_dir, "benchmark")).where("doc_id = 88").collect()
    assert [r["item_id"] for r in got] == [item["item_id"]] and 0 <= 90 - got[0]["first_word"] < 16  # a window may be two blocks longer

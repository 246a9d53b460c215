"""Inputs that operators once got wrong."""

import collections
import random
import subprocess
import sys
import textwrap

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fiscalmill.llm import chat, html, toxicity, urls

TEXT = "The whole story is told here in some words that stand on no other page of this host at all."
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def main_texts(spark, *pages, apart=False):
    df = spark.createDataFrame([(i, f"http://h{i if apart else 0}.example/x", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in html.main_text(df).orderBy("page_id").collect()]


def test_names_that_say_what_a_part_goes_with_leave_it_in(spark):
    pages = [
        f'<body><article class="post comments-open"><p>{TEXT}</p></article></body>',
        f'<body><div class="content has-sidebar"><p>{TEXT}</p></div><div class="sidebar">Other</div></body>',
        f'<body><article class="tag-legal category-ads"><p>{TEXT}</p></article></body>',
        f'<body><article><header class="entry-header"><h1>Headline</h1></header><p>{TEXT}</p></article></body>',
        f"<body><article><p title=don't>{TEXT}</p></article></body>",
        f'<body><div><p>{TEXT}</p></div><article><p>A short teaser</p></article></body>',
        f'<body><article><p>{TEXT}</p><div class="comment-list">me first</div><div id="site-nav">Home</div></article><header class="site-header">Top</header></body>',
    ]
    teaser = f"{TEXT} A short teaser"
    assert main_texts(spark, *pages, apart=True) == [TEXT, TEXT, TEXT, f"Headline {TEXT}", TEXT, teaser, TEXT]


def test_pages_without_article_lose_what_repeats(spark):
    menu = "Home News Sports Weather Contact About Jobs Press Help"
    words = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(8)]
    pages = [f"<body><div>{menu}</div><div><p>{w}</p></div></body>" for w in words]
    assert main_texts(spark, *pages) == words
    pages = [f"<body><div>{menu}</div><article>Read more {i}</article><div>{w}</div></body>" for i, w in enumerate(words)]
    assert main_texts(spark, *pages) == [f"Read more {i} {w}" for i, w in enumerate(words)]


@pytest.mark.parametrize("at", [None, -1, 0])
def test_the_system_turn_reaches_every_later_segment(spark, at):
    rows = [(1, at, "system", "Be kind")] + [(1, t, "user" if t % 2 else "assistant", f"turn {t}") for t in (*range(1, 40), 5000, 5001, 9000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(df, TOKENIZER, budget=60, history=20).collect()
    assert len({w["segment"] for w in windows}) >= 3
    for w in windows:
        assert ("system", "Be kind") in chat.read_back(w["text"])


def test_history_is_bounded_by_its_allowance_alone():
    tokens = [1] * 300
    for back, new, end in chat.spans(tokens, 200, 150):
        assert new - back == min(new, 150) and end - back <= 200
    assert list(chat.spans([0, 0, 5, 0, 9], 5, 0)) == [(0, 0, 4), (4, 4, 5)]


@pytest.mark.parametrize("missing", ["zstandard", "public_tokenizers", "xxhash", "corpus_pipeline"])
def test_the_entry_lives_without_what_only_the_subpackage_needs(missing):
    code = f"""
        import sys
        sys.modules[{missing!r}] = None
        import __spark_entry__ as entry
        assert "risk_by_state" in entry.queries() and "op1_chat_windows" not in entry.queries() and "pipeline" not in entry.oracle_sql()
        """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, cwd=__file__.rsplit("/tests/", 1)[0])


def url_verdicts(spark, rows, labels):
    df = spark.createDataFrame([(i, f"http://h.example{p}") for i, p in enumerate(rows)], "page_id long, url string")
    marks = spark.createDataFrame(labels, "page_id long, bad int")
    return {r["path"]: (r["verdict"], r["template"]) for r in urls.filter_urls(df, marks, []).collect()}


def test_bad_sections_are_found_whatever_their_share_of_pages(spark):
    """A bad part of one section among many pages, and one bad section among thirty equal ones."""
    paths = [f"/shop/casino/{i}" for i in range(32)] + [f"/shop/shoes/{i}" for i in range(48)]
    paths += [f"/{s}/{t}/{i}" for s in ("blog", "forum", "help") for t in ("a", "b", "c") for i in range(100)]
    got = url_verdicts(spark, paths, [(i, int("casino" in p)) for i, p in enumerate(paths) if i % 2 == 0 or "casino" in p])
    assert {p for p, (v, _) in got.items() if v == "block"} == {p for p in paths if "casino" in p}
    paths = [f"/section{chr(97 + s % 26)}{'x' * (s // 26)}/{i}" for s in range(30) for i in range(40)]
    got = url_verdicts(spark, paths, [(i, int(i < 40)) for i in range(len(paths))])
    assert {p for p, (v, _) in got.items() if v == "block"} == set(paths[:40])


def test_parts_under_a_wildcard_are_pooled(spark):
    """Few pages of each member, but what all members' casino pages share is seen."""
    names = [f"m{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100)]
    paths = [f"/user/{n}/{t}" for n in names for t in ("casino", "about", "photos")]
    got = url_verdicts(spark, paths, [(i, int(p.endswith("casino"))) for i, p in enumerate(paths) if i % 5 == 0])
    assert all(v == ("block" if p.endswith("casino") else "allow") for p, (v, _) in got.items())
    assert got["/user/maa/casino"][1] == "/user/*/casino"


def test_templates_match_brute_force(spark):
    import random

    rnd = random.Random(8)
    paths = sorted({"/" + "/".join(rnd.choice(["a", "b", "c", "d", "7", "x9999"]) for _ in range(rnd.randint(0, 4))) for _ in range(3000)})
    rows = [(i, p, int(p.startswith("/a/") or "/c/d" in p or rnd.random() < 0.1)) for i, p in enumerate(paths)]
    df = spark.createDataFrame([("h", p.replace("7", "<n>").replace("x9999", "x<n>"), 1, 1, bad) for _, p, bad in rows], "host string, shaped string, n long, labelled long, bad long")
    df = df.groupBy("host", "shaped").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")])
    got = {r["shaped"]: r["template"] for r in urls.templates(df).collect()}
    known = {r["shaped"]: (r["labelled"], r["bad"]) for r in df.collect()}
    grown = {p: [] for p in known}
    for level in range(max(p.count("/") for p in known) + 1):
        places = collections.defaultdict(lambda: collections.defaultdict(lambda: [0, 0]))
        at = {p: (tuple(grown[p]), p.split("/")[level]) for p in known if p.count("/") >= level}
        for p, (place, s) in at.items():
            if s and "<" not in s:
                places[place][s][0] += known[p][0]
                places[place][s][1] += known[p][1]
        for p, (place, s) in at.items():
            own, n, b = places[place].get(s), sum(v[0] for v in places[place].values()), sum(v[1] for v in places[place].values())
            keep = not s or "<" in s or len(places[place]) == 1
            if not keep and own[0] >= urls.LABELS and 0 < b < n:
                keep = (own[1] - own[0] * b / n) ** 2 / (own[0] * b / n * (1 - b / n)) > urls.APART
            grown[p].append(s if keep else "*")
    assert got == {p: "/".join(g) for p, g in grown.items()}
    assert any("*" in t for t in got.values()) and any(t.startswith("/a/") for t in got.values())


def _letters(rng, n):
    return "".join(rng.choice("bcdfghklmnprstvw") for _ in range(n))


@pytest.fixture(scope="module")
def abuse(spark):
    """Toxic texts with misspelled insults, clean ones that quote insults; training rows and others."""
    rng, filler = random.Random(8), ["the", "town", "council", "met", "again", "on", "water", "roads", "and", "parks", "today", "after", "lunch"]

    def some(n):
        return " ".join(rng.choice(filler) for _ in range(n))

    def misspelled(word):
        at = rng.randint(1, len(word) - 2)
        return word[:at] + rng.choice("xqjz") + word[at + 1 :]

    def rows(n):
        out = []
        for _ in range(n):
            insult = rng.choice(["idiot", "moron", "worthless", "pathetic", "disgusting", "imbecile"])
            out += [(f"{some(12)} you {misspelled(insult)} {some(12)}", 1), (f'{some(12)} he said "{insult}" {some(12)}', 0), (f"{some(25)} {_letters(rng, 7)}", 0)]
        return out

    train, test = rows(150), rows(60)
    model = toxicity.train(spark.createDataFrame(train, "text string, toxic int"))
    return model, test


def right(model, rows):
    matcher = toxicity.Matcher(model.lexicon)
    scores = model.scores(matcher, pa.array([t for t, _ in rows], pa.string()))
    return sum((s >= toxicity.THRESHOLD) == bool(y) for s, (_, y) in zip(scores, rows)) / len(rows)


def test_misspellings_and_contexts_decide(abuse):
    model, rows = abuse
    assert right(model, rows) >= 0.98


def test_without_edits_misspelled_abuse_is_missed(abuse, monkeypatch):
    model, rows = abuse
    monkeypatch.setattr(toxicity, "edits", lambda length: 0)
    assert right(model, [r for r in rows if r[1]]) <= 0.1


def test_without_contexts_quotations_and_abuse_are_alike(abuse, monkeypatch):
    model, rows = abuse
    monkeypatch.setattr(toxicity.Matcher, "_quoted", staticmethod(lambda around, at: False))
    monkeypatch.setattr(toxicity, "ADDRESS", set())
    assert right(model, rows) <= 0.8


def test_every_term_that_qualifies_is_learned(spark):
    rng = random.Random(5)
    marks = [f"{_letters(rng, 12)}{_letters(rng, n)}" for n in (1, 30, 60) for _ in range(400)]
    # every mark stands in ten texts, each time after another word
    texts = [(" ".join(f"{_letters(rng, 6)} {m}" for m in marks[k::20]), 1) for k in range(20) for _ in range(10)]
    texts += [(" ".join(_letters(rng, 6) for _ in range(30)), 0) for _ in range(400)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(texts, "text string, toxic int"))
    covered = toxicity.Trie(lexicon.terms)
    assert all(covered.nearest(m) is not None for m in marks)

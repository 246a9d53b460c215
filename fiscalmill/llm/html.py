"""Main text of web pages: markup says what a block is, a suffix array per host what repeats.

1. A page becomes blocks of text. Menus, headers, footers, sidebars, notices, adverts,
   forms, scripts, styles and reader comments are known by their element, role, class
   or id; a block inside ``article`` or ``main`` is certain, any other one is not.
2. The token streams of a host's pages are put one after another, and a suffix array
   (prefix doubling up to ``RUN`` tokens) shows every run of that many tokens that
   stands on several distinct pages. What such runs cover is boilerplate; runs that
   are the host's only ones stay.
3. A page's text is its certain blocks if they hold most of it: articles are copied
   between pages too, so there a repeat alone is no proof, and the markup decides. A page
   with more unique words in its other blocks (its article is a teaser, or it has none)
   keeps those as well, less the boilerplate.

A name of a class or id counts as a whole: ``has-sidebar`` and ``comments-open`` say what a
part goes with. ``article``, ``main`` and ``body`` are never left out by such names, nor the
header of an article.

Boilerplate is what stands on at least 3 pages and a twentieth of the host's; pages with
equal text count as one. A host with more than ``HOST_PAGES`` pages is dealt into groups of
about that size, which only share the work: a run that stands on a twentieth of the host's
texts does so in at least one group, if each text counts in one group alone. The groups
name such runs by their suffix arrays, all groups count them, and the sums over the host
decide, so the result is that of the host as a whole.

Null or empty html gives an empty text. Null urls share one host. Repeated rows and
ids get a row each. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.llm.common import slices, text_arrays
from fiscalmill.llm.words import word_hashes, word_spans

RUN = 8
HOST_PAGES = 2000
SHARE = 0.05
#: Rows (host, number of groups) of at most so many large hosts are broadcast: a few MB.
FEW_HOSTS = 50_000

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
#: Contents that are no markup, up to their own end tag.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template", "svg", "math", "object", "select", "datalist", "canvas", "audio", "video", "head"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that do not end a block.
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements without main text; ``header`` only outside articles, where it is the page's.
_OUTSIDE = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "fieldset"}
_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
#: Words of a class or id that mark a part outside the main text.
_MARKS = set(
    "nav navbar navigation menu menus submenu header masthead topbar footer foot sidebar sidebars side aside rail cookie cookies consent gdpr notice notices notification "
    "notifications alert banner banners ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored sponsors promo promos promotion promoted outbrain taboola "
    "comment comments commentlist reply replies respond disqus discussion related recommended recommendations share sharing social socials breadcrumb breadcrumbs crumbs newsletter "
    "subscribe subscription signup login signin search searchbox form popup modal overlay widget widgets pagination pager toolbar copyright legal disclaimer skip tags tagcloud".split()
)
#: First and last words of class names that say what a part goes with, not what it is: has-sidebar, tag-legal, comments-open.
_WITH = set("has have no not with without is tag tags category cat type status format single post page".split())
_STATES = set("open opened closed enabled disabled on off active inactive allowed".split())
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _names_a_part(value: str, inside: bool) -> bool:
    """Whether a name of a class or id says that the element is a part outside the main text."""
    for name in value.split():
        words = [w for w in _SPLIT.split(_CAMEL.sub(" ", name).lower()) if w]
        if len(words) > 1 and (words[0] in _WITH or words[-1] in _STATES):
            continue
        found = _MARKS.intersection(words)
        if found - ({"header"} if inside else set()):  # an article's own header holds its headline
            return True
    return False


def _marked(tag: str, attributes: str, inside: bool) -> bool:
    """Whether the element holds something other than main text."""
    if tag in _OUTSIDE or (tag == "header" and not inside):
        return True
    if "=" not in attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        name = name.lower()
        if name == "role" and value.strip().lower() in _ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "main", "article") and _names_a_part(value, inside):
            return True
        if name == "itemtype" and value.rstrip("/").endswith(("Comment", "UserComments", "WPHeader", "WPFooter", "WPSideBar", "SiteNavigationElement")):
            return True
    return False


def blocks(page: str | None) -> list[tuple[str, bool]]:
    """(text, certain) of each block that the markup leaves; white space is one space."""
    out: list[tuple[str, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # element, outside the main text, inside article or main
    at, page, outside, inside = 0, page or "", False, False
    raw = None

    def close():
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((text, inside))
            parts.clear()

    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        if not outside and m.start() > at:
            piece = page[at : m.start()]
            parts.append(html.unescape(piece) if "&" in piece else piece)
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<![CDATA[") and not outside:
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m[1]:
            if tag not in _INLINE:
                close()
            if any(s[0] == tag for s in stack):
                while stack.pop()[0] != tag:
                    pass
                outside, inside = stack[-1][1:] if stack else (False, False)
            continue
        if tag in _RAW:
            close() if tag not in _INLINE else None
            if not m[3].endswith("/"):
                raw = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = raw.end() if raw else (len(page) if tag != "head" else at)
            continue
        if tag not in _INLINE:
            close()
        if tag in _VOID or m[3].endswith("/"):
            continue
        if tag in ("p", "li", "tr", "td", "th", "option", "dt", "dd") and stack and stack[-1][0] == tag:
            stack.pop()  # such an element ends where the next one of its kind begins
            outside, inside = stack[-1][1:] if stack else (False, False)
        now = outside or _marked(tag, m[3], inside)
        within = inside or tag in ("article", "main") or (tag != "body" and "role" in m[3] and re.search(r"role\s*=\s*[\"']?(main|article)\b", m[3]) is not None)
        stack.append((tag, now, within))
        outside, inside = now, within
    if not outside and at < len(page):
        piece = page[at:]
        parts.append(html.unescape(piece) if "&" in piece else piece)
    close()
    return out


def _whole_runs(page: np.ndarray) -> np.ndarray:
    """Where a run of ``RUN`` tokens starts that does not go over the end of its page."""
    n = len(page)
    return np.flatnonzero(page[RUN - 1 :] == page[: n - RUN + 1]) if n >= RUN else np.empty(0, np.int64)


def _covered(starts: np.ndarray, n: int) -> np.ndarray:
    """Which of n tokens lie in a run that starts at one of the places."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + RUN, -1)
    return np.cumsum(change[:-1]) > 0


def frequent(tokens: np.ndarray, page: np.ndarray, least: int) -> np.ndarray:
    """Where the runs of ``RUN`` tokens start that stand on ``least`` distinct pages.

    ``page`` is the page of each token, ascending. Prefix doubling sorts the suffixes
    by their first 1, 2, 4 ... tokens; a run never goes over the end of a page.
    """
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    rank, width = rank.astype(np.int64) + 1, 1
    while width < RUN:
        following = np.zeros(n, np.int64)  # 0: the page ends before
        if n > width:
            same = page[width:] == page[:-width]
            following[:-width][same] = rank[width:][same]
        _, rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + following, return_inverse=True)
        rank, width = rank.astype(np.int64) + 1, width * 2
    whole = _whole_runs(page)
    order = whole[np.lexsort((page[whole], rank[whole]))]  # the suffix array, equal runs by page
    if not len(order):
        return order
    new_run = np.concatenate(([True], np.diff(rank[order]) != 0))
    new_page = new_run | np.concatenate(([True], np.diff(page[order]) != 0))
    run = np.cumsum(new_run) - 1
    pages = np.bincount(run[new_page])
    return order[pages[run] >= least]


def repeated(tokens: np.ndarray, page: np.ndarray, least: int) -> np.ndarray:
    """Which tokens lie in a run of ``RUN`` tokens that stands on ``least`` distinct pages."""
    return _covered(frequent(tokens, page, least), len(tokens))


def run_names(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64 bits for each run, the same in every group."""
    name = np.zeros(len(starts), np.uint64)
    for i in range(RUN):
        name = (name ^ tokens[starts + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        name ^= name >> np.uint64(29)
    return name.view(np.int64)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


_PARSED = "page_id long, url string, host string, texts array<string>, certain array<boolean>"
_MAIN = "page_id long, url string, text string, n_chars long, n_tokens long, n_boilerplate long"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", 4 << 20):
        found = [blocks(page) for page in batch.column("html").to_pylist()]
        texts = pa.array([[t for t, _ in f] for f in found], pa.list_(pa.string()))
        certain = pa.array([[c for _, c in f] for f in found], pa.list_(pa.bool_()))
        names = ["page_id", "url", "host", "texts", "certain"]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), batch.column("host"), texts, certain], names=names)


class _Group:
    """The token streams of a group of a host's pages."""

    def __init__(self, table: pa.Table):
        self.texts, self.certain = table.column("texts").to_pylist(), table.column("certain").to_pylist()
        self.streams = [" ".join(t) for t in self.texts]
        self.data, self.offsets = text_arrays(pa.array(self.streams, pa.large_string()))
        starts, ends, self.first = word_spans(self.data, self.offsets)
        self.tokens = word_hashes(self.data, starts, ends)
        self.page = np.repeat(np.arange(len(self.streams)), np.diff(self.first))
        # of pages with the same text only one counts
        self.of_text = {t: i for i, t in reversed(list(enumerate(self.streams)))}
        self.alike = np.array([self.of_text[t] for t in self.streams], np.int64)

    def least(self) -> int:
        return max(3, math.ceil(SHARE * len(self.of_text)))

    def counting(self, elsewhere: pa.Table, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Tokens and pages of the texts that count here, and their number; those that count in another group are left out."""
        counts = np.zeros(len(self.streams), bool)
        counts[list(self.of_text.values())] = True
        counts &= ~np.isin(names, elsewhere.column("name").to_numpy())
        taken = counts[self.page]
        return self.tokens[taken], self.page[taken], int(counts.sum())


def _text_names(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The distinct texts of a group, by name; none if the group is a whole host."""
    names = table.column("text_name").unique() if table.column("groups")[0].as_py() > 1 else pa.array([], pa.int64())
    return pa.table({"host": _repeat(key[0], len(names)), "part": _repeat(key[1], len(names)), "name": names})


def _repeat(value: pa.Scalar, n: int) -> pa.Array:
    return pa.array([value.as_py()] * n, value.type)


def _candidates(key: tuple[pa.Scalar, ...], table: pa.Table, elsewhere: pa.Table) -> pa.Table:
    """Runs that stand on a twentieth of the texts that count in this group, and how many texts these are."""
    names, groups, n = np.empty(0, np.int64), 0, 0
    if table.num_rows and (groups := table.column("groups")[0].as_py()) > 1:
        group = _Group(table)
        tokens, page, n = group.counting(elsewhere, table.column("text_name").to_numpy())
        names = np.unique(run_names(tokens, frequent(tokens, page, max(1, math.floor(SHARE * n)))))
    rows = len(names) + (n > 0)
    # the row without a name holds the number of texts
    return pa.table(
        {
            "host": _repeat(key[0], rows), "groups": pa.array([groups] * rows, pa.int64()),
            "name": pa.array([*names.tolist(), *[None] * (n > 0)], pa.int64()), "n": pa.array([0] * len(names) + [n] * (n > 0), pa.int64()),
        }
    )


def _counts(key: tuple[pa.Scalar, ...], table: pa.Table, asked: pa.Table) -> pa.Table:
    """On how many of the texts that count in this group each candidate stands."""
    names, n = np.empty(0, np.int64), np.empty(0, np.int64)
    run = asked.column("run").to_numpy(zero_copy_only=False).astype(bool)
    if table.num_rows and run.any():
        group = _Group(table)
        tokens, page, _ = group.counting(asked.filter(pa.array(~run)), table.column("text_name").to_numpy())
        starts = _whole_runs(page)
        found = run_names(tokens, starts)
        of = np.isin(found, asked.column("name").to_numpy()[run])
        pairs = np.unique(np.stack((found[of], page[starts[of]]), axis=1), axis=0)
        names, n = np.unique(pairs[:, 0], return_counts=True)
    return pa.table({"host": _repeat(key[0], len(names)), "name": pa.array(names, pa.int64()), "n": pa.array(n, pa.int64())})


def _decide_whole(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Main texts of a host's pages."""
    return _main_texts(table, None)


def _decide(key: tuple[pa.Scalar, ...], table: pa.Table, runs: pa.Table) -> pa.Table:
    """Main texts of a group of a host's pages; ``runs`` are the host's boilerplate if it has several groups."""
    whole = not table.num_rows or table.column("groups")[0].as_py() == 1
    return _main_texts(table, None if whole else runs.column("name").to_numpy())


def _main_texts(table: pa.Table, runs: np.ndarray | None) -> pa.Table:
    group = _Group(table)
    texts, certain, streams, first, alike = group.texts, group.certain, group.streams, group.first, group.alike
    data, offsets = group.data, group.offsets
    covered = np.zeros(len(group.tokens), bool)
    distinct = alike[group.page] == group.page
    tokens, page = group.tokens[distinct], group.page[distinct]
    if runs is None:
        covered[distinct] = repeated(tokens, page, group.least())
    else:
        starts = _whole_runs(page)
        covered[distinct] = _covered(starts[np.isin(run_names(tokens, starts), runs)], len(tokens))
    main, boilerplate = [], []
    for i, (own, sure) in enumerate(zip(texts, certain)):
        a, b = first[alike[i]], first[alike[i] + 1]
        marks = covered[a:b]
        boilerplate.append(int(marks.sum()))
        words = streams[i].split(" ") if streams[i] else []
        certain_word = np.repeat(np.array(sure, bool), [t.count(" ") + 1 for t in own]) if len(words) == len(marks) else np.zeros(len(marks), bool)
        unique = ~marks & ~certain_word
        if any(sure) and unique.sum() <= certain_word.sum():
            main.append(" ".join(t for t, s in zip(own, sure) if s))
        elif (marks & ~certain_word).any():
            words = data[offsets[i] : offsets[i + 1]].tobytes().split()
            main.append(b" ".join(w for w, k in zip(words, (unique | certain_word).tolist()) if k).decode())
        else:
            main.append(streams[i])
    return pa.table(
        {
            "page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array(main, pa.string()),
            "n_chars": pa.array([len(t) for t in main], pa.int64()), "n_tokens": pa.array(np.diff(first)), "n_boilerplate": pa.array(boilerplate, pa.int64()),
        }
    )


def _boilerplate(grouped: DataFrame) -> DataFrame:
    """(host, part, name): the runs that are boilerplate of each host of several groups, for each of its groups."""
    by_group = lambda df: df.groupBy("host", "part")
    texts = by_group(grouped).applyInArrow(_text_names, "host string, part long, name long")
    first = F.min("part").over(Window.partitionBy("host", "name"))
    elsewhere = texts.withColumn("counts_in", first).where("part > counts_in").select("host", "part", "name")
    found = by_group(grouped).cogroup(by_group(elsewhere)).applyInArrow(_candidates, "host string, groups long, name long, n long")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part")
    asked = found.where("name is not null").select("host", "groups", "name").distinct().select("host", every, "name", F.lit(True).alias("run"))
    asked = asked.unionByName(elsewhere.withColumn("run", F.lit(False)))
    counts = by_group(grouped).cogroup(by_group(asked)).applyInArrow(_counts, "host string, name long, n long")
    total = found.where("name is null").groupBy("host").agg(F.sum("n").alias("texts"), F.max("groups").alias("groups"))
    least = F.greatest(F.lit(3), F.ceil(F.lit(SHARE) * F.col("texts")))
    return counts.groupBy("host", "name").agg(F.sum("n").alias("n")).join(total, "host").where(F.col("n") >= least).select("host", every, "name")


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_tokens, n_boilerplate) of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), "html")
    large = rows.groupBy("host").count().where(F.col("count") > HOST_PAGES).select(F.col("host").alias("large"), F.ceil(F.col("count") / HOST_PAGES).alias("groups"))
    parsed = rows.mapInArrow(_parse, _PARSED)
    # large hosts go to all tasks while they are few, else the pages are dealt by host and again by group; the results are the same
    n_large = large.count()
    few = n_large <= FEW_HOSTS
    grouped = parsed.join(F.broadcast(large) if few else large, F.col("host") == F.col("large"), "left")
    groups = F.coalesce(F.col("groups"), F.lit(1)).cast("long")
    grouped = grouped.withColumn("groups", groups).withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.col("groups")))
    grouped = grouped.select("host", "part", "groups", "page_id", "url", F.xxhash64(F.array_join("texts", " ")).alias("text_name"), "texts", "certain")
    # every step reads the pages as they were dealt once
    grouped = grouped.repartition("host", "part") if n_large else grouped
    if not n_large:
        return grouped.groupBy("host", "part").applyInArrow(_decide_whole, _MAIN)
    runs = _boilerplate(grouped)
    return grouped.groupBy("host", "part").cogroup(runs.groupBy("host", "part")).applyInArrow(_decide, _MAIN)

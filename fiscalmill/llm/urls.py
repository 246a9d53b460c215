"""URL filter by a tree of path templates per host, with DataFrame functions only.

Every path is a branch of its host's tree, which grows level by level: the children of
a place are the segments that follow its template, so what lies under a wildcard is
pooled before it is looked at.

* A segment with a digit run, a long hexadecimal run or an extension after a number
  is a wildcard of that kind (``<n>``, ``<h>``) at once, whatever its values.
* Any other segment of a place stays literal if it is the only one there, or if its
  labelled share differs from that of the place by more than chance would have it (a
  chi-square bound ``APART``, from ``LABELS`` labels on). All others are alike as far as
  labels can tell, and become one branch, ``*``. No share of pages decides.

Templates that differ in their last literal alone are branches of one place; where
their labelled shares differ no more than chance would have it, they are merged and
judged together. A template is rejected when its share of bad labels, smoothed towards
its host's share and that towards the whole table's, is at least ``REJECT``. Explicit
rules come first: the longest that fits decides. The ``LEVELS``-th segment of a path
holds all that follows.

A null url, or one without ``://``, has an empty host and path. Repeated rows and ids
get a row each. Null labels do not count. Without labels nothing is rejected. An
empty table gives an empty result. Hot hosts are aggregated map-side, and joined on
keys that are unique on the other side, so a skewed join can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import stored

REJECT = 0.5
#: Labels that a segment needs to be told from its siblings, and the 99.9th percentile of a chi-square variable with one degree of freedom.
LABELS = 4
APART = 10.83
LEVELS = 12
#: Pages' worth of belief in the host's share, and in the whole table's.
PRIOR = 5.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) after the first ``://``, and the path up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _fits(host: str, path: str) -> Column:
    own = (F.col("host") == host) | F.col("host").endswith("." + host)
    return own & F.col("path").startswith(path)


def rule_of(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (host, path, verdict) that fits host and path, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, own in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest is asked first
        rule = F.when(_fits(host, path), F.lit(host + path)).otherwise(rule)
        verdict = F.when(_fits(host, path), F.lit(own)).otherwise(verdict)
    return rule, verdict


def _shape(segment: Column) -> Column:
    """The wildcard that a segment is by its form, or null."""
    return (
        F.when(segment.rlike(r"^[0-9]+$"), F.lit("<n>"))
        .when(segment.rlike(r"^[0-9]+\.[A-Za-z0-9]+$"), F.concat(F.lit("<n>"), F.regexp_extract(segment, r"(\.[A-Za-z0-9]+)$", 1)))
        .when(segment.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), F.lit("<h>"))
        .when(segment.rlike(r"[0-9]{3,}"), F.regexp_replace(segment, r"[0-9]{3,}", "<n>"))
    )


def shaped(path: Column) -> Column:
    """The path with every segment that is a wildcard by its form written as one."""
    return F.concat_ws("/", F.transform(F.split(path, "/"), lambda s: F.coalesce(_shape(s), s)))


def templates(paths: DataFrame) -> DataFrame:
    """``paths`` (distinct host and shaped path, ``n`` pages) and each one's ``template``.

    Every level is stored before the next one grows on it.
    """
    rows = paths.withColumn("segments", F.split("shaped", "/", LEVELS)).withColumn("template", F.lit(""))
    depth = paths.agg(F.max(F.least(F.size(F.split("shaped", "/", LEVELS)), F.lit(LEVELS))).alias("d")).first()["d"] or 0
    for level in range(depth):
        segment = F.get("segments", F.lit(level))
        formed = segment.rlike("<[nh]>") | (segment == "")
        children = rows.where(segment.isNotNull() & ~formed).groupBy("host", "template", segment.alias("segment"))
        children = children.agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
        places = children.groupBy("host", "template").agg(F.sum("l").alias("pl"), F.sum("b").alias("pb"), F.count("*").alias("siblings"))
        places = places.select(F.col("host").alias("ph"), F.col("template").alias("pt"), "pl", "pb", "siblings")
        share = F.try_divide("pb", "pl")
        distance = F.try_divide(F.pow(F.col("b") - F.col("l") * share, F.lit(2)), F.col("l") * share * (1 - share))
        apart = (F.col("siblings") == 1) | (F.col("l") >= LABELS) & (F.coalesce(distance, F.lit(0.0)) > APART)
        literal = children.join(places, (F.col("host") == F.col("ph")) & (F.col("template") == F.col("pt"))).where(apart)
        literal = literal.select(F.col("host").alias("lh"), F.col("template").alias("lt"), F.col("segment").alias("ls"))
        grown = rows.join(literal, (F.col("host") == F.col("lh")) & (F.col("template") == F.col("lt")) & (segment == F.col("ls")), "left")
        name = F.when(formed | F.col("ls").isNotNull(), segment).otherwise(F.lit("*"))
        longer = name if level == 0 else F.concat(F.col("template"), F.lit("/"), name)
        rows = stored(grown.withColumn("template", F.when(segment.isNull(), F.col("template")).otherwise(longer)).drop("lh", "lt", "ls"), "level")
    return rows.drop("segments")


def judged(paths: DataFrame) -> DataFrame:
    """(host, template, verdict). ``paths`` has host, template, labelled pages and bad ones."""
    leaves = paths.groupBy("host", "template").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("bad"))
    # a template's place: its last literal segment made a wildcard
    place = F.regexp_replace("template", r"(^|/)(?!<[nh]>|\*)[^/]+((?:/(?:<[nh]>[^/]*|\*)?)*)$", "$1*$2")
    leaves = leaves.withColumn("place", place)
    places = leaves.groupBy("host", "place").agg(F.sum("n").alias("pn"), F.sum("bad").alias("pbad"), F.count("*").alias("branches"))
    share = F.try_divide("pbad", "pn")
    joined = leaves.join(places.select(F.col("host").alias("h"), F.col("place").alias("p"), "pn", "pbad", "branches"), (F.col("host") == F.col("h")) & (F.col("place") == F.col("p"))).drop("h", "p")
    apart = F.coalesce(F.try_divide(F.pow(F.col("bad") - F.col("n") * share, F.lit(2)), F.col("n") * share * (1 - share)), F.lit(0.0))
    chi = joined.groupBy("host", "place").agg(F.sum(apart).alias("chi"))
    merged = joined.join(chi.select(F.col("host").alias("h"), F.col("place").alias("p"), "chi"), (F.col("host") == F.col("h")) & (F.col("place") == F.col("p"))).drop("h", "p")
    # about the 95th percentile of a chi-square variable of as many degrees of freedom as branches less one
    alike = F.col("chi") <= (F.col("branches") - 1) + 1.645 * F.sqrt(2.0 * (F.col("branches") - 1)) + 1e-9
    merged = merged.withColumn("jn", F.when(alike, F.col("pn")).otherwise(F.col("n"))).withColumn("jbad", F.when(alike, F.col("pbad")).otherwise(F.col("bad")))
    hosts = leaves.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("bad").alias("hbad"))
    whole = hosts.agg(F.coalesce(F.try_divide(F.sum("hbad"), F.sum("hn")), F.lit(0.0)).alias("all"))
    host_share = (F.col("hbad") + PRIOR * F.col("all")) / (F.col("hn") + PRIOR)
    # one row of totals meets every host
    shares = hosts.join(F.broadcast(whole), F.lit(True)).select(F.col("host").alias("h"), host_share.alias("host_share"))
    scored = merged.join(shares, F.col("host") == F.col("h"))
    smoothed = (F.col("jbad") + PRIOR * F.col("host_share")) / (F.col("jn") + PRIOR)
    return scored.select("host", "template", F.when(smoothed >= REJECT, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, template). ``labels``: (page_id, bad) with bad 1 or 0; several of a page count as the worst."""
    host, path = host_and_path(F.col("url"))
    rule, ruled = rule_of(rules)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), shaped(path).alias("shaped"))
    worst = labels.where(F.col("bad").isNotNull()).groupBy(F.col("page_id").cast("long").alias("labelled")).agg(F.max("bad").cast("long").alias("bad"))
    # pages of one host and shaped path are one row from here on, counted map-side
    counts = rows.groupBy("host", "shaped").agg(F.count("*").alias("n"))
    marks = rows.join(worst, F.col("page_id") == F.col("labelled")).groupBy(F.col("host").alias("h"), F.col("shaped").alias("s")).agg(F.count("*").alias("labelled"), F.sum("bad").alias("bad"))
    paths = counts.join(marks, (F.col("host") == F.col("h")) & (F.col("shaped") == F.col("s")), "left")
    grown = templates(paths.select("host", "shaped", "n", F.coalesce("labelled", F.lit(0)).alias("labelled"), F.coalesce("bad", F.lit(0)).alias("bad")))
    grown = stored(grown, "templates")
    verdicts = judged(grown).select(F.col("host").alias("h"), F.col("template").alias("t"), F.col("verdict").alias("method"))
    known = grown.join(verdicts, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t"))).select(F.col("host").alias("kh"), F.col("shaped").alias("ks"), "template", "method")
    placed = rows.join(known, (F.col("host") == F.col("kh")) & (F.col("shaped") == F.col("ks")), "left")
    return placed.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, F.col("method")).alias("verdict"), "template")

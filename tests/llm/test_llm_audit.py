"""The filter audit against brute force, retraction over micro-batches, and defined results for odd input."""

import collections
import itertools
import random
import re

import pytest
from compare import difference, oracle_connection

from fiscalmill.llm import audit, queries

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, mask string"


def cells(rows, labels):
    """Documents by part, mask and labels."""
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    out = collections.Counter()
    for i, text, part, *_ in rows:
        t, w = text or "", SPACE.findall(text or "")
        fails = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t))]
        fails.append(i is not None and first[t] < i)
        own = [lab for lab in labels if lab[0] == i and i is not None]
        out[part or "", "".join(f for f, bad in zip("ABCDE", fails) if bad), any(lab[1] == 1 for lab in own), any(lab[2] == 1 for lab in own)] += 1
    return out


def by_hand(rows, labels):
    found, out = cells(rows, labels), []
    for part in {k[0] for k in found}:
        own = [(*k[1:], n) for k, n in found.items() if k[0] == part]
        shares, lines = collections.Counter(), []
        for order in itertools.permutations("ABCDE"):
            for s, f in enumerate(order):
                kept = removed = redundant = alone = good = toxic = 0
                for fails, g, x, n in own:
                    gone = any(b in fails for b in order[:s])
                    kept += n * (not gone and f not in fails)
                    removed += n * (not gone and f in fails)
                    redundant += n * (gone and f in fails)
                    alone += n * (fails == f)
                    good += n * (not gone and f in fails and g)
                    toxic += n * (not gone and f in fails and x)
                shares[f] += removed
                lines.append((part, "".join(order), s + 1, kept, removed, redundant, alone, good, toxic, f))
        out += [(*line[:-1], shares[line[-1]]) for line in lines]
    return sorted(out)


def audited(spark, folder, labels, **more):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(map(tuple, audit.audit(spark, str(folder), known, **more).collect()))


def saved(spark, tmp_path, name, *files):
    """A folder with one file for each list of rows, in this order."""
    for rows in files:
        spark.createDataFrame(rows, DOCS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    return tmp_path / name


def test_query_matches_sql(spark, sf_dir):
    assert difference(queries.op13_filter_audit(spark, sf_dir), oracle_connection(sf_dir), queries.ORACLES["op13_filter_audit"]) is None


@pytest.mark.parametrize("batches", [1, 3, 6])
def test_smaller_ids_in_later_files_take_masks_back(spark, tmp_path, batches):
    rnd = random.Random(9)
    texts = ["word " * 60, "One Two THREE", "a#b", "", None, " ".join(f"w{i}" for i in range(70)), "x\x0by\x0cz"]
    ids = list(range(300))
    rnd.shuffle(ids)
    rows = [(i, rnd.choice(texts), rnd.choice(["p", "q", None]), "m") for i in ids]
    files = [rows[i::6] for i in range(6)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 300, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (6, None, None)]
    labels = [(i, q, None if x is None else int(x)) for i, q, x in labels]
    folder = saved(spark, tmp_path, "docs", *files)
    assert audited(spark, folder, labels, batches=batches) == by_hand(rows, labels)


def test_falling_ids_are_retracted_in_every_batch(spark, tmp_path, monkeypatch):
    """The counters written by a later batch hold negative numbers."""
    monkeypatch.setattr(audit, "BUCKET", 1)
    files = [[(30, "same text", "p", "m")], [(20, "same text", "q", "m")], [(10, "same text", "p", "m")]]
    folder = saved(spark, tmp_path, "falling", *files)
    written = {}
    real = audit.scratch_dir
    monkeypatch.setattr(audit, "scratch_dir", lambda spark, label: written.setdefault(label, real(spark, label)))
    counts = audit.counters(spark, str(folder), spark.createDataFrame([], "doc_id long, quality int, toxic int"), batches=3)
    found = sorted((r["part"], r["mask"], r["n"]) for r in counts.collect())
    assert sorted(found) == sorted([("p", 1, 1), ("p", 1 | audit.LATER, 1), ("q", 1 | audit.LATER, 1)])
    changes = spark.read.parquet(written["counters"])
    assert changes.select("batch").distinct().count() >= 2 and changes.where("n < 0").count() >= 1


def test_odd_rows(spark, tmp_path):
    same = "alpha beta"
    rows = [
        (None, same, "p", "m"), (None, same, "p", "m"), (3, same, "p", "m"), (3, same, "q", "m"), (3, same, "p", "m"), (5, same, None, "m"),
        (1, None, "p", "m"), (2, "", "p", "m"), (None, None, None, "m"), (-4, "", "", "m"), (9, "LONG " * 20000, "p", "m"), (8, "LONG " * 20000, "p", "m"),
    ]
    folder = saved(spark, tmp_path, "odd", rows[:5], rows[5:9], rows[9:])
    assert audited(spark, folder, [(3, 1, 0), (3, 0, 1)]) == by_hand(rows, [(3, 1, 0), (3, 0, 1)])
    assert audited(spark, saved(spark, tmp_path, "none", []), []) == []


def test_settings_come_back(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    audited(spark, saved(spark, tmp_path, "one", [(1, "x", "p", "m")]), [])
    assert (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)) == before


def test_hot_text_moves_few_rows(spark):
    """Of ten thousand copies a task passes on one row that asks for state."""
    docs = spark.range(10000).selectExpr("id as doc_id", "'same' as text", "'p' as source")
    rows = audit.with_labels(audit.masked(docs), spark.createDataFrame([], "id long, good boolean, toxic boolean"))
    folded = rows.coalesce(1).mapInArrow(audit.fold, audit._FOLDED).collect()
    assert len(folded) <= 4 and sum(r["n"] for r in folded) == 10000 and sum(r["asks"] for r in folded) <= 2

"""Hard negatives against brute force, the bounds of the trees, and defined results for odd input."""

import math
import random

import numpy as np
import pytest
from compare import difference, oracle_connection

from fiscalmill.llm import negatives, queries

SCHEMA = "vec_id long, vec array<double>, label long, cell string"


def by_hand(rows, is_anchor, positives=5, negs=10):
    """Whole rows in Python integers; an anchor row that is repeated counts once."""
    known = [
        (i, [math.floor(256 * x) for x in v], y)
        for i, v, y, *_ in rows
        if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)
    ]
    out = []
    for a, va, ya in sorted({(i, tuple(v), y) for i, v, y in known if is_anchor(i)}):
        scored = sorted((-sum(p * q for p, q in zip(va, v)), i, y) for i, v, y in known if i != a and len(v) == len(va))
        for s, p, _ in [x for x in scored if x[2] == ya][:positives]:
            fits = [(n, i) for n, i, y in scored if y != ya and 30 * -s <= 100 * -n <= 90 * -s][:negs]
            out += [(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, is_anchor, **more):
    return sorted(map(tuple, negatives.mine(spark.createDataFrame(rows, SCHEMA), is_anchor, **more).collect()))


def clusters(n, dim, seed=5):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, dim))
    rows = centres[rnd.integers(0, 12, n)] + 0.2 * rnd.normal(size=(n, dim))
    return rows * rnd.uniform(0.5, 2, (n, 1))


def test_query_matches_sql(spark, sf_dir):
    assert difference(queries.op12_hard_negatives(spark, sf_dir), oracle_connection(sf_dir), queries.ORACLES["op12_hard_negatives"]) is None


@pytest.mark.parametrize("shard,leaf,block", [(40, 8, 7), (64, 16, 1000)])
def test_matches_brute_force_over_many_trees_and_blocks(spark, monkeypatch, shard, leaf, block):
    monkeypatch.setattr(negatives, "SHARD", shard)
    monkeypatch.setattr(negatives, "TASK_ROWS", 3 * shard)
    monkeypatch.setattr(negatives, "LEAF", leaf)
    rnd = random.Random(2)
    rows = [(i, v.tolist(), rnd.randrange(4), "x") for i, v in enumerate(clusters(900, 6))]
    assert mined(spark, rows, lambda i: i % 50 == 0, block=block) == by_hand(rows, lambda i: i % 50 == 0)


def test_ties_copies_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD", 32)
    monkeypatch.setattr(negatives, "TASK_ROWS", 64)
    monkeypatch.setattr(negatives, "LEAF", 4)
    rnd = random.Random(4)
    rows = [(i, [0.5, -0.25, 0.125] if i % 3 == 0 else [rnd.choice([-0.5, 0.25, 0.5]) for _ in range(3)], i % 2, "x") for i in range(400)]
    assert mined(spark, rows, lambda i: i % 20 == 0) == by_hand(rows, lambda i: i % 20 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1, "a"), (0, [1.0, 2.0], 1, "a"), (0, [2.0, 1.0], 1, "b"), (None, [1.0, 2.0], 1, "c"),
        (1, [0.5, 0.5], 1, "d"), (2, [0.25, 0.5], 2, "e"), (2, [0.25, 0.25], 2, "f"), (3, None, 1, "g"), (4, [nan, 1.0], 2, "h"),
        (5, [inf, 1.0], 2, "i"), (6, [None, 1.0], 2, "j"), (7, [0.1, 0.2], None, "k"), (8, [0.0, 0.0], 2, "l"), (9, [0.3], 2, "m"),
        (10, [0.4], 1, "n"), (0, [0.7], 1, "o"), (11, [], 1, "p"), (0, [], 1, "q"), (12, [], 2, "r"), (13, [-1.0, -1.0], 1, "s"),
        (14, [1e307, 1.0], 2, "t"),
    ]
    assert mined(spark, rows, lambda i: i % 10 == 0) == by_hand(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows[:0], lambda i: i % 10 == 0) == []
    assert mined(spark, rows[-1:], lambda i: i % 10 == 0) == []


def test_huge_components_do_not_fail(spark):
    rows = [(i, [10.0 ** (30 * i), 1.0], i % 2, "x") for i in range(6)]
    assert all(abs(r[4]) < 2**63 and abs(r[5]) < 2**63 for r in mined(spark, rows, lambda i: i.isNotNull()))


def test_cover_tree_bounds_hold_and_prune():
    rows = np.floor(256 * clusters(3000, 5))
    tree = negatives.CoverTree(rows)

    def members(node):
        return np.concatenate([members(c) for c in node.children]) if node.children else node.rows

    def check(node, anchors, squares):
        held = members(node)
        lower, upper = tree.bounds(anchors, squares, [node])
        products = anchors @ rows[held].T
        assert (products >= lower).all() and (products <= upper).all()
        for child in node.children:
            assert child.radius <= node.radius + 2 * tree.slack
            check(child, anchors, squares)

    anchors = rows[::300]
    check(tree.root, anchors, (anchors**2).sum(axis=1))
    assert sorted(members(tree.root).tolist()) == list(range(3000))
    ids, labels = np.arange(3000), np.zeros(3000, np.int64)
    every = np.full((1, 1), np.inf)
    search = negatives.Search(rows[:1], np.array([-1]), labels[:1], True, -every, every, 5)
    search.tree(tree, ids, labels)
    order = np.lexsort((ids, -(rows @ rows[0])))[:5]
    assert search.found[0].tolist() == order.tolist()
    assert search.visited < 1500  # most leaves are never looked into

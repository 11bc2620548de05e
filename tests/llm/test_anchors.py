"""Hard negatives and their bounds against scoring every row."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from edgeledger.llm import anchor_tree
from edgeledger.llm.anchor_tree import Bounds, hard_negatives, products, spanning_tree

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows):
    """The contract, row by row."""
    seen = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        seen.setdefault(i, []).append((label, [math.floor(256 * float(np.float32(x))) for x in v]))
    items = [(i, *min(found)) for i, found in sorted(seen.items())]
    out = []
    for a, la, va in items:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, vb)), b, lb) for b, lb, vb in items if b != a)
        for ps, p, _ in [s for s in scored if s[2] == la][:5]:
            hits = [(n, -ns) for ns, n, ln in scored if ln != la and 50 * -ps <= 100 * -ns <= 95 * -ps]
            out += [(a, p, k, n, -ps, s) for k, (n, s) in enumerate(hits[:3], 1)]
    return sorted(out)


def got(frame):
    return sorted(tuple(r[n] for n in NAMES) for r in frame.collect())


def clustered(n, seed, width=8, labels=4, step=10):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    return [(k * step, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)], rng.randrange(labels)) for k in range(n)]


def ties(n):
    """Few distinct vectors, one of them in a third of all rows."""
    rng = random.Random(3)
    shapes = [[1.0, 0.0, 0.5], [0.5, 0.5, 0.0], [-0.5, 0.25, 1.0], [0.75, 0.0, 0.5]]
    return [(k * 5, shapes[0] if k % 3 == 0 else rng.choice(shapes), rng.randrange(3)) for k in range(n)]


ODD = [
    (None, [1.0, 1.0], 1), (50, None, 1), (100, [1.0, None], 1), (150, [float("nan"), 1.0], 1), (200, [float("inf"), 0.0], 2),
    (250, [0.1, 0.2], None), (300, [], 1), (350, [0.5, 0.5], 9), (351, [0.5, 0.4, 0.9], 0), (352, [0.4, 0.4], 0), (353, [0.3, 0.3], 4),
    (353, [0.3, 0.3], 4), (354, [0.3, 0.31], 4), (354, [0.2, 0.2], 5), (-50, [0.6, 0.5], 0), (-7, [0.5, 0.55], 9), (-8, [0.3, 0.4], 3), (0, [0.0, 0.0], 3),
]


@pytest.mark.parametrize("rows", [clustered(400, 1), clustered(300, 2, labels=2, step=25), ties(200), ODD, ODD + clustered(60, 4, width=2)])
def test_against_every_row(spark, rows):
    assert got(hard_negatives(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_small_trees_and_groups(spark, monkeypatch):
    for name, value in (("TREE_ANCHORS", 6), ("GROUP_ANCHORS", 10), ("GROUP_ROWS", 20)):
        monkeypatch.setattr(anchor_tree, name, value)
    rows = clustered(300, 5, labels=7, step=25)
    assert got(hard_negatives(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_large_components_are_exact(spark):
    rng = random.Random(6)
    rows = [(k * 25, [rng.choice([-1, 1]) * rng.uniform(2e5, 2.6e5) for _ in range(12)], k % 2) for k in range(40)] + [(7, [3e38] * 12, 1)]
    assert got(hard_negatives(spark.createDataFrame(rows, SCHEMA))) == plain(rows[:-1])


def test_empty_and_clashing(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = clustered(60, 8)
    more = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as tree", "2 as anchor_id", "3 as vector", "4 as rows_of", "5 as score", "6 as id")
    assert got(hard_negatives(more)) == plain(rows)


def test_tree_is_minimal():
    rng = np.random.default_rng(2)
    points = rng.integers(-500, 500, (40, 3))
    order, parent, edge = spanning_tree(points)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and all(parent[1:] < np.arange(1, 40))
    # by brute force: edges in order of length, each taken if it joins two parts
    part, total = list(range(40)), 0.0
    for d, i, j in sorted((np.linalg.norm(points[i] - points[j]), i, j) for i in range(40) for j in range(i)):
        if part[i] != part[j]:
            part, total = [part[i] if p == part[j] else p for p in part], total + d
    assert edge.sum() == pytest.approx(total)
    assert [edge[k] for k in range(1, 40)] == pytest.approx([np.linalg.norm(points[order[k]] - points[order[parent[k]]]) for k in range(1, 40)])


def test_bounds_hold_without_scores():
    rng = np.random.default_rng(3)
    rows, anchors = rng.integers(-300, 300, (500, 16)), rng.integers(-300, 300, (30, 16))
    order, parent, edge = spanning_tree(anchors)
    anchors, bounds = anchors[order], None
    bounds = Bounds(rows, anchors, parent, edge)
    for k in range(30):
        low, high = bounds.at(k)
        exact = products(rows, anchors[k])
        assert (low <= exact).all() and (exact <= high).all()
        bounds.done(low, high)
    assert bounds.scored == 500  # the root alone


def test_near_anchors_save_scores():
    rng = np.random.default_rng(4)
    centre = rng.integers(-200, 200, 16)
    anchors = centre + rng.integers(-2, 3, (50, 16))
    rows = pa.table({"vec_id": np.arange(1, 2001) * 3, "label": np.arange(2000) % 2, "vector": list(rng.integers(-200, 200, (2000, 16)).astype(np.int32))})
    order, parent, edge = spanning_tree(anchors)
    tree = pa.table({
        "tree": ["t"] * 50, "place": np.arange(50, dtype=np.int32), "parent": parent.astype(np.int32), "edge": edge,
        "anchor_id": order * 50, "label": np.zeros(50, np.int64), "vector": list(anchors[order].astype(np.int32)),
    })
    kept = []
    original = Bounds.score
    try:
        Bounds.score = lambda self, k, chosen, low, high: kept.append(len(chosen)) or original(self, k, chosen, low, high)
        assert len(list(anchor_tree.positives_in(rows, tree, 5))) == 250
    finally:
        Bounds.score = original
    assert sum(kept[1:]) < 0.2 * 49 * 1000

"""Hard negatives against brute force: ties, NULLs, odd lengths, large components, many trees."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import hard_negatives as hard
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<double>, label int, tree string, score int"


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    got = hard.mine_hard_negatives(hard.prepared(df), F.col("id") % 50 == 0, **more).collect()
    assert len(got) == len(set(map(tuple, got)))
    return {tuple(r) for r in got}


def whole(rows):
    """What takes part: distinct, components as integers held at 64 bits."""
    cut = lambda x: max(-2 ** 63, min(2 ** 63 - 1, math.floor(256 * x) if abs(256 * x) < float(
        "inf") else int(math.copysign(2 ** 63, x))))
    taken = [(i, tuple(map(cut, v)), c) for i, v, c in rows if c is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)]
    return list(dict.fromkeys(taken))


def clusters(n, dim, seed=3, labels=4):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    out = []
    for k in range(n):
        c = r.randrange(labels)
        v = [x + r.gauss(0, .4) for x in centres[c]]
        out.append((k, v, c if r.random() < .7 else r.randrange(labels)))
    return out


def test_hard_rows(spark):
    rows = clusters(300, 6)
    rows += [(1000, None, 1), (1050, [1.0] * 6, None), (1100, [1.0, None] + [0.0] * 4, 1),
             (1150, [float("nan")] * 6, 1), (1200, [float("inf")] * 6, 1), (None, rows[0][1], 0),
             (None, rows[1][1], 1), (1250, [], 2), (1300, [0.5, 0.5], 2), (1350, [0.0] * 6, 9),
             (1400, [.3] * 9, 3), (-50, rows[2][1], 1), (1450, [-1.0] * 6, 7)]
    rows += rows[:20] + [(50, rows[60][1], 2)] + [(2000 + k, rows[5][1], k % 3) for k in range(40)]
    want = brute.hard_negatives(whole(rows))
    assert mined(spark, rows) == want and len(want) > 50


@pytest.mark.parametrize("factor", [2.0 ** 24, 1e30])
def test_large_components(spark, factor):
    """Scores beyond 2^53 are exact; components and scores beyond 64 bits are held."""
    rows = [(i * 10, [x * factor for x in v], c) for i, v, c in clusters(40, 3, 8)]
    assert mined(spark, rows) == brute.hard_negatives(whole(rows))


def test_many_trees_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(hard, "ROUND_BYTES", 40_000)  # of trees; each has up to 256 * 8 * 8 bytes
    rows = [(i * 10, v, c) for i, v, c in clusters(4000, 8, 5)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    trees = hard.plant_trees(hard.prepared(df).filter("id % 50 = 0")).collect()
    assert sum(len(t["ids"]) for t in trees) == 800 and max(t["round"] for t in trees) > 0
    values = np.array([[math.floor(256 * x) for x in r[1]] for r in rows])
    ids, labels = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    want = set()
    for k in np.flatnonzero(ids % 50 == 0):
        s = values @ values[k]
        order = np.lexsort((ids, -s))
        same = [j for j in order if labels[j] == labels[k] and j != k][:5]
        other = order[labels[order] != labels[k]]
        for p in same:
            hit = other[(50 * s[p] <= 100 * s[other]) & (100 * s[other] <= 95 * s[p])][:3]
            want |= {(int(ids[k]), int(ids[p]), r + 1, int(ids[j]), int(s[p]), int(s[j]))
                     for r, j in enumerate(hit)}
    assert mined(spark, rows) == want


def test_bounds_hold_and_spare_work():
    """Down the tree every score lies within its bounds, and most rows are not scored again."""
    import pyarrow as pa
    rows = clusters(3000, 16, 9, labels=12)
    v = np.array([[math.floor(256 * x) for x in r[1]] for r in rows])
    anchors = v[::50]
    order, parents, edges = hard.spanning_tree(anchors)
    row = {"tree": 0, "ids": list(range(len(order))), "labels": [0] * len(order),
           "parents": parents, "edges": edges, "wide": 16,
           "vectors": anchors[order].astype(np.int64).tobytes()}
    tree = hard._Tree(row)
    block = hard._Block(pa.array(range(3000)), pa.array([1] * 3000), v, tree.longest)
    asked = []

    def wanted(place, low, high):
        exact = v @ anchors[order[place]]
        assert (low <= exact + 1e-6).all() and (exact <= high + 1e-6).all()
        some = np.flatnonzero(high >= np.sort(exact)[-3])  # the first three
        asked.append(len(some))
        return some

    for place, some, scores in tree.visit(block, wanted):
        assert (scores == v[some] @ anchors[order[place]]).all()
    assert sum(asked) < 0.7 * 3000 * len(order)


def test_empty(spark):
    assert mined(spark, [(1, [1.0], 1)][:0]) == set()
    assert mined(spark, [(50, [1.0], 1)]) == set()
    assert mined(spark, [(None, None, None)] * 3) == set()

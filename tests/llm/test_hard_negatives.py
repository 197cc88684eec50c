import math
import random

import numpy as np
from pyspark.sql import functions as F

from sheetdoc.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, id long, tie string, vector int, rank int, score long"


def plain(rows):
    """Expected rows by brute force in whole numbers."""
    kept = []
    for key, v, label in dict.fromkeys((k, None if v is None else tuple(v), l) for k, v, l in rows):
        if key is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((key, tuple(math.floor(256 * x) for x in v), (label + 1) % 10 if key % 7 == 0 else label))
    kept = list(dict.fromkeys(kept))
    out = []
    for a in kept:
        if a[0] % 50:
            continue
        scored = [(sum(x * y for x, y in zip(a[1], b[1], strict=True)), b) for b in kept if b is not a and len(b[1]) == len(a[1])]
        order = sorted((s for s in scored if -(2**63) <= s[0] < 2**63), key=lambda s: (-s[0], s[1][0]))
        for p, pos in [s for s in order if s[1][2] == a[2]][:5]:
            fit = [(n, b) for n, b in order if b[2] != a[2] and 50 * p <= 100 * n <= 95 * p][:3]
            out += [(a[0], pos[0], i + 1, b[0], p, n) for i, (n, b) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "t", 2, 3, 4) for r in rows], SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in hn.mine(hn.prepare(frame, label), F.col("id") % 50 == 0).collect())


def vectors(n, d, seed, spread=0.35):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, d))
    x = centres[r.integers(0, 12, n)] + spread * r.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1)[:, None] * r.uniform(0.3, 1.2, n)[:, None]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 300)
    monkeypatch.setattr(hn, "CHUNK", 10)
    r = random.Random(1)
    rows = [(i, v.tolist(), r.randrange(10) if i % 3 else 4) for i, v in enumerate(vectors(1400, 16, 5))]
    rows += [(2000 + i, rows[50][1], i % 10) for i in range(150)]  # a group of copies, anchors and ties among them
    rows += [rows[0], rows[0], (None, rows[1][1], 1), (5000, None, 1), (5050, [1.0] * 16, None), (5100, [None] + [1.0] * 15, 2),
             (5150, [float("nan")] * 16, 2), (5200, [float("inf")] * 16, 2), (5250, [0.0] * 16, 2), (5300, [], 1), (5301, [0.5, 1.0], 3),
             (5350, [0.5, 0.25], 3), (5351, [0.25, 0.25], 4), (5400, [-1.0] * 16, 3), (5450, [4e9] * 16, 3), (5451, [3e9] + [2e9] * 15, 3), (5452, [2e9] * 16, 5)]
    assert mined(spark, rows) == plain(rows)


def test_empty_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_bounds_hold_and_nodes_are_skipped():
    x = np.floor(256 * vectors(4000, 8, 7, 0.02))
    tree = hn.CoverTree.build(x, np.arange(4000) % 10, np.arange(4000), np.arange(4000))
    q = np.floor(256 * vectors(30, 8, 8))
    norms = np.sqrt((q * q).sum(axis=1))
    low, high = tree.bounds(q / norms[:, None], norms, np.arange(len(tree.lo)))
    for k in range(len(tree.lo)):
        s = q @ tree.points[tree.lo[k] : tree.hi[k]].T
        assert (s.min(axis=1) >= low[:, k]).all() and (s.max(axis=1) <= high[:, k]).all()
    leaves = np.flatnonzero(tree.first == tree.last)
    assert sorted(np.concatenate([np.arange(tree.lo[k], tree.hi[k]) for k in leaves])) == list(range(4000))
    seen = []
    verify = hn.exact_scores
    hn.exact_scores = lambda a, p: seen.append(len(a) * len(p)) or verify(a, p)
    try:
        ends = np.full((30, 1), np.inf)
        hn.search(tree, q, np.zeros(30), -np.ones(30), -ends, ends, 5, False)
    finally:
        hn.exact_scores = verify
    assert sum(seen) < 30 * 4000 / 3


def test_huge_numbers_stay_exact():
    a, b = np.array([[2.0**40, 1.0]]), np.array([[2.0**40, 3.0], [2.0**40, 2.0]])
    assert hn.exact_scores(a, b).tolist() == [[2**80 + 3, 2**80 + 2]]

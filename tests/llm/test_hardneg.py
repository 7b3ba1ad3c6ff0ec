"""Hard negatives against brute force, and on odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orolith.llm import hardneg


def brute(rows, positives=5, negatives=3):
    """rows: (vec_id, label, vector). Every row is one of its own."""
    last = lambda i: (i is None, i or 0)
    valid = [(i, g, [int(np.floor(256 * x)) for x in v]) for i, g, v in rows if g is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for k, (i, g, v) in enumerate(valid):
        if i is None or i % 50:
            continue
        scored = sorted(((-dot(v, w), last(j), j, h) for m, (j, h, w) in enumerate(valid) if m != k), key=lambda t: t[:2])
        for s, _, j, h in [t for t in scored if t[3] == g][:positives]:
            fit = [t for t in scored if t[3] != g and 50 * -s <= 100 * -t[0] <= 95 * -s]
            out += [(i, j, r, t[2], -s, -t[0]) for r, t in enumerate(fit[:negatives], 1)]
    return sorted(out, key=str)


def run(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("score", F.lit("clash"))
    return sorted((tuple(r) for r in hardneg.hard_negatives(frame, F.col("vec_id") % 50 == 0).collect()), key=str)


@pytest.mark.parametrize("block,first", [(7, 1), (1024, 8)])
def test_ties_copies_and_clusters(spark, monkeypatch, block, first):
    monkeypatch.setattr(hardneg, "BLOCK", block)
    monkeypatch.setattr(hardneg, "CHUNK", 3)
    monkeypatch.setattr(hardneg, "FIRST", first)
    monkeypatch.setattr(hardneg, "GROWTH", 2)
    rng = np.random.default_rng(block)
    centers = rng.normal(size=(6, 5))
    rows = []
    for i in range(400):
        v = centers[i % 6] + 0.3 * rng.normal(size=5) if i % 3 else np.round(centers[i % 6])  # a third are copies
        rows.append((int(i * 5), int(rng.integers(0, 3)), [float(x) for x in v]))
    rows += [rows[10], rows[20], rows[20], (None, 1, rows[3][2]), (None, 2, rows[5][2])]  # repeated rows, of anchors too, and null ids
    assert run(spark, rows) == brute(rows)


def test_invalid_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.8, 0.0]), (3, 2, [0.7, 0.2]), (4, 3, [0.0, 0.0])]
    bad = [(50, None, [1.0, 0.0]), (100, 1, None), (150, 1, [nan, 0.0]), (200, 2, [inf, 0.0]), (250, 2, [None, 1.0])]
    assert run(spark, good + bad) == brute(good) != []
    assert run(spark, good[:1]) == [] and run(spark, []) == [] and run(spark, bad) == []
    short = [(0, 1, [1.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.9]), (3, 2, [])]
    padded = [(i, g, v + [0.0] * (2 - len(v))) for i, g, v in short]
    assert run(spark, short) == brute(padded) != []


def test_scores_beyond_doubles(spark):
    rng = np.random.default_rng(2)
    rows = [(i * 25, i % 2, [float(np.float32(x)) for x in rng.normal(size=4) * 1e6]) for i in range(30)]
    assert run(spark, rows) == brute(rows) != []
    assert max(r[4] for r in run(spark, rows)) > 1 << 53


def test_few_rings_are_scanned(spark):
    """Where vectors lie in tight clusters, the bounds leave most rings out."""
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, 8)) * 4
    x = np.floor(256 * (centers[rng.integers(0, 40, 8000)] + 0.02 * rng.normal(size=(8000, 8)))).astype(np.int64)
    space = hardneg.Space(x[:1024], int((x * x).sum(1).max()), len(x))
    away = space.apart(x, space.pivots)
    pivot, key = away.argmin(1), away.min(1)
    rings = [{"ring": p * hardneg.RINGS, "low": key[pivot == p].min(), "high": key[pivot == p].max(), "deals": 1} for p in range(len(space.pivots)) if (pivot == p).any()]
    search = hardneg.Search(space, rings, False, 5, 5, 50, 95)
    q = x[:50]
    top, bottom = search.bounds(q)
    scores = space.scores(q, x)
    for k, r in enumerate(rings):
        inside = scores[:, pivot == r["ring"] // hardneg.RINGS]
        assert (inside.max(1) <= top[:, k]).all() and (inside.min(1) >= bottom[:, k]).all()
    fifth = np.sort(scores, axis=1)[:, -5]
    assert (top >= fifth[:, None]).mean() < 0.35

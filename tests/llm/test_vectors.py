"""Hard-negative mining against brute force in Python's integers."""

import math
import random

import numpy as np
import pytest

from visitlens.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=50, positives=5, negatives=3):
    last = (1 << 63) - 1
    used = [
        (last if i is None else i, label, [math.floor(256 * x) for x in vector])
        for i, vector, label in rows
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    out = []
    for i, label, vector in used:
        if i == last or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, other)), j, own) for j, own, other in used]
        same = sorted((s, j) for s, j, own in scored if own == label and j != i)[:positives]
        for s, j in same:
            fits = sorted((t, k) for t, k, own in scored if own != label and -50 * s <= -100 * t <= -95 * s)
            for rank, (t, k) in enumerate(fits[:negatives], 1):
                out.append((i, None if j == last else j, rank, None if k == last else k, -s, -t))
    return sorted(out, key=repr)


def found(spark, rows, schema=SCHEMA, **settings):
    return sorted(map(tuple, hard_negatives.mined(spark.createDataFrame(rows, schema), **settings).collect()), key=repr)


def vectors(seed, n, width=6, size=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, size) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        rows.append((i, [c + rng.gauss(0, size / 3) for c in centre], rng.randrange(3)))
    return rows


@pytest.mark.parametrize("anchors,tile", [(131_072, (256, 2048)), (3, (2, 5))])
def test_matches_brute_force(spark, monkeypatch, anchors, tile):
    """One block of anchors and many, large and small tiles; ties, repeats and rows that take no part."""
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", tile[0])
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", tile[1])
    monkeypatch.setattr(hard_negatives, "FIRST_ROWS", min(tile[1], 128))
    rows = vectors(1, 300)
    hot = rows[10][1]
    rows += [(i, hot, 1 if i % 3 else 2) for i in range(300, 420)]
    rows += [(50, rows[50][1], 1), (50, rows[51][1], 2), (350, hot, 1), (350, hot, 1)]
    rows += [(None, hot, 1), (None, rows[3][1], 2), (500, None, 1), (550, hot, None), (600, [0.0] * 6, 1)]
    rows += [(650, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (700, [math.inf] * 6, 1), (750, [math.nan] * 6, 1)]
    rows += [(800, [], 1), (801, [], 2), (850, hot[:3], 1), (851, hot + [7.0], 2)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("size", [0.01, 300.0, 1e6])
def test_components_of_any_size(spark, size):
    rows = vectors(2, 150, size=size)
    assert found(spark, rows) == brute(rows)


def test_packed_products_are_exact():
    rng = np.random.default_rng(3)
    for size in (0, 1, 300, 1e5, 1e9, 1e12):
        anchors, rows = (np.floor(rng.normal(size=(n, 16)) * size) for n in (5, 11))
        wanted = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in rows] for x in anchors]
        bounds = hard_negatives.LEAST + 1, hard_negatives.LAST
        assert hard_negatives.packed_scores(anchors, rows).tolist() == [[min(max(s, bounds[0]), bounds[1]) for s in r] for r in wanted]


def test_no_anchors_and_clashing_columns(spark):
    assert found(spark, []) == []
    assert found(spark, [(i, [1.0], 1) for i in range(1, 40)]) == []
    rows = [(*row, 5, "x") for row in vectors(4, 120)]
    clashing = SCHEMA + ", score int, anchor string"
    assert found(spark, rows, clashing) == brute([row[:3] for row in rows])

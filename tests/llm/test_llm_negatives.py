"""Hard negatives against a plain search, with ties, copies, odd vectors and several cells."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ctrprep.llm import negatives
from ctrprep.llm.negatives import Cell, _OtherLabel, _SameLabel, hard_negatives, walk


def plainly(rows, anchors):
    usable = []
    for vec, body, label in dict.fromkeys((v, None if b is None else tuple(b), k) for v, b, k in rows):
        if label is not None and body is not None and all(x is not None and math.isfinite(x) for x in body):
            usable.append((vec, tuple(math.floor(256 * float(np.float32(x))) for x in body), label))
    usable = list(dict.fromkeys(usable))
    out = []
    for a in usable:
        if a[0] is None or a[0] % anchors:
            continue
        scored = [(-sum(x * y for x, y in zip(a[1], b[1])), b[0] is None, b[0] or 0, b) for b in usable if b is not a and len(b[1]) == len(a[1])]
        scored.sort(key=lambda s: s[:3])
        for p in [s for s in scored if s[3][2] == a[2]][:5]:
            fits = [s for s in scored if s[3][2] != a[2] and -30 * p[0] <= -100 * s[0] <= -90 * p[0]][:10]
            out += [(a[0], p[3][0], k, s[3][0], -p[0], -s[0]) for k, s in enumerate(fits, 1)]
    return sorted(out, key=str)


def found(spark, rows, anchors=10, **more):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = hard_negatives(table, F.col("vec_id") % anchors == 0, F.col("label"), **more)
    return sorted(map(tuple, got.collect()), key=str)


def around(rng, centres, n, size):
    return [(rng.choice(len(centres)), rng.normal(size=size) * 0.25) for _ in range(n)]


@pytest.mark.parametrize("cell_rows", [7, 60, 10_000])
def test_equal_to_a_plain_search(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(negatives, "FIRST_STEP", 4)
    monkeypatch.setattr(negatives, "CHUNK", 5)
    rng = np.random.default_rng(cell_rows)
    centres = rng.normal(size=(6, 5))
    rows = [(k, [float(x) for x in centres[c] + d], int(rng.integers(0, 3))) for k, (c, d) in enumerate(around(rng, centres, 150, 5))]
    # Ties: equal vectors under many ids, in several labels.
    rows += [(200 + k, [0.5, 0.5, 0.5, 0.5, 0.5], k % 3) for k in range(40)]
    assert found(spark, rows, cell_rows=cell_rows) == plainly(rows, 10)


def test_odd_rows(spark):
    vector = [0.3, -0.2, 0.9]
    rows = [(k, [x + k / 100 for x in vector], k % 2) for k in range(30)]
    rows += [(10, [11.0 / 100 + x for x in vector], 0), (0, vector, 0), (0, vector, 0), (None, vector, 0), (None, vector, 1)]
    rows += [(40, None, 0), (50, [1.0, float("nan"), 0.0], 1), (60, [1.0, None, 2.0], 1), (70, vector, None), (80, [], 1), (81, [], 0)]
    rows += [(90, [0.0, 0.0, 0.0], 0), (91, [1.0, 2.0], 0), (100, [1.0, 2.0], 0), (101, [0.8, 1.0], 1), (102, [float("inf"), 0.0, 0.0], 1)]
    assert found(spark, rows) == plainly(rows, 10)
    assert found(spark, []) == []


def test_large_components_stay_exact():
    big = (1 << 40) + 1
    body = np.array([[big, 3], [big, 2], [1, 1], [-big, 5]], np.int64)
    cell = Cell(np.arange(4), np.array([0, 1, 1, 0]), np.arange(4), body)
    assert cell.products(np.arange(4), body[:1]).tolist() == [[(1 << 63) - 1, (1 << 63) - 1, big + 3, -(1 << 63)]]


def test_walks_end_early():
    """Far candidates are never multiplied, and what is found equals looking at all."""
    rng = np.random.default_rng(1)
    near, far = rng.normal(size=(300, 16)) * 0.02 + np.eye(16)[0], rng.normal(size=(20_000, 16)) * 0.02 + np.eye(16)[1]
    body = np.floor(256 * np.concatenate([near, far])).astype(np.int64)
    cell = Cell(np.arange(len(body)), np.arange(len(body)) % 2, np.arange(len(body)), body)
    looked = []
    products = cell.products
    cell.products = lambda places, members: (looked.append(len(places)), products(places, members))[1]
    labels, rows = cell.labels[:20], cell.rows[:20]
    best = walk(cell, cell.body[:20], 5, np.arange(20), _SameLabel(cell, labels, cell.ids[:20], rows))
    assert sum(looked) < 2000
    every = products(np.arange(len(body)), cell.body[:20])
    for k in range(20):
        order = sorted((-every[k, j], j) for j in range(len(body)) if j != k and cell.labels[j] == labels[k])[:5]
        assert [(-v, j) for v, j in order] == list(zip(best.score[best.search == k].tolist(), best.place[best.search == k].tolist()))
    assert _OtherLabel(cell, labels, [-100]).least[0] == np.iinfo(np.int64).max

from collections import defaultdict

import numpy as np
import pytest

from ctrprep.llm import embeddings


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def plain(rows):
    links, by_size = defaultdict(set), defaultdict(list)
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, v in rows:
        if i is not None and usable(v):
            by_size[len(v)].append((i, np.array(v) / np.abs(v).max()))
    for group in by_size.values():
        m = np.stack([v / np.linalg.norm(v) for _, v in group])
        for a, b in zip(*np.nonzero(m @ m.T >= embeddings.COSINE), strict=True):
            i, j = group[a][0], group[b][0]
            if i != j:
                links[i].add(j)
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted([(i, 0 if i is None else len(links[i]), None if i is None else root(i), i is None or root(i) == i) for i, _ in rows], key=str)


@pytest.fixture(scope="module")
def vectors():
    rng, rows = np.random.default_rng(0), []
    for size in (1, 3, 30, 120, 1, 3, 30, 3):
        centre = rng.normal(size=16)
        rows += [(len(rows) + k, [float(x) for x in centre + rng.normal(size=16) * 0.1]) for k in range(size)]
    n, one = len(rows), [1.0] * 15
    odd = [None, [0.0] * 16, [float("nan"), *one], rows[0][1], [2 * x for x in rows[0][1]], [], [None, *one], [float("inf"), *one], [1e300] * 16]
    rows += [(n + k, v) for k, v in enumerate(odd)]
    return rows + [(None, rows[0][1]), rows[3], (n + 50, [1.0, 2.0]), (n + 51, [1.0, 2.0])]


@pytest.mark.parametrize(("block", "recall"), [(1024, 1 - 1e-9), (7, 1 - 1e-9), (50, 1)])
def test_links_equal_all_pairs(spark, vectors, monkeypatch, block, recall):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(map(tuple, embeddings.near_duplicates(frame, recall=recall).collect()), key=str)
    assert got == plain(vectors)


def test_recall_at_the_threshold():
    """Nearly all pairs right at the threshold meet, and signs rule out none of them but nearly all others."""
    rng = np.random.default_rng(2)
    planes, tables = embeddings.table_plan(1_000_000)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(2000, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.95 * a + np.sqrt(1 - 0.95**2) * b
    one, two, far = (embeddings.signs_of(x, planes, tables) for x in (a, near, b))
    met = (embeddings.codes(one, planes, tables) == embeddings.codes(two, planes, tables)).any(axis=1)
    assert met.mean() > 0.99
    most = embeddings.most_different(planes * tables)
    assert ((one != two).sum(axis=1) <= most).all()
    assert ((one != far).sum(axis=1) > most).mean() > 0.999


def test_no_vectors(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_several_vectors_of_one_id(spark):
    """One of them counts, the same in every run, however the rows are dealt."""
    near, far = [1.0, 0.0, 0.1], [0.0, 1.0, 0.0]
    rows = [(1, near), (1, far), (1, far), (2, [1.0, 0.0, 0.12]), (3, [0.0, 1.0, 0.02]), (4, [1.0, 0.0]), (4, near)]
    results = set()
    for parts in (1, 2, 5, 7):
        table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(parts)
        got = embeddings.near_duplicates(table).collect()
        assert len(got) == len(rows)
        results.add(tuple(sorted({tuple(r) for r in got})))
    assert len(results) == 1
    links = {r[0]: r[1] for r in results.pop()}
    # The shortest vector of 4 has no partner; 1 has just one of 2 and 3.
    assert links[4] == 0 and links[1] == 1 and links[2] + links[3] == 1

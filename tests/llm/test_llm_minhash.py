import random
import re

import numpy as np
import pytest

from ctrprep.llm import minhash
from ctrprep.llm.components import connected


def plain(rows):
    sets = []
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((doc, {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()))
    parent = {doc: doc for doc, _ in rows if doc is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and a is not None and b is not None and 100 * len(s & t) >= 80 * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted([(d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets], key=str)


def result(docs):
    return sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str)


@pytest.fixture(scope="module")
def copies():
    rng, vocabulary, rows = random.Random(4), [f"w{k}" for k in range(500)], []
    for size in (3, 5, 8, 12, 30, 100, 300) * 3:
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(rng.choice([2, 5, 30])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, size // 15))):
                w[rng.randrange(size)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w[: max(1, int(size * rng.uniform(0.8, 1)))] if rng.random() < 0.3 else w)))
    n = len(rows)
    return rows + [(n, None), (n + 1, ""), (None, rows[0][1]), (0, rows[5][1]), (n + 2, rows[7][1].upper())]


@pytest.mark.parametrize("limits", [(64, 512), (2, 3)])
def test_components_equal_all_pairs(spark, copies, monkeypatch, limits):
    monkeypatch.setattr(minhash, "GROUP", limits[0])
    monkeypatch.setattr(minhash, "BLOCK", limits[1])
    assert result(spark.createDataFrame(copies, "doc_id long, text string").repartition(4)) == plain(copies)


def test_links_that_a_star_misses(spark):
    """Two documents alike, each unlike the smallest one of their bucket but not by much."""
    words = [f"w{k}" for k in range(200)]
    far = words[:150] + [f"x{k}" for k in range(50)]
    rows = [(1, " ".join(words)), (2, " ".join(far)), (3, " ".join(far[:190]))]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 2}


@pytest.mark.parametrize("limits", [(64, 512), (2, 1)])
def test_two_texts_of_one_document_in_an_open_bucket(spark, monkeypatch, limits):
    """Each text links by itself: one with a bucket's open members, the other with texts elsewhere."""
    monkeypatch.setattr(minhash, "GROUP", limits[0])
    monkeypatch.setattr(minhash, "BLOCK", limits[1])
    words, elsewhere = [f"w{k}" for k in range(200)], [f"y{k}" for k in range(200)]
    far = words[:150] + [f"x{k}" for k in range(50)]
    # Unlike 2's first text by more than the threshold, but not by much.
    near = [w if k % 60 else f"z{k}" for k, w in enumerate(far)]
    versions = [(1, words), (2, far), (2, elsewhere), (2, near[:170] + elsewhere[:30]), (3, far[:190]), (4, elsewhere[:190]), (5, words[:120] + elsewhere[:80])]
    rows = [(i, " ".join(w)) for i, w in versions]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == plain(rows)


def test_densified_signatures_agree_as_sets_do():
    rng = np.random.default_rng(0)
    for size in (5, 40, 600):
        agreement, truth = [], []
        for _ in range(200):
            s = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            t = np.unique(np.append(s[: int(len(s) * 0.8)], rng.integers(0, 1 << 63, 1).astype(np.uint64)))
            bins = minhash.signatures([s, t])
            agreement.append((bins[0] == bins[1]).mean())
            truth.append(len(np.intersect1d(s, t)) / len(np.union1d(s, t)))
        assert abs(np.mean(agreement) - np.mean(truth)) < 0.04


def test_keeping_one_of_each_group(spark, odd):
    out = minhash.drop_near_duplicates(odd)
    assert out.columns == odd.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([1, 1, 2, 3, None, None, 4, 6, 7], key=str)


def test_odd_documents(odd, no_documents):
    assert result(odd) == plain([(r.doc_id, r.text) for r in odd.collect()])
    assert result(no_documents) == []


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 200 + k) for k in range(30)] + [(7, 7), (300, 299), (299, 300)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    expected = {k: 0 for k in range(41)} | {100: 100} | {200 + k: 100 for k in range(30)} | {299: 299, 300: 299}
    assert got == expected

import hashlib
import random
import re

import pytest

from ctrprep.llm import substrings


def plain(rows, window=50):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            if doc is not None:
                first[x] = min(first.get(x, doc), doc)
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[k : k + window])] < doc:
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def result(docs):
    return sorted(map(tuple, substrings.digests(substrings.remove_repeats(docs)).collect()), key=str)


@pytest.fixture(scope="module")
def shared(spark):
    rng = random.Random(3)
    base = [[rng.choice("abcdefg") for _ in range(400)] for _ in range(5)]
    rows = []
    for i in range(150):
        b, k, n = rng.choice(base), rng.randint(0, 340), rng.choice([10, 50, 51, 60, 120])
        ends = [[rng.choice("xyz") for _ in range(rng.randint(0, 60))] for _ in range(2)]
        rows.append((i, " \t".join(ends[0] + b[k : k + n] + ends[1])))
    rows += rows[:20] + [(None, rows[3][1]), (500, rows[3][1]), (501, None), (502, ""), (7, rows[9][1])]
    return rows


def test_removal_equals_plain_comparison(spark, shared):
    assert result(spark.createDataFrame(shared, "doc_id long, text string").repartition(5)) == plain(shared)


def test_intervals_and_texts(spark):
    passage = [f"p{k}" for k in range(60)]
    rows = [(1, " ".join(["x", *passage, "y"])), (2, " ".join(["u  v", *passage[5:58], "w"]))]
    got = {r.doc_id: r for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].removed == []
    assert [tuple(i) for i in got[2].removed] == [(2, 55)]
    assert got[2].kept == "u v w"


def test_odd_documents(odd, no_documents):
    assert result(odd) == plain([(r.doc_id, r.text) for r in odd.collect()])
    assert result(no_documents) == []

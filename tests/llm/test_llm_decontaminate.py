import random
import re

import pytest

from ctrprep.llm import decontaminate as d


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(texts, items, window=13):
    known = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    out = []
    for doc, text in texts:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in known}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in known:
                    hit |= set(range(k, k + n))
                    found |= known[tuple(w[k : k + n])]
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(1)
    letters = ["a", "b", "c", "A", "é"]
    docs = [(i, " ".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(200)] + [(900, None), (901, "")]
    items = [(i, " ".join(rng.choice(letters) for _ in range(rng.choice([0, 7, 9, 13, 14, 20])))) for i in range(50)] + [(70, None)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def result(docs, items):
    rows = d.judged(d.find_passages(docs, items)).collect()
    return sorted([(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows], key=str)


@pytest.mark.parametrize("group_words", [1_000_000, 100])
def test_hits_equal_plain_comparison(cases, monkeypatch, group_words):
    monkeypatch.setattr(d, "GROUP_WORDS", group_words)
    docs, items = cases
    assert result(docs, items) == plain([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])


def test_passages_are_cut_and_contaminated_documents_go(spark):
    passage = " ".join(f"item{k}" for k in range(20))
    rest = " ".join(f"other{k}" for k in range(500))
    rows = [(1, f"{rest} ü, {passage}! {rest}"), (2, passage), (3, rest), (4, None), (5, "")]
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x") for r in rows], "doc_id long, text string, n_chars int, hits string")
    items = spark.createDataFrame([(7, passage.upper())], "item_id long, text string")
    out = d.decontaminate(docs, items)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    cut = f"{rest} ü, ! {rest}"
    assert got == {1: (cut, len(cut)), 3: (rest, len(rest)), 4: (None, None), 5: ("", 0)}


def test_odd_documents(spark, odd, no_documents):
    items = spark.createDataFrame([(1, "alpha beta"), (None, "gamma")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = [(i, n, h, [x for x in names], c) for i, n, h, names, c in result(odd, items)]
    assert [g[:3] for g in got] == [p[:3] for p in plain(rows, [(1, "alpha beta"), ("", "gamma")])]
    assert d.decontaminate(odd, items.where("false")).count() == odd.count()
    assert result(no_documents, items) == []


@pytest.mark.parametrize("group_words", [1_000_000, 20])
def test_rows_stay_apart_with_several_groups(spark, monkeypatch, group_words):
    """Repeated rows, shared ids and rows without an id are each a document."""
    monkeypatch.setattr(d, "GROUP_WORDS", group_words)
    item = [" ".join(f"w{i}x{k}" for k in range(15)) for i in range(8)]
    rest = " ".join(f"other{k}" for k in range(600))
    texts = [f"{rest} {item[0]} {rest}", f"{rest} {item[1]} {item[5]}", rest, item[2], f"{rest} {item[3]} {rest} {item[4]}"]
    rows = [(1, texts[0]), (1, texts[0]), (2, texts[1]), (2, texts[2]), (2, texts[3]), (None, texts[4]), (None, texts[0]), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(list(enumerate(item)), "item_id long, text string")
    assert result(docs, items) == plain(rows, list(enumerate(item)))
    cut = [(i, None if t is None else " ".join(w for w in t.split(" ") if w[0] != "w")) for i, t in rows if t != item[2]]
    got = [(r.doc_id, r.text and " ".join(r.text.split())) for r in d.decontaminate(docs, items).collect()]
    assert sorted(got, key=str) == sorted(cut, key=str)

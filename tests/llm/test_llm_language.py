"""Language by cross-parsing: phrases against a plain search, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ctrprep.llm import language
from ctrprep.llm.language import LanguageModel, Parser, SuffixAutomaton, held_out, letters, predict, train


def plain_phrases(text, pieces):
    count = 0
    for at in range(0, len(text), language.BLOCK):
        block = text[at : at + language.BLOCK]
        k = 0
        while k < len(block):
            n = 1
            while k + n < len(block) and any(block[k : k + n + 1] in p for p in pieces):
                n += 1
            count, k = count + 1, k + n
    return count


@pytest.mark.parametrize("block", [5, 256])
def test_phrases_equal_plain_matches(monkeypatch, block):
    monkeypatch.setattr(language, "BLOCK", block)
    rng = random.Random(block)
    word = lambda letters_: "".join(rng.choice(letters_) for _ in range(rng.randint(1, 40)))
    for _ in range(25):
        pieces = [tuple(word("ab c") for _ in range(rng.randint(1, 5))), tuple(word("abcdé") for _ in range(3))]
        texts = ["".join(word("abcdéz ") for _ in range(rng.randint(0, 20))) for _ in range(12)]
        found = Parser(LanguageModel(("x", "y"), tuple(pieces))).phrases([np.array([0 if c == " " else ord(c) for c in t], np.uint32) for t in texts])
        assert found.tolist() == [[plain_phrases(t, p) for p in pieces] for t in texts]


def test_automaton_knows_all_substrings():
    rng = random.Random(2)
    for _ in range(30):
        words = [[rng.randint(0, 2) for _ in range(rng.randint(0, 12))] for _ in range(4)]
        automaton = SuffixAutomaton(words)
        every = {tuple(w[i:j]) for w in words for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        seen, level = set(), [((), 0)]
        while level:
            level = [((*path, c), to) for path, state in level for c, to in automaton.moves[state].items()]
            seen |= {path for path, _ in level}
        assert seen == every


def test_letters():
    show = lambda t: "".join(chr(c or 32) for c in letters(t).tolist())
    assert show("  Ähm, 12 no-WAY!\n") == "ähm no way"
    assert show("½ 3² _") == "" and show("") == "" and show("x") == "x"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(documents):
    model = train(documents.where(~held_out(F.col("doc_id"))))
    assert sorted(model.languages) == ["de", "en", "es", "fr"] and model.languages[0] == "en"
    assert all(sum(map(len, p)) <= language.REFERENCE for p in model.pieces)
    found = predict(documents, model, keep=("doc_id", "lang", "text")).where(held_out(F.col("doc_id"))).collect()
    right = sum(r["lang"] == r["lang_pred"] for r in found)
    long = [r for r in found if r["text"] and len(r["text"]) > 100]
    print(len(found), right, len(long), sum(r["lang"] == r["lang_pred"] for r in long))
    assert right >= 0.97 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_predictions_do_not_depend_on_how_rows_are_dealt(documents):
    few = documents.where(F.col("doc_id") < 200)
    model = train(few)
    assert train(few.repartition(7)) == model
    as_text = lambda df: sorted(map(str, predict(df, model).collect()))
    assert as_text(few) == as_text(few.repartition(5))


def test_samples_are_bounded_and_copies_count_once(spark):
    rng = random.Random(4)
    line = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(2000))
    rows = [(k, line, "xx") for k in range(300)] + [(1000, "ijkl mnop " * 200, "yy"), (1001, "qrst", "zz")]
    model = train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), reference=3000)
    assert model.languages == ("xx", "yy", "zz")
    for pieces in model.pieces:
        assert len(set(pieces)) == len(pieces) and 0 < sum(map(len, pieces)) <= 3000


def test_odd_rows(spark, odd, no_documents):
    model = LanguageModel(("aa", "bb"), (("alpha beta gamma",), ("w word wort",)))
    rows = predict(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] in (2, 3, 7):
            assert (r["lang_pred"], r["score"], r["bits"]) == ("und", 0.0, None)
        else:
            assert r["lang_pred"] in ("aa", "bb", "und")
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 5)} == {"aa"}
    assert predict(no_documents, model).collect() == []
    nothing = train(no_documents.withColumn("lang", F.lit("en")))
    assert nothing.languages == ()
    assert {r["lang_pred"] for r in predict(odd, nothing).collect()} == {"und"}
    unlabelled = train(spark.createDataFrame([(1, "abc", None), (2, None, "en"), (3, "12", "fr"), (4, "abc abc", "de")], "doc_id long, text string, lang string"))
    assert unlabelled.languages == ("de",)


def test_held_out_rows(spark):
    rows = [(k, zlib.crc32(str(k).encode()) % 4 == 2) for k in range(50)]
    got = spark.createDataFrame([(k,) for k, _ in rows] + [(None,)], "doc_id long").select("doc_id", held_out(F.col("doc_id"))).collect()
    assert [tuple(r) for r in got] == [*rows, (None, False)]

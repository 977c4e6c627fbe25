import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet").cache()


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "bpe"]


@pytest.mark.parametrize("name", ["toxicity", "near_duplicates", "decontamination", "personal_data"])
def test_stages_keep_columns_and_ids(spark, docs, small, name):
    out = stage(name)(spark, docs, small)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert len(set(ids)) == len(ids)
    assert 0.6 * docs.count() < len(ids) <= docs.count()


def test_toxic_documents_go(spark, small):
    rows, labels = [], []
    for k in range(300):
        bad = k % 3 == 0
        rows.append((k, f"plain words number {k % 11}. {'what a vile fool' if bad else 'what a nice day'}.", "en", "s", 10))
        labels.append((k, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from ctrprep.llm import toxicity

    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    left = {r.doc_id for r in toxicity.drop_toxic(docs, model).collect()}
    assert left == {k for k in range(300) if k % 3}


def test_near_duplicates_leave_one(spark, docs, small):
    from ctrprep.llm.minhash import near_duplicates

    kept = {r.doc_id for r in near_duplicates(docs, size=5).where("kept").collect()}
    assert {r.doc_id for r in stage("near_duplicates")(spark, docs, small).collect()} == kept


def test_no_strict_identifier_is_left(spark, docs, small):
    text = "\n".join(r.text or "" for r in stage("personal_data")(spark, docs, small).collect())
    assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)


def test_last_stage_equals_the_library(spark, docs, small):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in stage("bpe")(spark, docs, small).collect():
        assert r.ids == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids)


def test_run_applies_all_stages(spark, small, docs):
    expected = docs
    for _, f in corpus_pipeline.STAGES:
        expected = f(spark, expected, small)
    got = sorted(map(tuple, corpus_pipeline.run(spark, small).collect()))
    assert got == sorted(map(tuple, expected.collect()))


def test_stages_on_odd_documents(spark, odd, small):
    out = odd
    for _, f in corpus_pipeline.STAGES:
        out = f(spark, out, small)
    assert {r.doc_id for r in out.collect()} == {1, 2, 3, None, 4, 6, 7}


def test_stages_on_no_documents(spark, odd, small):
    out = odd.limit(0)
    for _, f in corpus_pipeline.STAGES:
        out = f(spark, out, small)
    assert out.collect() == []

import numpy as np
import pytest
from pyspark.sql import functions as F

from ctrprep.llm import quality, toxicity
from ctrprep.llm.training import class_samples, held_out

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def held_out_rows(scored, labels, label):
    rows = scored.join(labels, "doc_id").where(held_out(F.col("doc_id"))).select("score", F.col(label).alias("y")).collect()
    return np.array([r.score for r in rows]), np.array([r.y for r in rows])


def test_toxicity_on_the_held_out_fold(tables):
    docs, labels = tables
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    score, y = held_out_rows(scored, labels, "toxic")
    assert y.sum() > 20
    assert ((score >= 0.5) == (y == 1)).mean() > 0.98
    row = scored.where(F.size("sentences") > 0).join(docs, "doc_id").first()
    span = row.sentences[0]
    assert 0 <= span.start < span.end <= len(row.text)


def test_quality_on_the_held_out_fold(tables):
    docs, labels = tables
    model = quality.train(docs, labels)
    score, y = held_out_rows(quality.score(docs, model), labels, "quality")
    good, bad = score[y == 1], score[y == 0]
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert 0.6 < model.prior < 0.98


def test_prior_of_separable_scores():
    rng = np.random.default_rng(0)
    unlabelled = np.concatenate([rng.normal(3, 1, 7000), rng.normal(-6, 1, 3000)])
    # The estimate is two standard errors low on purpose.
    assert 0 <= 0.7 - quality.estimated_prior(rng.normal(3, 1, 5000), unlabelled) < 0.06


def test_training_takes_no_held_out_label(tables):
    _, labels = tables
    chosen, sizes = class_samples(labels, "toxic", 50)
    assert chosen.where(held_out(F.col("doc_id"))).isEmpty()
    assert set(sizes) == {0, 1}
    assert chosen.count() < 200


def test_sentences_are_found_by_document_labels_only(spark):
    rows, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        rows.append((k, f"the day {k % 7} was calm. {'you vile creature' if bad else 'we ate some bread'}. rain came {k % 5} times."))
        labels.append((k, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = toxicity.score(docs, model).where("doc_id = 200").first()
    text = rows[200][1]
    assert [text[s.start : s.end] for s in found.sentences] == ["you vile creature"]


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_documents_and_no_labels(spark, odd, no_documents, module):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    some = spark.createDataFrame([(1, 1, 1), (5, 0, 1), (None, 1, 1), (6, None, None)], "doc_id long, toxic int, quality int")
    for labels in (none, some):
        model = module.train(odd, labels)
        scores = [r.score for r in module.score(odd, model).collect()]
        assert len(scores) == odd.count()
        assert all(0 <= s <= 1 for s in scores)
        assert module.score(no_documents, model).collect() == []
    kept = toxicity.drop_toxic(odd, toxicity.train(odd, none))
    assert kept.columns == odd.columns
    assert kept.count() == odd.count()

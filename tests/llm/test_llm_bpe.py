import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ctrprep.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_texts_equal_the_library(library, spark, small):
    rng = random.Random(3)
    parts = ["a", "th", "in", "the", "é", "ß", "İ", "Σ", " ", "\n", "'s", "'ll", "1", "½", "!!", "日本", "<|endoftext|>", "\x1f", "\x85", "ﬀ", "é", "🙂", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(rng.choice("abcdeinorstth") for _ in range(rng.randint(0, 300))) for _ in range(300)]
    texts += ["", "  ", "a" * 3000, *(r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect())]
    own = bpe.WordBpe(PATH)
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = own.ids(text)
        assert ids.tolist() == expected.ids
        assert own.decode(ids).decode() == library.decode(expected.ids, skip_special_tokens=False)


def test_a_full_memory_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    own = bpe.WordBpe(PATH)
    text = "one two three four five six one two three unbelievable incompatibilities"
    assert own.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_odd_documents(odd, library):
    rows = bpe.encode(odd, PATH).collect()
    texts = [r.text for r in odd.collect()]
    assert sorted(len(r["ids"]) for r in rows) == sorted(len(library.encode(t or "", add_special_tokens=False).ids) for t in texts)
    assert sum(r.doc_id is None for r in rows) == 2


def test_decoding_ids_and_empty_tables(spark, no_documents):
    rows = spark.createDataFrame([(1, [320, 1002]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(rows, PATH).collect()}
    assert got == {1: bpe.WordBpe(PATH).decode([320, 1002]).decode(), 2: "", 3: ""}
    assert bpe.digests(bpe.encode(no_documents, PATH)).collect() == []

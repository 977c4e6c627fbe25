import random
import re

import pytest

LONG = 2_500_000


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with NULLs, empty and very long texts, repeated rows and columns named like results."""
    rng = random.Random(1)
    words = ["alpha", "Beta", "gamma", "délta", "token=abcdef123", "a@b.example.org", "1.2.3.4"]
    body = " ".join(rng.choice(words) for _ in range(120))
    long = " ".join(f"w{k % 977}" for k in range(LONG // 6))
    rows = [(1, body), (1, body), (2, None), (3, ""), (None, body), (4, long), (5, body + " tail"), (6, "one"), (7, " \t\n"), (None, None)]
    rows = [(i, t, None if t is None else len(t), "en", 0.5) for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string, score double").repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")

import hashlib
import random
import re

from pyspark.sql import functions as F

from ctrprep.llm import pii
from ctrprep.llm.secrets import span_report

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    spans = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if passes(kind, m[0])]
    return [(a, b, kind) for a, _, b, kind in sorted(spans)]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(2)
    parts = ["a", "@", "b.c", ".", "-", "1", "22", "333", "+1", " ", "(", "555", ") ", "0555", "é", "%", "_", "4111 1111 1111 1111", "\n"]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain(text)


def test_long_runs_stay_linear():
    assert pii.base_spans("1" * 400_000 + "a" * 400_000 + "@") == []


def contextual(spark):
    seeds = [(i, f"Please call me at +1 (5{i % 10}{i * 7 % 10}) 555-{1000 + i} today. lorem {i}") for i in range(30)]
    unseen = [(100 + i, f"Please call me at 555 {2000 + i} today") for i in range(3)]
    others = [(200 + i, f"part number 777 {2000 + i} was made") for i in range(3)] + [(300, None), (301, ""), (None, "call +1 415 555 0000 now")]
    return spark.createDataFrame(seeds + unseen + others, "doc_id long, text string")


def test_contexts_of_seeds_discover_unseen_numbers(spark):
    docs = contextual(spark)
    got = {r.doc_id: [(s.kind, s.base) for s in r.spans] for r in pii.find_personal_data(docs).collect()}
    assert got[0] == [("phone", True)]
    assert got[100] == [("phone", False)]
    assert got[200] == got[300] == got[301] == []
    assert got[None] == [("phone", True)]
    report = {r.doc_id: r for r in span_report(pii.find_personal_data(docs), pii.KINDS, base_only=True).collect()}
    assert report[100].n_phone == 0
    assert report[100].spans == "phone:18:26"


def test_more_unseen_values_than_seeds(spark):
    rows = [(i, f"please dial +1 415 555 {1000 + i} soon") for i in range(5)] + [(10 + i, f"please dial 415 777 {1000 + i} soon") for i in range(8)]
    rows += [(30 + i, f"we sold 300 400 {1000 + i} bolts") for i in range(8)]
    got = {r.doc_id: len(r.spans) for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: int(i < 30) for i, _ in rows}


def test_discovered_values_induce_patterns(spark):
    """Values seen in the seeds' context stand in a second one, which gives away values of a third."""
    rows = [(i, f"please dial +1 415 555 {1000 + i} soon") for i in range(6)]
    rows += [(10 + i, f"please dial 415 777 {1000 + i} soon") for i in range(6)]
    rows += [(20 + i, f"my handset: 415 777 {1000 + i} rings") for i in range(6)]
    rows += [(30 + i, f"my handset: 212 333 {4000 + i} rings") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [s.kind for s in r.spans] for r in pii.find_personal_data(docs).collect()}
    assert all(kinds == ["phone"] for kinds in got.values())
    without = {r.doc_id: len(r.spans) for r in pii.find_personal_data(docs.where("doc_id < 10 or doc_id >= 20")).collect()}
    assert not any(n for i, n in without.items() if i >= 20)


def test_mixed_contexts_discover_nothing(spark):
    rows = [(i, f"the value +1 415 555 {1000 + i} here") for i in range(6)] + [(10 + i, f"the value 10.0.0.{i} here") for i in range(12)]
    rows += [(30 + i, f"the value 415 777 {1000 + i} here") for i in range(4)]
    got = {r.doc_id: len(r.spans) for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[30 + i] for i in range(4)] == [0] * 4


def test_long_octets(spark):
    texts = ["1.2.3." + "0" * 5000, "0" * 9000 + "255.1.2.3", "1.2.3." + "0" * 5000 + "256", "9" * 6000 + ".1.1.1"]
    assert [pii.base_spans(t) for t in texts] == [[(0, 5006, "ip")], [(0, 9009, "ip")], [], []]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [len(r.spans) for r in pii.find_personal_data(docs).orderBy("doc_id").collect()] == [1, 1, 0, 0]
    assert pii.redact(docs).where("doc_id = 0").first().text == "[IP]"


def test_query_equals_plain_patterns(spark, small):
    from ctrprep.llm.queries import op5_personal_data

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in op5_personal_data(spark, small).collect():
        base = plain(texts[r.doc_id])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in base) for k in pii.KINDS]
        written = [f"{kind}:{start}:{end}" for start, end, kind in base]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(filter(None, r.spans.split(",")))


def test_redaction(spark):
    docs = contextual(spark).withColumn("n_chars", F.length("text")).withColumn("items", F.lit(1))
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert len(got) == docs.count()
    assert got[100] == ("Please call me at [PHONE] today", 31)
    assert got[200] == ("part number 777 2000 was made", 29)
    assert got[300] == (None, None)
    assert got[301] == ("", 0)


def test_odd_documents(odd, no_documents):
    rows = pii.find_personal_data(odd)
    expected = sorted(len(plain(r.text or "")) for r in odd.collect())
    assert sorted(len(r.spans) for r in rows.collect()) == expected
    assert pii.redact(odd).count() == odd.count()
    assert pii.find_personal_data(no_documents).collect() == []

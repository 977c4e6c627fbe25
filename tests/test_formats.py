import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from ctrprep.operators import formats, sparse
from ctrprep.operators.trees import TreeInput, parse_inputs


@pytest.fixture(scope="module")
def encoded(spark):
    rows = [("1", "a", "x", 7, 4), ("0", "b", "y", None, 5), ("0", "a", None, 7, None)]
    return spark.createDataFrame(rows, "label string, a string, b string, a_id long, b_id long")


IDS = {"a": "a_id", "b": "b_id"}


def values(df):
    return [r["value"] for r in df.collect()]


def test_libsvm_misses(encoded):
    assert values(formats.libsvm(encoded, IDS, "label")) == ["1\t7:1\t4:1", "0\t5:1", "0\t7:1"]
    assert values(formats.libsvm(encoded, IDS, "label", "null")) == ["1\t7:1\t4:1", "0\tnull:1\t5:1", "0\t7:1"]
    with pytest.raises(Exception, match="no id for a=b"):
        formats.libsvm(encoded, IDS, "label", "error").collect()
    assert values(formats.libsvm(encoded.where("a_id = 7"), IDS, "label", "error")) == ["1\t7:1\t4:1", "0\t7:1"]
    with pytest.raises(ValueError):
        formats.libsvm(encoded, IDS, "label", "skip")


def test_libsvm_follows_the_given_column_order(encoded):
    assert values(formats.libsvm(encoded, {"b": "b_id", "a": "a_id"}, "label"))[0] == "1\t4:1\t7:1"


def test_features_as_arrays(encoded):
    got = formats.features(encoded, ["a_id", "b_id"], "label").collect()
    assert [[tuple(f) for f in r["features"]] for r in got] == [[(7, 1.0), (4, 1.0)], [(5, 1.0)], [(7, 1.0)]]
    ordered = formats.features(encoded, ["a_id", "b_id"], "label", order_by_id=True).first()
    assert [f["id"] for f in ordered["features"]] == [4, 7]


def test_template_drops_absent_features(spark):
    rows = spark.createDataFrame([("1", "-1", "704", "-1"), ("1", None, "-1", "5")], "l string, a string, b string, c string")
    got = values(formats.template(rows, "${1} ${2}:1 ${3}:1 ${4}:1", ["l", "a", "b", "c"]))
    assert got == ["1 704:1 ", "1 5:1"]


def test_template_text_quirks_are_kept(spark):
    rows = spark.createDataFrame([("1", "-1", "-1:10"), ("1", "${3}", "z")], "l string, a string, b string")
    got = values(formats.template(rows, "${1} ${2}:1 ${3}", ["l", "a", "b"]))
    assert got == ["1 0", "1 z:1 z"]


def test_template_rows_with_a_dollar_are_dropped(spark):
    rows = spark.createDataFrame([("1", "a"), ("1", "$5")], "l string, a string")
    assert values(formats.template(rows, "${1} ${2}", ["l", "a"])) == ["1 a"]
    assert values(formats.template(rows, "${1} ${2} ${3}", ["l", "a"])) == []


def test_template_trims(spark):
    rows = spark.createDataFrame([(" 1 ", " a ")], "l string, a string")
    assert values(formats.template(rows, "${1}|${2}", ["l", "a"])) == ["1|a"]


def test_more_than_nine_placeholders(spark):
    rows = spark.range(1).select(*[F.lit(f"v{k}").alias(f"c{k}") for k in range(1, 12)])
    pattern = " ".join("${%d}" % k for k in range(1, 12))
    assert values(formats.template(rows, pattern, rows.columns)) == [" ".join(f"v{k}" for k in range(1, 12))]


def test_dropout(spark):
    rows = spark.range(4000).select("id", F.lit("5").alias("f"))
    gone = formats.template(rows, "${1} ${2}:1", ["id", "f"], {"f": 0.25}, ["id"]).where(~F.contains("value", F.lit(":")))
    assert abs(gone.count() / 4000 - 0.25) < 0.03
    all_gone = formats.template(rows, "${1} ${2}:1", ["id", "f"], {"f": 1.0}, ["id"])
    assert all_gone.where("value like '%:%'").count() == 0
    with pytest.raises(ValueError):
        formats.template(rows, "${1}", ["id"], {"f": 0.5})


def test_recode(spark):
    rows = spark.createDataFrame([("3,7,10",), ("5",)], "ids string")
    assert rows_of(rows.select(formats.recode(F.col("ids"), 10000))) == [("10003,10007,10010",), ("10005",)]
    lines = spark.createDataFrame([("1 3,7 x",), ("0 5 y",)], "value string")
    assert values(formats.recode_lines(lines, 1, 100)) == ["1 103,107 x", "0 105 y"]


def test_sparse_text(spark):
    rows = spark.createDataFrame([("1:2,9:3.5",), ("1:2,1:4, 3 : 5",), ("",), ("a:1,2,3:x,4:1",), (None,)], "v string")
    got = [r["m"] for r in rows.select(sparse.parse_sparse(F.col("v")).alias("m")).collect()]
    assert got == [{1: 2.0, 9: 3.5}, {1: 4.0, 3: 5.0}, {}, {4: 1.0}, None]


def test_sparse_fill(spark):
    rows = spark.createDataFrame([(3, 2.5), (9, 1.5), (None, None)], "f1 int, g1 double")
    inputs = parse_inputs("f1:1,9:g1", rows.columns)
    assert inputs == [TreeInput("f1", value=1.0), TreeInput("g1", feature=9)]
    got = [r["m"] for r in rows.select(sparse.sparse_vector(inputs).alias("m")).collect()]
    assert got == [{3: 1.0, 9: 2.5}, {9: 1.5}, {}]


def test_longer_names_are_not_confused(spark):
    rows = spark.createDataFrame([(1.0, 2.0)], "g1 double, g10 double")
    inputs = parse_inputs("1:g1,2:g10", rows.columns)
    assert rows.select(sparse.sparse_vector(inputs).alias("m")).first()["m"] == {1: 1.0, 2: 2.0}
    with pytest.raises(ValueError):
        parse_inputs("1:g2", rows.columns)

"""Empty frames, columns without any value, and one-row inputs."""

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from ctrprep.operators import formats, lookup, sampling, stats, trees
from ctrprep.operators.featuremap import build_feature_map, number_distinct
from ctrprep.plans import PrepSpec, prepare
from ctrprep.sources import text

SPEC = {
    "name": "edge",
    "key": "rid",
    "partial": [{"name": "p", "table": "t", "columns": "label,article,shelf,price_index,rid", "type": "s,s,s,f,s"}],
    "shrink": [{"name": "s", "args": "shelf:4:1"}],
    "sample_mode": "keep_unmatched",
    "transform": [
        {"type": "INTERVAL_INDEX", "args": "3", "columns": "price_index"},
        {"type": "SIMPLE_INDEX", "columns": "shelf,article"},
    ],
    "format": [{"name": "out", "pattern": "libsvm", "shuffle": True, "validate_rate": 10}],
}


@pytest.mark.parametrize("limit", [0, lookup.BROADCAST_BYTES])
def test_run_over_no_rows(spark, impressions, limit):
    run = prepare(spark, PrepSpec.from_dict(SPEC), {"t": impressions.where("rid < 0")}, broadcast_bytes=limit)
    assert run.samples["out"].count() == 0 and run.feature_map.entries.count() == 0


@pytest.mark.parametrize("limit", [0, lookup.BROADCAST_BYTES])
def test_run_over_columns_without_values(spark, impressions, limit):
    blank = impressions.select(
        "rid", "label", F.lit(None).cast("string").alias("article"), "shelf", F.lit(None).cast("double").alias("price_index")
    )
    run = prepare(spark, PrepSpec.from_dict(SPEC), {"t": blank}, broadcast_bytes=limit)
    lines = sorted(r["value"] for r in run.samples["out"].select("value").collect())
    assert lines == ["0\t4:1", "0\t4:1", "0\t5:1", "0\t5:1", "1\t4:1", "1\t6:1"]


def test_single_row(spark):
    row = spark.createDataFrame([("a", 5)], "v string, n int")
    fmap = build_feature_map(row, [("n", 700)], ["v"])
    assert rows_of(fmap.entries, "name", "value", "id") == [("n", "5", 1), ("v", "a", 701)]
    got = lookup.add_ids(row, fmap, same_rows=True).first()
    assert (got["n_id"], got["v_id"]) == (1, 701)


def test_operators_over_no_rows(spark, impressions):
    none = impressions.where("rid < 0")
    assert stats.pv_click(none, ["article"], "label").count() == 0
    assert number_distinct(none, "article").count() == 0
    assert sampling.shuffle_rows(none, 4).count() == 0
    assert formats.features(none.withColumn("i", F.lit(1)), ["i"], "label").count() == 0
    entries = spark.createDataFrame([], "name string, value string, id long")
    assert lookup.add_ids_from(impressions, entries, {"article": "i"}).where("i is null").count() == 6
    assert lookup.add_ids_from(impressions, entries, {"article": "i"}, 0).where("i is null").count() == 6
    lines = spark.createDataFrame([], "value string")
    assert rows_of(text.reject_counts(lines, 3)) == [(0, 0)]


def test_walk_over_no_rows(spark):
    nodes = spark.createDataFrame(
        [(0, 0, -1, -1, -1, 0.0, 9)], "tree int, node int, left int, right int, feature int, threshold float, leaf_id long"
    )
    inputs = [trees.TreeInput("id", 0)]
    assert trees.encode_leaves(spark.range(0), nodes, inputs).count() == 0
    assert trees.encode_leaves(spark.range(1), nodes, inputs).first()["leaves"] == [9]


def test_values_that_look_alike_stay_apart(spark):
    rows = spark.createDataFrame([("a_b", "c"), ("a", "b_c"), ("A", "C")], "x string, y string")
    fmap = build_feature_map(rows, indexes=["x", "y"])
    assert rows_of(fmap.entries, "name", "value", "id") == [
        ("x", "A", 1), ("x", "a", 2), ("x", "a_b", 3), ("y", "C", 4), ("y", "b_c", 5), ("y", "c", 6),
    ]


def test_values_with_odd_characters(spark):
    rows = spark.createDataFrame([("x/y=1",), ("é%",)], "v string")
    entries = build_feature_map(rows, indexes=["v"]).entries
    assert lookup.add_ids_from(rows, entries, {"v": "i"}).where("i is null").count() == 0

"""Crossings with a least count, a map of their own, and clicks."""

import pytest
from helpers import nodes_of, rows_of
from pyspark.sql import functions as F

from ctrprep.operators import crossing, featuremap, stats
from ctrprep.plans import PrepSpec, prepare


@pytest.fixture(scope="module")
def rows(spark):
    """Many users with few rows each, some articles that are frequent, and rows without one."""
    n = F.col("id")
    return spark.range(6000).select(
        F.when(n % 4 == 0, F.concat(F.lit("u"), n % 9)).otherwise(F.concat(F.lit("v"), n)).alias("user"),
        F.when(n % 7 > 0, F.concat(F.lit(" a"), n % 13)).alias("article"),
        (n % 5).alias("shelf"),
        (n % 3 == 0).cast("int").cast("string").alias("label"),
    ).cache()


@pytest.mark.parametrize("limit", [0, 1 << 30])
@pytest.mark.parametrize("bundle", [[], ["shelf"]])
def test_counts_equal_those_of_all_crossings(spark, rows, limit, bundle):
    columns, factor = (["user", "article"], 1) if bundle else (["user", "article", "shelf"], 2)
    names = list(featuremap.crossed_columns(columns, factor, bundle))
    every = stats.pv_click(featuremap.cross(rows, columns, factor, bundle), names, "label").where("pv >= 8")
    some = crossing.cross_frequent(rows, columns, factor, bundle, 8, limit)
    assert some.columns == [*rows.columns, *names]
    assert rows_of(crossing.crossing_counts(some, names, 8, "label")) == rows_of(every)
    assert every.count() > 20
    assert rows_of(crossing.cross_frequent(rows, columns, 2, bundle)) == rows_of(featuremap.cross(rows, columns, 2, bundle))


def test_rare_members_are_not_shuffled(spark, rows):
    """What reaches the exchange of the counts are crossings of frequent members."""
    crossed = crossing.cross_frequent(rows, ["user", "article"], least=8)
    assert crossed.where("user_x_article is not null").count() == rows.where("user like 'u%' and article is not null").count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counted = crossing.crossing_counts(crossed, ["user_x_article"], 8)
        assert sum("value" in c for c in nodes_of(counted, "Exchange")) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def spec(**intersect):
    return {
        "name": "s",
        "partial": [{"name": "t", "table": "t", "columns": "label,user,article", "type": "s,s,s"}],
        "intersect": [{"columns": "user,article", **intersect}],
        "format": [{"name": "out", "pattern": "libsvm"}],
    }


def test_a_run_with_a_map_of_crossings(spark, rows):
    whole = spec(least=8, label="label") | {"transform": [{"type": "SIMPLE_INDEX", "columns": "user_x_article"}]}
    first = prepare(spark, PrepSpec.from_dict(whole), {"t": rows})
    often = {r["value"]: r["pv"] for r in first.crossings.collect()}
    assert min(often.values()) >= 8
    entries = first.feature_map.entries
    assert {r["value"]: r["pv"] for r in entries.collect()} == often
    given = PrepSpec.from_dict(spec(mapfile="crossings"))
    assert given.all_columns() == ["label", "user", "article", "user_x_article", "user_x_article_id"]
    second = prepare(spark, given, {"t": rows, "crossings": entries})
    assert second.feature_map is None and second.crossings is None
    assert rows_of(second.samples["out"]) == rows_of(first.samples["out"])
    assert second.encoded.where("user_x_article_id is not null").count() == sum(often.values())


def test_settings_are_checked():
    for wrong, text in (({"least": 0}, "least"), ({"label": "nope"}, "label of intersect")):
        with pytest.raises(ValueError, match=text):
            PrepSpec.from_dict(spec(**wrong))
    both = spec(mapfile="m") | {"transform": [{"type": "SIMPLE_INDEX", "columns": "user_x_article"}]}
    with pytest.raises(ValueError, match="both a mapfile and a transform"):
        PrepSpec.from_dict(both)

"""Maps that go on: new values behind the old ids, unseen numbers in the buckets they fall into."""

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from ctrprep.operators import carry, featuremap, lookup, stats
from ctrprep.plans import PrepSpec, prepare


def test_ids_stay_and_new_ones_are_dense(spark):
    n = F.col("id")
    days = [
        spark.range(a, b).select((n % m).cast("string").alias("user"), F.concat(F.lit("s"), n % 7).alias("shelf"), ((n * 37) % top).alias("price"), (n % 2).cast("string").alias("click"))
        for a, b, m, top in ((0, 3000, 900, 500), (3000, 7000, 1500, 900))
    ]
    columns = ["user", "shelf"]
    counts = [stats.pv_click(d, [*columns, "price"]) for d in days]
    earlier = featuremap.rank_counts(counts[0], [("price", 10)], columns).entries
    got = carry.carry_forward(earlier, counts[1], columns, ["price"]).cache()
    old = {(r["name"], r["value"]): r["id"] for r in earlier.collect()}
    new = {(r["name"], r["value"]): r["id"] for r in got.collect()}
    assert len(new) == got.count() and old.items() <= new.items()
    indexed = sorted(i for (name, _), i in new.items() if name != "price")
    assert indexed == list(range(indexed[0], indexed[0] + len(indexed)))
    fresh = sorted((columns.index(k[0]), k[1], i) for k, i in new.items() if k not in old and k[0] != "price")
    assert [i for _, _, i in fresh] == list(range(max(old.values()) + 1, max(old.values()) + 1 + len(fresh)))
    assert len(fresh) == 600
    both = stats.value_counts(days[0].unionByName(days[1]), [*columns, "price"])
    assert rows_of(got, "name", "value", "pv") == rows_of(both, "name", "value", "pv")
    bounds = lookup.stored_bounds(earlier, ["price"])["price"]
    for (name, value), i in new.items():
        if name == "price":
            assert i == max((b for b in bounds if b[0] <= int(value)), default=bounds[0])[1]
    # The map of a day without rows is the map of the day before.
    again = carry.carry_forward(got, counts[1].where("false"), columns, ["price"])
    assert rows_of(again, "name", "value", "id", "pv") == rows_of(got, "name", "value", "id", "pv")


def test_first_day(spark):
    none = spark.createDataFrame([], "name string, value string, id long")
    counts = spark.createDataFrame([("b", "y", 2), ("a", "z", 1), ("b", "x", 3), ("other", "q", 1)], "name string, value string, pv long")
    assert rows_of(carry.carry_forward(none, counts, ["b", "a"])) == [("a", "z", 3, 1), ("b", "x", 1, 3), ("b", "y", 2, 2)]


BOUNDS = [(-5, 1), (0, 2), (10, 4), (1 << 60, 5)]


@pytest.mark.parametrize("bounds", [BOUNDS[:3], BOUNDS, [((1 << 60) + 7 * k, k) for k in range(40)]])
def test_nearest_bucket(spark, bounds):
    lows = [low for low, _ in bounds]
    numbers = sorted({x for low in lows for x in (low - 1, low, low + 1)} | {-(1 << 62), 1 << 62, (1 << 53) + 1})
    rows = spark.createDataFrame([(x,) for x in numbers] + [(None,)], "v long")
    got = dict(rows_of(lookup.add_nearest_bucket_ids(rows, "v", "b", bounds)))
    assert got == {x: max((b for b in bounds if b[0] <= x), default=bounds[0])[1] for x in numbers} | {None: None}
    assert rows_of(lookup.add_nearest_bucket_ids(rows, "v", "b", []).select("b").distinct()) == [(None,)]


@pytest.mark.parametrize("mode", featuremap.BUCKET_MODES)
@pytest.mark.parametrize("stored", [False, True])
def test_a_run_with_a_given_map_takes_unseen_numbers(spark, mode, stored):
    rows = spark.range(400).select(F.lit("1").alias("label"), F.concat(F.lit("a"), F.col("id") % 5).alias("article"), ((F.col("id") * 13) % 400).alias("price"))
    spec = {
        "name": "s",
        "partial": [{"name": "t", "table": "t", "columns": "label,article,price", "type": "s,s,s"}],
        "transform": [
            {"type": "INTERVAL_INDEX", "args": "8", "columns": "price", "bucket_mode": mode, "unseen_numbers": "nearest"},
            {"type": "SIMPLE_INDEX", "columns": "article"},
        ],
    }
    first = prepare(spark, PrepSpec.from_dict(spec), {"t": rows.where("price % 3 = 1")})
    given = first.feature_map.entries if stored else first.feature_map
    second = prepare(spark, PrepSpec.from_dict(spec), {"t": rows}, feature_map=given)
    bounds = first.feature_map.bucket_bounds["price"]
    for r in second.encoded.collect():
        assert r["price_id"] == max((b for b in bounds if b[0] <= r["price"]), default=bounds[0])[1]
        assert r["article_id"] is not None
    strict = {**spec, "transform": [{k: v for k, v in t.items() if k != "unseen_numbers"} for t in spec["transform"]]}
    missing = prepare(spark, PrepSpec.from_dict(strict), {"t": rows}, feature_map=given).encoded
    assert missing.where("price_id is null").count() == rows.where("price % 3 <> 1").count()
    with pytest.raises(ValueError, match="unseen"):
        PrepSpec.from_dict({**spec, "transform": [{**spec["transform"][0], "unseen_numbers": "guess"}]})

import pytest
from helpers import nodes_of, plan_of, rows_of
from pyspark.sql import functions as F

from ctrprep.operators import lookup
from ctrprep.operators.featuremap import build_feature_map

NAMES = {"user": "user_id", "price": "price_id"}


@pytest.fixture(scope="module")
def rows(spark):
    """One user holds a third of the rows, and a tenth have none."""
    user = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("u"), F.col("id") % 9000))
    )
    return spark.range(20000).select("id", user.alias("user"), ((F.col("id") * 7919) % 5003).alias("price")).cache()


@pytest.fixture(scope="module")
def fmap(rows):
    return build_feature_map(rows, [("price", 40)], ["user"])


@pytest.fixture(scope="module")
def expected(rows, fmap):
    ids = {(r["name"], r["value"]): r["id"] for r in fmap.entries.collect()}
    return sorted(
        ((r["id"], ids.get(("user", r["user"])), ids[("price", str(r["price"]))]) for r in rows.collect()), key=str
    )


@pytest.mark.parametrize("limit", [0, 1 << 40])
@pytest.mark.parametrize("same_rows", [False, True])
def test_all_ways_agree(rows, fmap, expected, limit, same_rows):
    got = lookup.add_ids(rows, fmap, NAMES, limit, same_rows)
    assert got.columns == [*rows.columns, *NAMES.values()]
    assert rows_of(got, "id", "user_id", "price_id") == expected


def test_large_way_spreads_the_hot_key(spark, rows, fmap):
    """No shuffle partition gets the hot third, nor all rows without a user."""
    for setting in ("adaptive.enabled", "autoBroadcastJoinThreshold"):
        spark.conf.set(f"spark.sql.{setting}", {"adaptive.enabled": "false"}.get(setting, "-1"))
    try:
        got = lookup.add_ids(rows, fmap, {"user": "user_id"}, 0)
        plan = plan_of(got)
        assert "hashpartitioning(__key" in plan and "SortMergeJoin" in plan
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20000 and max(sizes) < 1.3 * 20000 / len(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_entries_are_few(fmap):
    hot = lookup.hot_by_counts(fmap.of("user"), fmap.count("user"))
    assert "PushedFilters: [IsNotNull(pv), GreaterThanOrEqual(pv," in plan_of(hot)
    assert "hot" in {r["value"] for r in hot.collect()}
    assert hot.count() <= 2000


def test_large_way_reads_only_the_named_columns(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(500).select("id", F.lit("w").alias("unused"), F.col("id").cast("string").alias("user")).write.parquet(path)
    stored = spark.read.parquet(path)
    users = build_feature_map(stored, indexes=["user"])
    got = lookup.add_ids(stored, users, {"user": "uid"}, 0, spread_by=["id"]).select("uid")
    assert "unused" not in plan_of(got) and got.distinct().count() == 500


def test_buckets_of_same_rows_need_no_shuffle(rows, fmap):
    plan = plan_of(lookup.add_ids(rows, fmap, {"price": "price_id"}, 0, same_rows=True))
    assert "Exchange" not in plan.split("InMemoryTableScan")[0] and "Join" not in plan


def test_bucket_search_edges(spark):
    rows = spark.createDataFrame([("5",), ("9",), ("10",), ("19",), ("20",), ("999",), (None,), ("x",)], "v string")
    got = lookup.add_bucket_ids(rows, "v", "b", [(9, 3), (10, 4), (20, 8)])
    assert dict(rows_of(got)) == {"5": None, "9": 3, "10": 4, "19": 4, "20": 8, "999": 8, None: None, "x": None}
    single = lookup.add_bucket_ids(rows, "v", "b", [(10, 0)])
    assert dict(rows_of(single))["9"] is None and dict(rows_of(single))["10"] == 0


def test_numbers_beyond_double_precision_are_looked_up(spark):
    big = 1 << 60
    rows = spark.range(8).select((F.col("id") + F.lit(big)).alias("v"))
    fmap = build_feature_map(rows, [("v", 4)])
    got = {r["v"] - big: r["v_id"] for r in lookup.add_ids(rows, fmap, same_rows=True).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 6: 3, 7: 4}


def test_broadcast_budget_is_shared():
    sizes = {"a": (10, 100), "b": (1000, 10000), "c": (900, 9000)}
    assert lookup.small_enough(sizes, 1 << 30) == {"a", "b", "c"}
    assert lookup.small_enough(sizes, 70_000) == {"a", "c"}
    assert lookup.small_enough(sizes, 0) == set()


@pytest.mark.parametrize("limit", [0, 1 << 40])
def test_map_from_elsewhere(spark, rows, limit):
    entries = spark.range(9000).where("id % 2 = 0").select(
        F.lit("user").alias("name"), F.concat(F.lit("u"), F.col("id")).alias("value"), F.col("id")
    )
    entries = entries.unionByName(spark.createDataFrame([("user", "hot", -5), ("other", "u1", 1)], entries.schema))
    got = lookup.add_ids_from(rows, entries, {"user": "uid"}, limit)
    known = {r["value"]: r["id"] for r in entries.where("name = 'user'").collect()}
    assert rows_of(got, "id", "uid") == sorted(
        ((r["id"], known.get(r["user"])) for r in rows.collect()), key=str
    )
    inner = lookup.require_ids(got, ["uid"])
    assert inner.count() == sum(r["user"] in known for r in rows.collect())


def test_inner_lookup_becomes_an_inner_join(spark, rows):
    entries = spark.createDataFrame([("user", "hot", 1)], "name string, value string, id long")
    got = lookup.require_ids(lookup.add_ids_from(rows, entries, {"user": "uid"}), ["uid"])
    assert "Inner, BuildRight" in plan_of(got)


def test_hot_values_from_a_sample(spark):
    rows = spark.range(60000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v"))
    assert lookup.frequent_values(rows, {"v": F.col("v")}) == {"v": ["hot"]}
    entries = spark.createDataFrame([("x", 5)], "value string, id long")
    assert rows_of(lookup.hot_among(rows, ["hot", "x"], entries)) == [("hot", None), ("x", 5)]


@pytest.mark.parametrize("from_elsewhere", [True, False])
def test_frequent_misses_are_spread(spark, from_elsewhere):
    """A third of the rows have a value that the map lacks; they do not meet in one task."""
    rows = spark.range(60000).select(
        "id", F.when(F.col("id") % 3 == 0, "unknown").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("user")
    ).cache()
    fmap = build_feature_map(rows.where("user <> 'unknown'"), indexes=["user"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        if from_elsewhere:
            got = lookup.add_ids_from(rows, fmap.entries, {"user": "uid"}, 0, ["id"])
        else:
            got = lookup.add_ids(rows, fmap, {"user": "uid"}, 0, False, ["id"])
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 60000
        assert max(sizes) < 60000 * 0.2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert got.where("uid is null").count() == 20000


def test_repeated_map_values_raise(spark, rows):
    entries = spark.createDataFrame([("user", "hot", 1), ("user", "hot", 2)], "name string, value string, id long")
    with pytest.raises(ValueError):
        lookup.add_ids_from(rows, entries, {"user": "uid"})


def test_lookup_trims_the_row_value(spark):
    rows = spark.createDataFrame([(" a ",), ("b",)], "v string")
    entries = spark.createDataFrame([("v", "a", 1)], "name string, value string, id long")
    assert rows_of(lookup.add_ids_from(rows, entries, {"v": "i"})) == [(" a ", 1), ("b", None)]


@pytest.mark.parametrize("limit", [0, 1 << 40])
@pytest.mark.parametrize("same_rows", [False, True])
def test_equal_numbers_share_a_bucket_however_written(spark, limit, same_rows):
    written = ["0", "01", "1", " 1", "+1", "2", "x", None]
    rows = spark.createDataFrame([(v,) for v in written], "v string")
    fmap = build_feature_map(rows, [("v", 3)])
    assert rows_of(fmap.of("v")) == [("0", 0, 1), ("1", 2, 4), ("2", 3, 1)]
    got = lookup.add_ids(rows, fmap, None, limit, same_rows)
    assert rows_of(got) == sorted(zip(written, [0, 2, 2, 2, 2, 3, None, None]), key=str)


@pytest.fixture(scope="module")
def wide(spark):
    """Three columns of many values; a third of the rows share one value in two of them, and some have none."""
    n = F.col("id")
    text = {
        "a": F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), n % 7001)),
        "b": F.when(n % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("b"), (n * 31) % 5003)),
        "c": F.when(n % 3 == 0, "often").when(n % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit(" c"), (n * 17) % 9001)),
    }
    return spark.range(30000).select("id", F.concat(F.lit("payload"), n).alias("payload"), *[c.alias(k) for k, c in text.items()]).cache()


@pytest.mark.parametrize("from_elsewhere", [False, True])
def test_several_large_dictionaries_take_one_shuffle_of_rows(spark, wide, from_elsewhere):
    names = {"a": "a_id", "b": "b_id", "c": "c_id"}
    fmap = build_feature_map(wide.where("id % 5 <> 1"), indexes=list(names))
    ids = {(r["name"], r["value"]): r["id"] for r in fmap.entries.collect()}
    for setting, value in (("adaptive.enabled", "false"), ("autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(f"spark.sql.{setting}", value)
    try:
        if from_elsewhere:
            got = lookup.add_ids_from(wide, fmap.entries, names, 0, ["id"])
        else:
            got = lookup.add_ids(wide, fmap, names, 0, False, ["id"])
        shuffled = nodes_of(got, "Exchange")
        assert sum("payload" in columns for columns in shuffled) == 1
        # The values and the dictionaries meet, the ids come together, the rows take them.
        assert sum("__code" in columns for columns in shuffled) == 2 and sum("__one" in columns and "__code" not in columns for columns in shuffled) == 1
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 30000 and max(sizes) < 30000 * 0.2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = [(r["id"], *[ids.get((c, None if r[c] is None else r[c].strip())) for c in names]) for r in wide.collect()]
    assert rows_of(got, "id", *names.values()) == sorted(expected, key=str)
    assert rows_of(lookup.require_ids(got, ["b_id"]), "id") == sorted(((r[0],) for r in expected if r[2] is not None), key=str)


def test_values_swapped_between_columns_stay_apart(spark):
    """The code of a row tells (NULL, x) from (x, NULL)."""
    rows = spark.createDataFrame([(1, "x", None), (2, None, "x"), (3, "x", "x"), (4, None, None), (5, "y", "z")], "id int, a string, b string")
    entries = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("b", "z", 3)], "name string, value string, id long")
    got = lookup.add_ids_from(rows, entries, {"a": "i", "b": "j"}, 0)
    assert rows_of(got, "id", "i", "j") == [(1, 1, None), (2, None, 2), (3, 1, 2), (4, None, None), (5, None, 3)]

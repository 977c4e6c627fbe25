from dataclasses import replace

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from ctrprep.operators import featuremap, stats
from ctrprep.operators.featuremap import build_feature_map
from ctrprep.operators.ranking import store_ranked, with_row_index


def test_pv_click(scaled):
    assert rows_of(stats.pv_click(scaled, ["article", "shelf"], "label")) == [
        ("article", "a1", 3, 1), ("article", "a2", 2, 0), ("article", "a3", 1, 1),
        ("shelf", "4", 3, 1), ("shelf", "8", 2, 0), ("shelf", "9", 1, 1),
    ]


def test_only_label_one_is_a_click(spark):
    rows = spark.createDataFrame([("a", v) for v in ["1", " 1", "", "-1", "2", "0", None]], "v string, label string")
    assert rows_of(stats.pv_click(rows, ["v"], "label")) == [("v", "a", 7, 2)]
    with pytest.raises(ValueError):
        stats.pv_click(rows, ["v"], "nope")


def test_label_can_be_counted_itself(scaled):
    assert rows_of(stats.pv_click(scaled, ["label"], "label")) == [("label", "0", 4, 0), ("label", "1", 2, 2)]


def test_null_is_missing_or_a_token(spark):
    rows = spark.createDataFrame([("a",), (None,), (" a",)], "v string")
    assert rows_of(stats.value_counts(rows, ["v"])) == [("v", "a", 2)]
    assert rows_of(stats.value_counts(rows, ["v"], null_token="none")) == [("v", "a", 2), ("v", "none", 1)]
    assert rows_of(stats.vocabulary(rows, ["v"])) == [("v", "a")]


def test_pv_sums_to_rows_times_columns(lineitem):
    counted = stats.pv_click(lineitem.withColumn("label", F.lit("0")), ["l_suppkey", "l_linenumber"], "label")
    assert counted.agg(F.sum("pv"), F.sum("click")).first()[:] == (lineitem.count() * 2, 0)


@pytest.mark.parametrize(
    "buckets, mode, expected",
    [(3, "exact", [1, 1, 2, 3]), (3, "even", [0, 1, 2, 2]), (4, "exact", [2, 3, 5, 6]), (4, "even", [0, 1, 2, 3]),
     (7, "exact", [2, 3, 5, 6]), (100, "exact", [2, 3, 5, 6]), (6, "even", [1, 2, 4, 5])],
)
def test_equal_frequency_buckets(scaled, buckets, mode, expected):
    fmap = build_feature_map(scaled, intervals=[("price_index", buckets)], mode=mode)
    got = {r["value"]: r["id"] for r in fmap.entries.collect()}
    assert got == dict(zip(["1233", "1999", "50000", "89999"], expected))


def test_whole_map(scaled):
    fmap = build_feature_map(scaled, [("price_index", 3)], ["shelf", "article"])
    assert rows_of(fmap.entries, "name", "value", "id") == sorted(
        [("price_index", "1233", 1), ("price_index", "1999", 1), ("price_index", "50000", 2),
         ("price_index", "89999", 3), ("shelf", "4", 4), ("shelf", "8", 5), ("shelf", "9", 6),
         ("article", "a1", 7), ("article", "a2", 8), ("article", "a3", 9)], key=str)
    assert rows_of(fmap.of("article")) == [("a1", 7, 3), ("a2", 8, 2), ("a3", 9, 1)]
    assert fmap.bucket_bounds == {"price_index": [(1233, 1), (50000, 2), (89999, 3)]}
    assert fmap.sizes["article"] == (3, 6)


def test_offsets_of_several_interval_columns(spark):
    rows = spark.range(100).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b"), F.lit("x").alias("c"))
    fmap = build_feature_map(rows, [("a", 10), ("b", 5)], ["c"], mode="even")
    spans = fmap.entries.groupBy("name").agg(F.min("id"), F.max("id"), F.count("id"))
    assert rows_of(spans) == [("a", 0, 9, 100), ("b", 10, 14, 100), ("c", 16, 16, 1)]


def test_only_one_kind_of_transform_leaves_no_stray_row(scaled):
    assert build_feature_map(scaled, indexes=["article"]).entries.count() == 3
    assert build_feature_map(scaled, [("price_index", 2)]).entries.count() == 4


def test_numbers_sort_as_numbers_and_text_is_missing(spark):
    rows = spark.createDataFrame([("9",), ("10",), ("-3",), ("x",), (None,)], "v string")
    fmap = build_feature_map(rows, [("v", 3)])
    assert rows_of(fmap.entries, "value", "id") == [("-3", 1), ("10", 3), ("9", 2)]


def test_bad_requests_raise(scaled):
    for intervals, indexes in (([], []), ([("article", 2)], ["article"]), ([("article", 0)], []), ([], ["nope"])):
        with pytest.raises(ValueError):
            build_feature_map(scaled, intervals, indexes)


def brute_force_index(values, base):
    return {v: base + k for k, v in enumerate(sorted(set(values)))}


@pytest.fixture(scope="module")
def wide(spark):
    """A third of the rows share one value; the rest is nearly unique."""
    return spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id"))).alias("user"),
        F.when(F.col("id") % 3 == 1, F.lit(77)).otherwise((F.col("id") * 7919) % 10007).alias("price"),
    ).cache()


def test_ids_match_brute_force_over_many_partitions(spark, wide):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fmap = build_feature_map(wide, [("price", 50)], ["user"])
        slots = fmap.ranked.select(F.shiftright("seq", 33)).distinct().count()
        assert slots > 3
        users = {r["value"]: r["id"] for r in fmap.of("user").collect()}
        assert users == brute_force_index([r["user"] for r in wide.select("user").collect()], 51)

        prices = sorted(r["price"] for r in wide.select("price").collect())
        expected, frequency = {}, len(prices) // 50
        for k, p in enumerate(prices, start=1):
            expected[str(p)] = k // frequency
        assert {r["value"]: r["id"] for r in fmap.of("price").collect()} == expected
        last = {p: k for k, p in enumerate(prices)}
        even = replace(fmap, mode="even")
        assert {r["value"]: r["id"] for r in even.of("price").collect()} == {
            str(p): k * 50 // len(prices) for p, k in last.items()
        }
        assert rows_of(fmap.of("user")) == rows_of(fmap.entries.where("name = 'user'"), "value", "id", "pv")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ids_do_not_depend_on_partitioning(wide):
    one = build_feature_map(wide, [("price", 50)], ["user"]).entries
    other = build_feature_map(wide.repartition(3), [("price", 50)], ["user"]).entries
    assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_one_scan_counts_all_columns(lineitem):
    plan = plan_of(stats.value_counts(lineitem, ["l_linestatus", "l_linenumber", "l_suppkey"]))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int,l_linestatus:string>" in plan


def test_no_task_sees_the_whole_vocabulary(spark, wide):
    fmap = build_feature_map(wide, [("price", 50)], ["user"])
    assert "SinglePartition" not in plan_of(fmap.entries)
    assert len(fmap.totals) <= int(spark.conf.get("spark.sql.shuffle.partitions")) + 2
    assert "Exchange" not in plan_of(fmap.of("user")).replace("BroadcastExchange", "")


def test_statistics_map(scaled):
    counted = stats.pv_click(scaled, ["shelf", "article"], "label")
    assert rows_of(featuremap.feature_map_with_stats(counted, ["shelf", "article"])) == [
        ("article", "a1", 4, 3, 1), ("article", "a2", 5, 2, 0), ("article", "a3", 6, 1, 1),
        ("shelf", "4", 1, 3, 1), ("shelf", "8", 2, 2, 0), ("shelf", "9", 3, 1, 1),
    ]


def test_plain_numberings(scaled):
    assert rows_of(featuremap.number_values(scaled, ["shelf", "article"])) == [
        ("4", 0), ("8", 1), ("9", 2), ("a1", 3), ("a2", 4), ("a3", 5),
    ]
    assert rows_of(featuremap.number_distinct(scaled, "article")) == [("a1", 0), ("a2", 1), ("a3", 2)]


def test_row_index_is_dense(spark):
    ranked = store_ranked(spark.range(10000).select((F.col("id") * 31 % 10007).alias("v")), ["v"], "t")
    got = [r["i"] for r in with_row_index(ranked, "i", 5).orderBy("v").collect()]
    assert got == list(range(5, 10005))


def test_crossing(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", None, 2)], "p string, q string, r int")
    crossed = featuremap.cross(rows, ["p", "q", "r"])
    assert crossed.columns[3:] == ["p_x_q", "p_x_r", "q_x_r"]
    assert rows_of(crossed, "p_x_q", "p_x_r", "q_x_r") == [
        ("a\x01x", "a\x011", "x\x011"), (None, "a\x012", None),
    ] or rows_of(crossed, "p_x_q", "p_x_r", "q_x_r") == [
        (None, "a\x012", None), ("a\x01x", "a\x011", "x\x011"),
    ]
    assert list(featuremap.crossed_columns(["p", "q"], 1, ["r"])) == ["r_x_p", "r_x_q"]
    with pytest.raises(ValueError):
        featuremap.crossed_columns(["p"], 2)


def test_bucket_properties(spark):
    """Ids do not fall as the value grows, buckets between the ends miss the frequency by
    less than the largest count of one value, and no column's ids meet another's."""
    n = 3000
    shapes = {
        "even": F.col("id"),
        "few": F.col("id") % 13,
        "steep": F.floor(F.pow(F.lit(1.004), F.col("id"))),
        "signed": (F.col("id") * 7919) % 1009 - 500,
        "hot": F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 700),
        "same": F.lit(4),
    }
    rows = spark.range(n).select(*[c.cast("bigint").alias(k) for k, c in shapes.items()])
    for buckets in (1, 7, 40):
        fmap = build_feature_map(rows, [(k, buckets) for k in shapes])
        even = replace(fmap, mode="even")
        used = [{r["id"] for r in fmap.of(name).collect()} for name in shapes]
        assert sum(map(len, used)) == len(set().union(*used))
        for k, name in enumerate(shapes):
            start = fmap.bucket_starts()[k]
            found = sorted((int(r["value"]), r["id"] - start, r["pv"]) for r in fmap.of(name).collect())
            ids = [i for _, i, _ in found]
            assert ids == sorted(ids) and sum(pv for *_, pv in found) == n
            frequency, largest = n // buckets, max(pv for *_, pv in found)
            for bucket in sorted(set(ids))[1:-1]:
                size = sum(pv for _, i, pv in found if i == bucket)
                assert abs(size - frequency) <= largest
            assert {i - k * buckets for _, i, _ in even.of(name).collect()} <= set(range(buckets))


def test_a_column_named_twice_counts_once(scaled):
    once = rows_of(stats.pv_click(scaled, ["article"], "label"))
    assert rows_of(stats.pv_click(scaled, ["article", "article"], "label")) == once
    assert rows_of(stats.value_counts(scaled, ["article", "article"])) == [r[:3] for r in once]


def test_more_buckets_than_half_the_values(spark):
    """1,399 distinct values in 700 buckets: two to a bucket at most, and exact ids meet no dictionary id."""
    rows = spark.range(1399).select(F.col("id").alias("n"), (F.col("id") % 3).cast("string").alias("c"))
    even = build_feature_map(rows, [("n", 700)], ["c"], mode="even")
    largest = even.of("n").groupBy("id").count().agg(F.max("count")).first()[0]
    assert largest == 2
    assert min(r["id"] for r in even.of("c").collect()) == 701
    exact = build_feature_map(rows, [("n", 700)], ["c"])
    assert max(r["id"] for r in exact.of("n").collect()) == 1399
    assert min(r["id"] for r in exact.of("c").collect()) == 1400

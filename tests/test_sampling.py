from collections import Counter

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from ctrprep.functions.draws import RANGE, below, number, ticket
from ctrprep.operators import sampling
from ctrprep.operators.sampling import parse_conditions


def ids(df):
    return sorted(r["rid"] for r in df.collect())


def test_draw_values_and_rates(impressions):
    drawn = impressions.select("rid", number(ticket(42, "shrink|0", ["rid"])).alias("u")).orderBy("rid")
    assert [r["u"] for r in drawn.collect()] == [
        176734431, 1570328893, 2853542452, 910456890, 4094077906, 2836718514,
    ]
    assert ids(impressions.where(below(ticket(42, "shrink|0", ["rid"]), 0.5))) == [1, 2, 4]
    assert ids(impressions.where(below(ticket(42, "x", ["rid"]), 1.0))) == [1, 2, 3, 4, 5, 6]
    assert ids(impressions.where(below(ticket(42, "x", ["rid"]), 0.0))) == []
    with pytest.raises(ValueError):
        below(F.lit(1), 1.5)


def test_union_form_duplicates_and_drops(impressions):
    got = sampling.sample_union(impressions, parse_conditions("shelf:4:1 article:a1:1"), ["rid"])
    assert ids(got) == [1, 1, 3, 3, 5, 6]
    assert got.columns == impressions.columns


def test_any_form_keeps_one_copy(impressions):
    conditions = parse_conditions("shelf:4:1 article:a1:1")
    assert ids(sampling.sample_any(impressions, [conditions], ["rid"])) == [1, 3, 5, 6]
    assert sampling.sample_any(impressions, [conditions], ["rid"]).columns == impressions.columns


def test_keep_unmatched_form(impressions):
    assert ids(sampling.sample_keep_unmatched(impressions, parse_conditions("shelf:4:0"), ["rid"])) == [2, 4, 6]


def test_keep_unmatched_goes_by_column_order_first(spark):
    rows = spark.createDataFrame([(1, 1, 1), (2, 2, 1)], "rid int, a int, b int")
    got = sampling.sample_keep_unmatched(rows, parse_conditions("b:1:0 a:1:1"), ["rid"])
    assert ids(got) == [1]


def test_keep_unmatched_ignores_text_that_is_no_number(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "04"), (3, None), (4, "4")], "rid int, a string")
    assert ids(sampling.sample_keep_unmatched(rows, parse_conditions("a:4:0"), ["rid"])) == [1, 3]
    assert ids(sampling.sample_union(rows, parse_conditions("a:4:1"), ["rid"])) == [4]


def test_no_conditions_is_identity(impressions):
    assert ids(sampling.sample_union(impressions, [])) == [1, 2, 3, 4, 5, 6]
    assert ids(sampling.sample_any(impressions, [])) == [1, 2, 3, 4, 5, 6]
    assert ids(sampling.sample_keep_unmatched(impressions, [])) == [1, 2, 3, 4, 5, 6]


def test_unknown_column_and_bad_condition_raise(impressions):
    for operator in (sampling.sample_union, sampling.sample_keep_unmatched):
        with pytest.raises(ValueError):
            operator(impressions, parse_conditions("article:a1:1 nope:1:1"), ["rid"])
    with pytest.raises(ValueError):
        parse_conditions("article:a1")


def test_rate_is_met_and_partitioning_does_not_matter(lineitem):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    conditions = parse_conditions("l_returnflag:R:0.5 l_linestatus:O:0.3")
    one = sampling.sample_union(lineitem.select(*key, "l_returnflag", "l_linestatus"), conditions, key)
    other = sampling.sample_union(
        lineitem.select(*key, "l_returnflag", "l_linestatus").repartition(5), conditions, key
    )
    assert rows_of(one) == rows_of(other)
    returned = lineitem.where("l_returnflag = 'R'").count()
    kept = sampling.sample_union(lineitem, parse_conditions("l_returnflag:R:0.5"), key).count()
    assert abs(kept / returned - 0.5) < 0.05


def test_union_sampling_reads_once_and_pushes_the_conditions(lineitem):
    plan = plan_of(sampling.sample_union(lineitem.select("l_orderkey", "l_returnflag", "l_linenumber"),
                                         parse_conditions("l_returnflag:R:0.5 l_linenumber:3:0.3"), ["l_orderkey"]))
    assert plan.count("FileScan") == 1
    assert "Or(EqualTo(l_returnflag,R),EqualTo(l_linenumber,3))" in plan
    assert "Exchange" not in plan


def test_residues(impressions):
    drawn = {r["rid"]: r["u"] % 10 for r in impressions.select("rid", number(ticket(42, "residue", ["rid"])).alias("u")).collect()}
    wanted = [0, 3, 7]
    assert ids(sampling.sample_residues(impressions, wanted, ["rid"])) == sorted(k for k, u in drawn.items() if u in wanted)
    assert ids(sampling.sample_residues(impressions, sampling.parse_residues("-1"), ["rid"])) == [1, 2, 3, 4, 5, 6]
    whole = [sampling.sample_residues(impressions, [r], ["rid"]).count() for r in range(10)]
    assert sum(whole) == 6


def test_noise(impressions):
    got = sampling.add_noise(impressions, "article", "article_n", "unknown", 0.5, ["rid"])
    expected = [(r["rid"], "unknown" if r["u"] < RANGE // 2 else r["article"]) for r in
                impressions.select("rid", "article", number(ticket(42, "noise|article_n", ["rid"])).alias("u")).collect()]
    assert rows_of(got, "rid", "article_n") == sorted(expected, key=str)
    assert {r[0] for r in sampling.add_noise(impressions, "article", "n", "u", 1.0, ["rid"]).select("n").collect()} == {"u"}


def test_duplicate_positives(spark):
    rows = spark.createDataFrame([(1, "1"), (2, "0"), (3, None)], "rid int, label string")
    assert rows_of(sampling.duplicate_positives(rows, "label")) == [(1, "0"), (1, "1"), (2, "0"), (3, None)]
    numbers = spark.createDataFrame([(1, 1), (2, 0)], "rid int, label int")
    assert rows_of(sampling.duplicate_positives(numbers, "label")) == [(1, 0), (1, 1), (2, 0)]


def test_duplicate_positive_lines(spark):
    lines = spark.createDataFrame([("1 3:1 4:1",), ("0 5:1",), ("10 6:1",), ("1",)], "value string")
    assert rows_of(sampling.duplicate_positive_lines(lines)) == [
        ("0 3:1 4:1",), ("0 5:1",), ("0",), ("1 3:1 4:1",), ("1",), ("10 6:1",),
    ]


def positions(df):
    return [r["id"] for r in df.collect()]


def test_shuffle_with_key_is_repeatable_and_mixed(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("v"))
    one = positions(sampling.shuffle_rows(rows, 8, ["id"]))
    assert one == positions(sampling.shuffle_rows(rows.repartition(3), 8, ["id"]))
    assert sorted(one) == list(range(5000))
    assert one != positions(sampling.shuffle_rows(rows, 8, ["id"], seed=43))
    climbs = sum(a < b for a, b in zip(one, one[1:])) / 5000
    assert 0.45 < climbs < 0.55


def test_shuffle_spreads_a_large_group_of_equal_rows(spark):
    rows = spark.range(9000).select(F.when(F.col("id") < 3000, -1).otherwise(F.col("id")).alias("id"))
    mixed = sampling.shuffle_rows(rows, 8)
    assert Counter(positions(mixed)) == Counter(positions(rows))
    shares = mixed.groupBy(F.spark_partition_id()).agg(F.avg((F.col("id") == -1).cast("int")).alias("s")).collect()
    assert len(shares) == 8 and all(0.2 < r["s"] < 0.47 for r in shares)
    order = positions(mixed)
    neighbours = sum(a == b == -1 for a, b in zip(order, order[1:]))
    assert neighbours < 1800


def test_split(spark):
    rows = sampling.with_split(spark.range(4000), 20, ["id"])
    counts = dict(rows_of(rows.groupBy("split").count()))
    assert set(counts) == {"train", "valid"} and abs(counts["valid"] / 4000 - 0.2) < 0.03
    assert sampling.with_split(spark.range(50), 0, ["id"]).where("split = 'valid'").count() == 0


def test_draws_without_key_differ_between_copies(spark):
    copies = spark.range(2000).select(F.lit(1).alias("v"))
    kept = sampling.sample_union(copies, parse_conditions("v:1:0.5")).count()
    assert 800 < kept < 1200

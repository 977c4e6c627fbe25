from collections import Counter

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrprep.sources import tables, text


def test_fixed_point_goes_through_single_precision(impressions):
    got = tables.extract(impressions, ["rid", "price_index"], ["s", "f"])
    assert [r[1] for r in got.orderBy("rid").collect()] == [1233, 50000, 50000, 1999, 1233, 89999]
    assert got.schema["price_index"].dataType == T.LongType()
    exact = tables.extract(impressions, ["rid", "price_index"], ["s", "f"], precision="double")
    assert [r[1] for r in exact.orderBy("rid").collect()] == [1234, 50000, 50000, 2000, 1234, 90000]


@pytest.mark.parametrize(
    "columns, types", [(["nope"], ["s"]), (["rid"], ["x"]), (["rid", "article"], ["s"])]
)
def test_bad_extraction_raises_before_running(impressions, columns, types):
    with pytest.raises(ValueError):
        tables.extract(impressions, columns, types)


def test_partition_bound_prunes_directories(spark, impressions, tmp_path):
    path = str(tmp_path / "t")
    impressions.withColumn("dt", 20170810 + F.col("rid")).write.partitionBy("dt").parquet(path)
    recent = tables.extract(tables.since(spark.read.parquet(path), "20170814"), ["rid"])
    assert rows_of(recent) == [(4,), (5,), (6,)]
    assert "PartitionFilters: [isnotnull(dt" in plan_of(recent)
    assert "ReadSchema: struct<rid:int>" in plan_of(recent)
    assert rows_of(tables.on(spark.read.parquet(path), 20170811), "rid") == [(1,)]


def test_filter_and_projection_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = plan_of(tables.extract(tables.since(orders, "1998-01-01", "o_orderdate"), ["o_orderkey"]))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def fields(**kinds):
    return T.StructType([T.StructField(name, kind()) for name, kind in kinds.items()])


SCHEMA = fields(label=T.StringType, article=T.StringType, shelf=T.IntegerType, extra=T.StringType)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_trailing_fields_kept_or_dropped(spark):
    line = lines(spark, "1\x01a1\x014\x01")
    assert rows_of(text.parse_lines(line, SCHEMA)) == [("1", "a1", 4, "")]
    dropped = text.parse_lines(line, SCHEMA, keep_trailing=False, short_rows="null")
    assert rows_of(dropped) == [("1", "a1", 4, None)]
    assert rows_of(text.parse_lines(line, SCHEMA, keep_trailing=False)) == []


def test_short_rows(spark):
    given = lines(spark, "1\x01a1", "0\x01a2\x01x\x01e")
    assert rows_of(text.parse_lines(given, SCHEMA)) == [("0", "a2", None, "e")]
    assert rows_of(text.parse_lines(given, SCHEMA, ["article"])) == [("a1",), ("a2",)]
    assert rows_of(text.parse_lines(given, SCHEMA, short_rows="null"), "article", "shelf") == [
        ("a1", None),
        ("a2", None),
    ]
    assert rows_of(text.reject_counts(given, 4)) == [(2, 1)]
    with pytest.raises(ValueError):
        text.parse_lines(given, SCHEMA, ["nope"])


def test_separator_is_literal(spark):
    schema = fields(a=T.StringType, b=T.StringType)
    assert rows_of(text.parse_lines(lines(spark, "x.y|z"), schema, separator="|")) == [("x.y", "z")]
    assert rows_of(text.parse_lines(lines(spark, "x.y"), schema, separator=".")) == [("x", "y")]


def test_text_round_trip(spark, impressions, tmp_path):
    path = str(tmp_path / "lines")
    text.write_lines(text.to_lines(impressions, ["rid", "article"]), path)
    text.write_lines(text.to_lines(impressions, ["rid", "article"]), path)
    back = text.parse_lines(text.read_lines(spark, path), fields(rid=T.IntegerType, article=T.StringType))
    assert rows_of(back) == rows_of(impressions, "rid", "article")
    assert not any(r[0].endswith("\t") for r in text.read_lines(spark, path).collect())


def test_overwrite_spares_the_parent_folder(spark, impressions, tmp_path):
    text.write_lines(text.to_lines(impressions, ["rid"]), str(tmp_path / "a"))
    text.write_lines(text.to_lines(impressions, ["rid"]), str(tmp_path / "b"))
    assert spark.read.text(str(tmp_path / "a")).count() == 6


def test_field_of_lines(spark):
    given = lines(spark, "1\tx\t2", "2\ty", "3", "4\tx")
    assert rows_of(text.field_of_lines(given, 1).distinct()) == [("x",), ("y",)]


def test_feature_map_file_last_line_wins(spark, tmp_path):
    path = tmp_path / "map.txt"
    path.write_text("ctr 22 126 145450669 2845486\narticle\ta1\t7\nshort 1\narticle,a1,9\narticle a2 8\n")
    assert rows_of(text.read_feature_map_text(spark, str(path), None), "name", "value", "id") == [
        ("article", "a1", 9),
        ("article", "a2", 8),
        ("ctr", "22", 126),
    ]


def test_feature_map_round_trip(spark, tmp_path):
    odd = ["x", "4-NOT SPECIFIED", "a,b", "tab\there", "line\nend", "", "é ü"]
    entries = spark.createDataFrame([("c d", v, k) for k, v in enumerate(odd)], "name string, value string, id long")
    path = str(tmp_path / "featuremap")
    text.write_feature_map(entries, path)
    assert rows_of(text.read_feature_map(spark, path)) == rows_of(entries)


def test_text_map_is_strict(spark, tmp_path):
    entries = spark.createDataFrame([("c", "a b", 1), ("c", "a,b", 2), ("c", "", 3)], "name string, value string, id long")
    path = str(tmp_path / "featuremap")
    text.write_feature_map_text(entries, path, single_file=True)
    assert rows_of(text.read_feature_map_text(spark, path)) == rows_of(entries)
    for broken in ("a\tb", "a\nb"):
        with pytest.raises(Exception, match="not a text-map value"):
            text.write_feature_map_text(entries.withColumn("value", F.lit(broken)), path)
    with pytest.raises(Exception, match="no id"):
        text.parse_feature_map(lines(spark, "c\tv\tx"), separator="\t").collect()


def test_column_union_keeps_first_places():
    assert tables.column_union([["a", "b"], [" b", "c"], ["a"]]) == ["a", "b", "c"]


def test_attach_part(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "k int, v string")
    right = spark.createDataFrame([(1, "own", 5), (3, "own", 6)], "k int, v string, w int")
    assert rows_of(tables.attach_part(left, right, ["k"], "left", {"w": -1})) == [
        (1, "x", 5),
        (2, "y", -1),
        (2, "z", -1),
    ]
    assert rows_of(tables.attach_part(left, right, ["k"], "inner")) == [(1, "x", 5)]
    with pytest.raises(ValueError):
        tables.attach_part(left, right, ["nope"])


def test_a_hot_join_key_under_adaptive_execution(spark):
    """A third of the rows share one key; every one of its rows finds its match."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        left = spark.range(300000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
        right = spark.range(300000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = tables.attach_part(left, right, ["k"], "left")
        assert joined.where("w = k * 2").count() == 300000
    finally:
        for name in settings:
            spark.conf.unset(name)


def spread_of(df):
    """The largest share of the rows in one partition."""
    sizes = [r[0] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)").collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture(scope="module")
def parts(spark):
    """A third of the rows of each side share key 0, except that ``few`` has it once and ``none`` lacks it."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    left = spark.range(60000).select(hot.alias("k"), F.col("id").alias("a")).cache()
    few = spark.range(60000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
    none = spark.range(1, 60000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("c"))
    null = spark.range(60000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("d"))
    return left, few, none, null


@pytest.mark.parametrize("how", tables.JOIN_TYPES)
def test_frequent_keys_join_as_others_do(spark, parts, how):
    left, few, none, null = parts
    for one, other in ((left, few), (few, left), (left, none), (none, left), (left, null), (null, left)):
        got = tables.attach_part(one, other, ["k"], how)
        expected = one.join(other, "k", how)
        assert got.columns == expected.columns
        assert got.exceptAll(expected.select(got.columns)).isEmpty() and got.count() == expected.count()


def test_frequent_keys_are_spread(spark, parts):
    left, few, none, _ = parts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        chained = tables.attach_part(tables.attach_part(left, few, ["k"]), none, ["k"])
        assert spread_of(chained) < 0.25
        assert spread_of(tables.attach_part(left, few, ["k"], "full")) < 0.25
        assert spread_of(tables.attach_part(few, left, ["k"], "left")) < 0.25
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_cells_do_not_depend_on_the_order_of_rows(spark, monkeypatch):
    """A task that gets its rows again, in another order, sends them to the same tasks; equal rows still part."""
    monkeypatch.setattr(tables, "_HOT_ROWS", 100)
    right = spark.createDataFrame([(0, "x"), (1, "y")], "k long, w string").coalesce(1)
    rows = [(0, k // 40) for k in range(4000)] + [(1, -1)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        places = []
        for given in (rows, rows[::-1]):
            left = spark.createDataFrame(given, "k long, v long").coalesce(1)
            joined = tables.attach_part(left, right, ["k"], "left")
            places.append(rows_of(joined.withColumn("at", F.spark_partition_id())))
        assert places[0] == places[1] and len(places[0]) == len(rows)
        assert all(len({r[3] for r in places[0] if r[:2] == (0, v)}) > 1 for v in range(100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_unknown_join_type_raises(spark, parts):
    with pytest.raises(ValueError):
        tables.attach_part(parts[0], parts[1], ["k"], "outerish")


def counted(spark, df, read):
    """``df`` through a task that counts its rows into ``read`` whenever it is evaluated."""
    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema)


@pytest.mark.parametrize("hows", [("left", "left", "inner", "left"), ("left", "full", "inner", "right")])
def test_chains_read_every_part_a_fixed_number_of_times(spark, hows):
    """Five parts of which two have a frequent key that the others have once, and all have others: two readings for the frequent keys and one for the rows."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    frames = [
        spark.range(30000).select(hot.alias("k"), F.col("id").alias("a")),
        spark.range(10, 25000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b")),
        spark.range(20000).select(F.when(F.col("id") < 6000, 12346).when(F.col("id") == 6001, 0).when(F.col("id") % 9 > 0, F.col("id")).alias("k"), F.col("id").alias("c")),
        spark.range(30000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("d")),
        spark.range(28000).select((F.col("id") + 5).alias("k"), (F.col("id") % 5).alias("e")),
    ]
    expected = frames[0]
    for df, how in zip(frames[1:], hows):
        expected = expected.join(df, "k", how)
    expected = expected.groupBy("k", "a", "b", "c", "d", "e").count()
    reads = [spark.sparkContext.accumulator(0) for _ in frames]
    own = [counted(spark, df, read) for df, read in zip(frames, reads)]
    joined = tables.attach_parts(own[0], [tables.Part(df, ["k"], how) for df, how in zip(own[1:], hows)])
    rows = joined.groupBy("k", "a", "b", "c", "d", "e").count().collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, expected.collect()))
    for df, read in zip(frames, reads):
        assert read.value == 3 * df.count()


def test_parts_with_maps_and_several_keys(spark, monkeypatch):
    """Map columns travel along; a frequent pair of keys is spread; types that differ are joined plainly."""
    monkeypatch.setattr(tables, "_HOT_ROWS", 100)
    n = F.col("id")
    left = spark.range(4000).select((n % 2).alias("k"), F.when(n % 4 == 0, "x").otherwise(n.cast("string")).alias("v"), F.create_map(F.lit("n"), n % 3).alias("m"))
    right = spark.range(3).select(n.alias("k"), F.lit("x").alias("v"), (n + 10).alias("w"))
    got = tables.attach_part(left, right, ["k", "v"], "left", {"w": -1}).groupBy("k", "v", "w", F.col("m")["n"].alias("n")).count()
    expected = left.join(right, ["k", "v"], "left").fillna({"w": -1}).groupBy("k", "v", "w", F.col("m")["n"].alias("n")).count()
    assert rows_of(got) == rows_of(expected)
    narrow = right.select(F.col("k").cast("int").alias("k"), "w").where("w = 10")
    assert tables.attach_part(left, narrow, ["k"]).where("w = 10").count() == 2000


def test_partitions_are_pruned(spark, tmp_path):
    """A bound and a fixed value of the partition column reach the scan; files of other partitions are not read."""
    path = str(tmp_path / "days")
    spark.range(100).select("id", (F.col("id") % 10 + 20240300).cast("int").alias("dt"), F.lit(0.5).alias("price")).write.partitionBy("dt").parquet(path)
    days = tables.open_table(spark, path)
    for chosen, expected in ((tables.since(days, "20240307"), 3), (tables.on(days, "20240302"), 1)):
        got = tables.extract(chosen, ["id", "price"], ["s", "f"], 10)
        plan = plan_of(got)
        assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<id:bigint,price:double>" in plan
        assert got.count() == 10 * expected
        scan = got._jdf.queryExecution().executedPlan()
        got.collect()
        while scan.children().size():
            scan = scan.children().apply(0)
        assert scan.metrics().apply("numPartitions").value() == expected

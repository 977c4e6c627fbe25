import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from ctrprep.plans import PrepSpec, prepare, write_outputs
from ctrprep.plans.queries import RUN_SPEC, TEMPLATE_SPEC
from ctrprep.sources import text

INDEX_ONLY = {
    "name": "indexed",
    "partial": [{"name": "log", "table": "order_table", "columns": "label,article,shelf", "type": "s,s,s", "convert": "100000"}],
    "transform": [{"type": "SIMPLE_INDEX", "columns": "article,shelf"}],
    "format": [{"name": "out", "pattern": "libsvm"}],
}
WHOLE = {
    "name": "whole",
    "key": "rid",
    "partial": [{"name": "input", "table": "t", "columns": "label,article,shelf,price_index,rid", "type": "s,s,s,f,s", "convert": "100000"}],
    "transform": [
        {"args": "3:10000", "type": "INTERVAL_INDEX", "columns": "price_index"},
        {"type": "SIMPLE_INDEX", "columns": "shelf,article"},
    ],
    "format": [{"name": "samples", "pattern": "libsvm"}],
}


def changed(spec, **parts):
    return {**spec, **parts}


def lines(df):
    return sorted(r["value"] for r in df.collect())


def test_index_only_run_without_sampling(spark, impressions):
    run = prepare(spark, PrepSpec.from_dict(INDEX_ONLY), {"order_table": impressions})
    assert lines(run.samples["out"]) == [
        "0\t1:1\t4:1", "0\t1:1\t5:1", "0\t2:1\t4:1", "0\t2:1\t5:1", "1\t1:1\t4:1", "1\t3:1\t6:1",
    ]


def test_whole_run(spark, impressions):
    run = prepare(spark, PrepSpec.from_dict(WHOLE), {"t": impressions})
    assert lines(run.samples["samples"]) == sorted(
        ["1\t7:1\t4:1\t1:1", "0\t8:1\t5:1\t2:1", "0\t7:1\t4:1\t2:1",
         "1\t9:1\t6:1\t1:1", "0\t8:1\t4:1\t1:1", "0\t7:1\t5:1\t3:1"])


def test_sampling_modes_of_a_run(spark, impressions):
    shrink = [{"name": "s", "args": "shelf:4:1 article:a1:1"}]
    for mode, count in (("union", 6), ("any", 4), ("keep_unmatched", 6)):
        args = shrink if mode != "keep_unmatched" else [{"name": "s", "args": "shelf:4:1"}]
        spec = PrepSpec.from_dict(changed(WHOLE, shrink=args, sample_mode=mode))
        assert prepare(spark, spec, {"t": impressions}).rows.count() == count


def test_outputs_on_disk(spark, impressions, tmp_path):
    spec = PrepSpec.from_dict(changed(WHOLE, format=[
        {"name": "samples", "pattern": "libsvm", "validate_rate": 50},
        {"name": "tpl", "pattern": "${1} ${2}:1", "columns": "label,article_id", "shuffle": True},
    ]))
    run = prepare(spark, spec, {"t": impressions})
    (tmp_path / "neighbour").mkdir()
    for _ in range(2):
        write_outputs(run, str(tmp_path), text_map=True)
    assert (tmp_path / "neighbour").exists()
    assert lines(spark.read.text(str(tmp_path / "tpl"))) == ["0 7:1", "0 7:1", "0 8:1", "0 8:1", "1 7:1", "1 9:1"]
    both = spark.read.text(str(tmp_path / "samples"))
    assert both.count() == 6 and set(rows_of(both.select("split").distinct())) <= {("train",), ("valid",)}
    assert "article\ta1\t7" in lines(spark.read.text(str(tmp_path / "featuremap")))


def test_layout_of_a_templated_run():
    layout = PrepSpec.from_dict(TEMPLATE_SPEC).all_columns()
    assert layout[-28:-24] == ["supplier_n", "line_id", "supplier_id", "leaf0"]
    assert layout[-1] == "leaf24"


def test_statistics_need_a_label(spark, impressions):
    assert prepare(spark, PrepSpec.from_dict(WHOLE), {"t": impressions}).statistics is None
    transform = [{"type": "SIMPLE_INDEX", "columns": "article", "label": "label"}]
    run = prepare(spark, PrepSpec.from_dict(changed(WHOLE, transform=transform)), {"t": impressions})
    assert rows_of(run.statistics) == [("article", "a1", 3, 1), ("article", "a2", 2, 0), ("article", "a3", 1, 1)]


def test_templates_are_filled_once_and_shuffled_narrow(spark, lineitem):
    from ctrprep.plans.queries import template_run

    plan = plan_of(template_run(spark, "/root/testdata/sf0.001"))
    assert plan.count("replace(replace(") <= 7 and "Exchange RoundRobinPartitioning" in plan
    shuffled = plan.split("Exchange RoundRobinPartitioning")[1].splitlines()[1]
    assert "Filter" in shuffled and "Contains(value#" in shuffled


def test_encoded_frame_has_the_declared_layout(spark, lineitem):
    from ctrprep.plans.queries import _lineitem, nation_model

    folder = "/root/testdata/sf0.001"
    spec = PrepSpec.from_dict(TEMPLATE_SPEC)
    run = prepare(spark, spec, {"impressions": _lineitem(spark, folder)}, {"nation_model": nation_model(spark, folder)})
    assert sorted(run.encoded.columns) == sorted(spec.all_columns())


def test_parts_are_joined_with_defaults(spark, impressions):
    extra = spark.createDataFrame([("a1", 3.5)], "article string, score double")
    spec = PrepSpec.from_dict({
        "name": "two",
        "partial": [
            {"name": "a", "table": "t", "columns": "label,article", "type": "s,s"},
            {"name": "b", "table": "x", "columns": "article,score", "type": "s,f", "convert": 10,
             "joint": "article", "default_values": {"score": -1}},
        ],
        "transform": [{"type": "SIMPLE_INDEX", "columns": "article,score"}],
        "format": [{"name": "out", "pattern": "libsvm"}],
    })
    run = prepare(spark, spec, {"t": impressions, "x": extra})
    assert run.rows.columns == ["label", "article", "score"]
    assert {r["value"]: r["id"] for r in run.feature_map.of("score").collect()} == {"-1": 4, "35": 5}
    assert lines(run.samples["out"])[0] == "0\t1:1\t5:1"


def test_catalog_tables_and_paths(spark, impressions, tmp_path):
    impressions.createOrReplaceTempView("order_table")
    assert prepare(spark, PrepSpec.from_dict(INDEX_ONLY)).samples["out"].count() == 6
    path = str(tmp_path / "p")
    impressions.write.parquet(path)
    partial = [{**INDEX_ONLY["partial"][0], "table": path}]
    assert prepare(spark, PrepSpec.from_dict(changed(INDEX_ONLY, partial=partial))).samples["out"].count() == 6


@pytest.mark.parametrize(
    "change",
    [
        {"transform": [{"type": "MYSTERY", "columns": "article"}]},
        {"transform": [{"type": "SIMPLE_INDEX", "columns": "nope"}]},
        {"transform": [{"type": "SIMPLE_INDEX", "columns": "article,article"}]},
        {"transform": [{"type": "INTERVAL_INDEX", "columns": "price_index", "args": "0:1"}]},
        {"transform": [{"type": "SIMPLE_INDEX", "columns": "article", "label": "a"}, {"type": "SIMPLE_INDEX", "columns": "shelf", "label": "b"}]},
        {"transform": [{"type": "SIMPLE_INDEX", "columns": "article", "label": "nope"}]},
        {"shrink": [{"name": "s", "args": "nope:1:1"}]},
        {"shrink": [{"name": "s", "args": "article:1"}]},
        {"shrink": [{"name": "s", "args": "article:a1:1"}], "key": ""},
        {"sample_mode": "most"},
        {"missing_rows": "maybe"},
        {"noise": [{"columns": "nope", "to": "n", "value": "u", "factor": "0.1"}]},
        {"noise": [{"columns": "article", "to": "label", "value": "u", "factor": "0.1"}], "transform": [{"type": "SIMPLE_INDEX", "columns": "article", "to": "label"}]},
        {"format": [{"name": "f", "pattern": "${1}", "columns": "nope"}]},
        {"format": [{"name": "f", "pattern": "${1}"}]},
        {"format": [{"name": "f", "pattern": "${1}", "columns": "label", "random_column": "article", "random_ratio": "0.1"}]},
        {"partial": [{"name": "i", "table": "t", "columns": "a,b", "type": "s"}]},
        {"partial": [{"name": "i", "table": "t", "columns": "a,b", "type": "s,q"}]},
        {"partial": []},
        {"key": "nope"},
    ],
)
def test_bad_specs_raise(change):
    with pytest.raises(ValueError):
        PrepSpec.from_dict(changed(WHOLE, **change))


def test_run_reads_only_what_it_needs(spark, lineitem):
    typed = lineitem.withColumn("label", F.when(F.col("l_returnflag") == "R", "1").otherwise("0"))
    run = prepare(spark, PrepSpec.from_dict(RUN_SPEC), {"impressions": typed})
    plan = plan_of(run.samples["samples"])
    assert "l_tax" not in plan and "l_comment" not in plan
    assert "((l_linenumber#" in plan and "DataFilters: [isnotnull(l_shipdate#" in plan and "Or(EqualTo(l_linenumber," in plan
    assert "GreaterThanOrEqual(l_shipdate" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("lineitem.parquet") == 1


def test_an_unknown_setting_raises():
    for broken in (
        changed(INDEX_ONLY, transfrom=[]),
        changed(INDEX_ONLY, format=[{"name": "out", "pattern": "libsvm", "validate_rte": 5}]),
        changed(INDEX_ONLY, transform=[{"type": "SIMPLE_INDEX", "column": "article", "columns": "article"}]),
    ):
        with pytest.raises(ValueError, match="unknown setting"):
            PrepSpec.from_dict(broken)


def test_format_names_must_differ_and_leave_other_outputs_alone():
    one = {"name": "out", "pattern": "libsvm"}
    for formats, message in (([one, one], "one name"), ([{**one, "name": "featuremap"}], "taken"), ([{**one, "name": "statistics"}], "taken")):
        with pytest.raises(ValueError, match=message):
            PrepSpec.from_dict(changed(INDEX_ONLY, format=formats))


def test_bucket_mode_of_a_run(spark, impressions):
    interval = {"args": "3", "type": "INTERVAL_INDEX", "columns": "price_index"}
    ids = {}
    for mode in ("exact", "even"):
        spec = PrepSpec.from_dict(changed(WHOLE, transform=[{**interval, "bucket_mode": mode}]))
        run = prepare(spark, spec, {"t": impressions})
        ids[mode] = {r["value"]: r["id"] for r in run.feature_map.entries.collect()}
    assert ids == {
        "exact": {"1233": 1, "1999": 1, "50000": 2, "89999": 3},
        "even": {"1233": 0, "1999": 1, "50000": 2, "89999": 2},
    }
    with pytest.raises(ValueError, match="bucket_mode"):
        PrepSpec.from_dict(changed(WHOLE, transform=[{**interval, "bucket_mode": "clamped"}]))


def test_configured_target_and_partitions(spark, impressions, tmp_path):
    fmt = [{"name": "samples", "pattern": "libsvm", "shuffle": True, "numreduces": "3"}]
    spec = PrepSpec.from_dict(changed(WHOLE, hdfs_path=str(tmp_path), format=fmt))
    run = prepare(spark, spec, {"t": impressions})
    assert run.samples["samples"].rdd.getNumPartitions() == 3
    write_outputs(run)
    assert spark.read.text(str(tmp_path / "whole" / "samples")).count() == 6
    with pytest.raises(ValueError, match="no target"):
        write_outputs(prepare(spark, PrepSpec.from_dict(WHOLE), {"t": impressions}))


@pytest.mark.parametrize("stored_map", [False, True])
def test_a_given_map_encodes_other_rows(spark, impressions, tmp_path, stored_map):
    spec = PrepSpec.from_dict(WHOLE)
    first = prepare(spark, spec, {"t": impressions.where("rid <> 4")})
    given = first.feature_map
    if stored_map:
        write_outputs(first, str(tmp_path))
        given = text.read_feature_map(spark, str(tmp_path / "featuremap"))
    second = prepare(spark, spec, {"t": impressions}, feature_map=given)
    assert second.feature_map is None
    known = {(r["name"], r["value"]): r["id"] for r in first.feature_map.entries.collect()}
    for r in second.encoded.collect():
        for column in ("shelf", "article", "price_index"):
            assert r[f"{column}_id"] == known.get((column, str(r[column])))


def test_statistics_are_written_and_the_map_comes_from_them(spark, impressions, tmp_path):
    transform = [{**t, "label": "label"} for t in WHOLE["transform"]]
    labelled = prepare(spark, PrepSpec.from_dict(changed(WHOLE, transform=transform)), {"t": impressions})
    plain = prepare(spark, PrepSpec.from_dict(WHOLE), {"t": impressions})
    assert rows_of(labelled.feature_map.entries) == rows_of(plain.feature_map.entries)
    write_outputs(labelled, str(tmp_path))
    written = spark.read.parquet(str(tmp_path / "statistics"))
    assert ("article", "a1", 3, 1) in rows_of(written, "name", "value", "pv", "click")
    assert written.agg(F.sum("pv")).first()[0] == 18


def test_several_formats_share_the_encoded_rows(spark, impressions):
    formats = [{"name": n, "pattern": "libsvm"} for n in ("one", "two")]
    run = prepare(spark, PrepSpec.from_dict(changed(WHOLE, format=formats)), {"t": impressions})
    assert lines(run.samples["one"]) == lines(run.samples["two"])
    assert "Join" not in plan_of(run.samples["two"])

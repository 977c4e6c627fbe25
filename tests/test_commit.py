"""Outputs of a run that become visible together."""

from dataclasses import replace

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from ctrprep.plans import PrepSpec, commit_outputs, prepare, read_run
from ctrprep.sources.commit import Target

SPEC = {
    "name": "shop",
    "partial": [{"name": "t", "table": "t", "columns": "label,article,shelf", "type": "s,s,s"}],
    "transform": [{"type": "SIMPLE_INDEX", "columns": "article,shelf", "label": "label"}],
    "format": [{"name": "one", "pattern": "libsvm"}, {"name": "two", "pattern": "${1} ${2}", "columns": "label,article_id"}],
}


def prepared(spark, rows):
    return prepare(spark, PrepSpec.from_dict(SPEC), {"t": rows})


def test_a_committed_run_is_read_back(spark, impressions, tmp_path):
    run, home = prepared(spark, impressions), str(tmp_path / "out")
    assert commit_outputs(run, home) == 1
    found = read_run(spark, home)
    assert sorted(found) == ["featuremap", "one", "statistics", "two"]
    assert rows_of(found["featuremap"]) == rows_of(run.feature_map.entries)
    assert rows_of(found["statistics"]) == rows_of(run.statistics)
    for name in ("one", "two"):
        assert rows_of(found[name]) == rows_of(run.samples[name])


def test_a_failure_between_map_and_samples_leaves_the_run_before(spark, impressions, tmp_path):
    home = str(tmp_path / "out")
    commit_outputs(prepared(spark, impressions), home)
    before = {name: rows_of(df) for name, df in read_run(spark, home).items()}
    broken = prepared(spark, impressions.where("rid < 4"))
    lines = broken.samples["two"].withColumn("value", F.raise_error(F.lit("no more disk")).cast("string"))
    with pytest.raises(Exception, match="no more disk"):
        commit_outputs(replace(broken, samples=broken.samples | {"two": lines}), home)
    # The map and the first samples of the broken run are there, and nothing lists them.
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 2
    assert {name: rows_of(df) for name, df in read_run(spark, home).items()} == before
    assert commit_outputs(prepared(spark, impressions.where("rid < 4")), home) == 2
    assert read_run(spark, home)["one"].count() == 3
    assert {name: rows_of(df) for name, df in read_run(spark, home, 1).items()} == before


def test_old_runs_go_and_unlisted_folders_stay(spark, impressions, tmp_path):
    home = str(tmp_path / "out")
    (tmp_path / "out" / "runs" / "being-written").mkdir(parents=True)
    for _ in range(3):
        commit_outputs(prepared(spark, impressions), home, keep=2)
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 3
    with pytest.raises(FileNotFoundError):
        read_run(spark, home, 1)
    assert read_run(spark, home, 2)["one"].count() == 6


def test_two_runs_that_finish_at_once_get_numbers_of_their_own(spark, tmp_path, monkeypatch):
    target = Target(spark, str(tmp_path / "out"))
    assert target.commit(target.new_run(), {"a": "lines"}) == 1
    # Both have seen no earlier run.
    monkeypatch.setattr(target, "_numbers", lambda: [])
    assert target.commit(target.new_run(), {"b": "lines"}) == 2
    monkeypatch.undo()
    assert target.manifest(1)["outputs"] == {"a": "lines"} and target.manifest()["outputs"] == {"b": "lines"}
    with pytest.raises(FileNotFoundError):
        Target(spark, str(tmp_path / "none")).manifest()

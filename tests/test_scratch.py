import os

import pytest

from ctrprep.sources import scratch


def test_stored_tables_can_be_released(spark):
    stored = scratch.store(spark.range(5), "kept")
    path = stored.inputFiles()[0].removeprefix("file:").replace("//", "/")
    assert scratch.is_stored(stored) and not scratch.is_stored(spark.range(1))
    assert os.path.exists(path) and stored.count() == 5
    scratch.release(stored, spark.range(1))
    assert not os.path.exists(path)


class _Cluster:
    """A session whose master is a cluster's."""

    def __init__(self, spark, settings):
        self._spark, self._settings, self.conf = spark, settings, self
        self.sparkContext = self

    master = "spark://somewhere"

    def get(self, name, default):
        return self._settings.get(name, default)

    def __getattr__(self, name):
        return getattr(self._spark.sparkContext, name)

    def getCheckpointDir(self):
        return None


def test_clusters_need_a_folder_that_all_machines_share(spark):
    with pytest.raises(RuntimeError, match="set spark.checkpoint.dir"):
        scratch.shared_folder(_Cluster(spark, {}))
    local = {"spark.checkpoint.dir": "file:///tmp/x/"}
    with pytest.raises(RuntimeError, match="one machine"):
        scratch.shared_folder(_Cluster(spark, local))
    mounted = local | {"spark.ctrprep.sharedFileSystem": "true"}
    assert scratch.shared_folder(_Cluster(spark, mounted)) == "file:///tmp/x"


class _Opened(_Cluster):
    """A cluster whose set folder Spark has opened, on machines that keep a share of the written rows to themselves."""

    def __init__(self, spark, settings, lost=0):
        super().__init__(spark, settings)
        self._lost, self.read = lost, spark.read

    def getCheckpointDir(self):
        return self._settings["spark.checkpoint.dir"] + "/opened"

    def range(self, start, end, step, parts):
        return self._spark.range(start, end - self._lost, step, parts)


def test_clusters_take_an_opened_folder_that_gives_the_rows_back(spark, tmp_path):
    """Without a setting of ours: a folder on a mount has scheme file, too."""
    folder = f"file://{tmp_path}/shared"
    assert scratch.shared_folder(_Opened(spark, {"spark.checkpoint.dir": folder})) == folder
    assert not [names for _, _, names in os.walk(tmp_path) if names]


def test_an_opened_folder_that_loses_rows_is_refused(spark, tmp_path):
    kept = {"spark.checkpoint.dir": f"file://{tmp_path}/kept"}
    with pytest.raises(RuntimeError, match="one machine"):
        scratch.shared_folder(_Opened(spark, kept, lost=1))


def test_a_folder_is_tried_again_with_more_executors(spark, tmp_path):
    """The first executors may share a machine with the driver; those that come later may not."""
    cluster = _Opened(spark, {"spark.checkpoint.dir": f"file://{tmp_path}/shared"})
    scratch.shared_folder(cluster)
    cluster._lost = 1
    scratch.shared_folder(cluster)
    cluster.defaultParallelism = spark.sparkContext.defaultParallelism + 2
    with pytest.raises(RuntimeError, match="one machine"):
        scratch.shared_folder(cluster)

"""Outputs that become visible together.

What a run writes goes to a folder of its own, and a manifest that lists it comes last, under the next number in the target's
folder of manifests. Readers take what the newest manifest lists: a run that fails on the way leaves nothing to be read, and the run
before stays readable as it was. A manifest gets its name by a rename that does not replace anything, so of two runs that
finish at once each gets a number of its own.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

_RUNS, _MANIFESTS = "runs", "manifests"
_NAME = re.compile(r"([0-9]{10})\.json\Z")


class Target:
    """A folder of committed runs, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, home: str) -> None:
        self.home = home.rstrip("/")
        self._java = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._system = self._path(self.home).getFileSystem(self._conf)

    def new_run(self) -> str:
        """The folder of a run that is about to be written."""
        return f"{self.home}/{_RUNS}/{uuid.uuid4().hex}"

    def commit(self, run: str, outputs: Mapping[str, str]) -> int:
        """List ``outputs`` (their kind by name) of the folder ``run`` as the newest run; its number."""
        folder = self._path(f"{self.home}/{_MANIFESTS}")
        self._system.mkdirs(folder)
        temporary = self._path(f"{self.home}/{_MANIFESTS}/.{uuid.uuid4().hex}")
        stream = self._system.create(temporary, False)
        stream.write(json.dumps({"run": run.rsplit("/", 1)[-1], "outputs": dict(outputs)}).encode())
        stream.close()
        files = self._java.org.apache.hadoop.fs.FileContext.getFileContext(self._system.getUri(), self._conf)
        nothing = self._gateway.new_array(self._java.org.apache.hadoop.fs.Options.Rename, 0)
        number = max(self._numbers(), default=0)
        while True:
            number += 1
            final = self._path(f"{self.home}/{_MANIFESTS}/{number:010d}.json")
            try:
                files.rename(self._system.makeQualified(temporary), self._system.makeQualified(final), nothing)
                return number
            except Exception:
                # Another run has taken the number, or the rename has really failed.
                if not self._system.exists(final) or not self._system.exists(temporary):
                    raise

    def manifest(self, number: int | None = None) -> dict:
        """The newest manifest, or the one of that number: ``run``, ``outputs`` and the ``path`` of the run's folder."""
        numbers = self._numbers()
        if not numbers or (number is not None and number not in numbers):
            raise FileNotFoundError(f"no committed run {'' if number is None else number} in {self.home}")
        stream = self._system.open(self._manifest(max(numbers) if number is None else number))
        try:
            found = json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()
        return found | {"path": f"{self.home}/{_RUNS}/{found['run']}"}

    def forget(self, keep: int) -> None:
        """Remove all but the newest ``keep`` runs. Folders that no manifest lists may be of runs still being written, and stay."""
        for number in sorted(self._numbers())[: -keep or None]:
            gone = self.manifest(number)
            self._system.delete(self._manifest(number), False)
            self._system.delete(self._path(gone["path"]), True)

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.home}/{_MANIFESTS}")
        if not self._system.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._system.listStatus(folder)]
        return [int(m[1]) for m in map(_NAME.match, names) if m]

    def _manifest(self, number: int):
        return self._path(f"{self.home}/{_MANIFESTS}/{number:010d}.json")

    def _path(self, name: str):
        return self._java.org.apache.hadoop.fs.Path(name)

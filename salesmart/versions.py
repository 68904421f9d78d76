"""Sets of tables that are replaced as one.

A run writes all its tables to a fresh version folder and then publishes that by one small manifest
file; readers take the newest manifest and read the folder it names. A run that dies between two
tables leaves nothing that a reader would see, and readers that began before a publication go on
with the files they know.

    <folder>/_manifests/0000000001.json    {"version": "v-...", "tables": {"sales_fact": 120, ...}}
    <folder>/v-.../sales_fact/part-...

Manifests are numbered. A writer creates the next number and fails if that exists already, so of
two runs that publish at the same time one is told so. The file appears under its number by a
rename, hence complete or not at all.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from salesmart.workspace import Workspace

MANIFESTS = "_manifests"


class PublishConflict(RuntimeError):
    """Another run has published since this one began."""


class Versions:
    """The versions of a set of tables in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.folder}/{name}" if name else self.folder)

    def _numbers(self) -> list[int]:
        """Numbers of the manifests, oldest first."""
        where = self._path(MANIFESTS)
        if not self._files.exists(where):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(where)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def _manifest(self, number: int) -> dict:
        text = self.spark.read.text(f"{self.folder}/{MANIFESTS}/{number:010d}.json", wholetext=True)
        return json.loads(text.first()[0])

    def begin(self) -> Version:
        """A fresh folder for the tables of a run; its number is the next after what is there."""
        number = max(self._numbers(), default=0) + 1
        return Version(self, Workspace(self.spark, f"{self.folder}/v-{uuid.uuid4().hex}"), number)

    def current(self) -> dict | None:
        """The newest manifest."""
        numbers = self._numbers()
        return self._manifest(numbers[-1]) if numbers else None

    def read(self, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """Published tables, all of one version."""
        manifest = self.current()
        if manifest is None:
            raise FileNotFoundError(f"nothing is published in {self.folder}")
        return {
            name: self.spark.read.parquet(f"{self.folder}/{manifest['version']}/{name}")
            for name in names or manifest["tables"]
        }

    def prune(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` published versions, and what dead runs left from before
        the oldest of these. Returns the names of the deleted folders.

        Runs that have not published yet have begun later and stay: their folders are younger.
        """
        numbers = self._numbers()
        if keep < 1 or not numbers:
            raise ValueError("keep at least one published version")
        kept = {self._manifest(number)["version"] for number in numbers[-keep:]}
        first = self._path(f"{MANIFESTS}/{numbers[-keep:][0]:010d}.json")
        oldest = self._files.getFileStatus(first).getModificationTime()
        gone = []
        for number in numbers[:-keep]:
            self._files.delete(self._path(f"{MANIFESTS}/{number:010d}.json"), False)
        for status in self._files.listStatus(self._path("")):
            name = status.getPath().getName()
            if name.startswith("v-") and name not in kept and status.getModificationTime() < oldest:
                self._files.delete(status.getPath(), True)
                gone.append(name)
        return gone


class Version:
    """Tables of a run that are not published yet."""

    def __init__(self, versions: Versions, workspace: Workspace, number: int):
        self.versions, self.workspace, self.number = versions, workspace, number

    def publish(self, rows: Mapping[str, int]) -> int:
        """Make the tables visible, with their numbers of rows; returns the number of the manifest."""
        v = self.versions
        for name in rows:
            if not v._files.exists(v._hadoop.Path(f"{self.workspace.folder}/{name}/_SUCCESS")):
                raise FileNotFoundError(f"{name} is not written whole")
        version = self.workspace.folder.rsplit("/", 1)[1]
        text = json.dumps({"version": version, "tables": dict(rows)})
        fresh = v._path(f"{MANIFESTS}/.{uuid.uuid4().hex}")
        stream = v._files.create(fresh, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        final = v._path(f"{MANIFESTS}/{self.number:010d}.json")
        # A rename replaces nothing on a distributed store; a local one may, so ask as well.
        if v._files.exists(final) or not v._files.rename(fresh, final):
            v._files.delete(fresh, False)
            raise PublishConflict(f"version {self.number} of {v.folder} was published by another run")
        return self.number

"""Numbered commits in a shared folder: one small JSON file each, put only where none is yet."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another run has committed since the state was read."""


@dataclass(frozen=True)
class CommitLog:
    """The state of a table or a job, as the newest of its commits.

    Each commit holds the whole state, which has to stay small, so that older ones can go: the
    newest ``keep`` stay. A commit is written aside and renamed, so a reader never meets half a
    file. Two writers that have read the same commit both try the next number; the second one
    fails. That takes a file system whose rename does not replace a file, as HDFS; on others
    (plain local folders, some object stores) writers at the very same moment can both succeed.
    """

    spark: SparkSession
    path: str
    keep: int = 16

    def _files(self) -> Any:
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder, files = self._files()
        if not files.exists(folder):
            return []
        names = [found.getPath().getName() for found in files.listStatus(folder)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def latest(self) -> tuple[int, dict[str, Any]]:
        """(number, state) of the newest commit; (-1, {}) before the first."""
        found = self.versions()
        return (found[-1], self.read(found[-1])) if found else (-1, {})

    def read(self, version: int) -> dict[str, Any]:
        jvm = self.spark.sparkContext._jvm
        _, files = self._files()
        stream = files.open(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{version:020d}.json"))
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, version: int, state: Mapping[str, Any]) -> None:
        """Make ``state`` the commit ``version``: the one after the commit that was read."""
        path_of = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        folder, files = self._files()
        files.mkdirs(folder)
        aside, final = path_of(f"{self.path}/.{uuid.uuid4().hex}"), path_of(f"{self.path}/{version:020d}.json")
        out = files.create(aside, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if files.exists(final) or not files.rename(aside, final):
            files.delete(aside, False)
            raise CommitConflict(f"commit {version} of {self.path} exists: another run was faster")
        if version >= self.keep:
            files.delete(path_of(f"{self.path}/{version - self.keep:020d}.json"), False)

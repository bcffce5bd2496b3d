"""Incremental state: the last mark of each job, kept in a commit log."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any
from urllib.parse import quote

from pyspark.sql import SparkSession

from tidemark.sinks.commits import CommitLog

def state_id(job_id: str, query: str | None = None) -> str:
    """The key of a job's state: the job id, or job id and query, so that a
    changed query starts from its own state."""
    return job_id if query is None else f"{job_id}-{hashlib.md5(query.encode()).hexdigest()}"


@dataclass
class StateTable:
    """One commit log per job. A run that reads the mark and then stores a new one fails with
    ``CommitConflict`` where another run of the job has stored one in between."""

    spark: SparkSession
    path: str
    _seen: dict[str, int] = field(default_factory=dict)

    def _log(self, job_id: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.path.rstrip('/')}/job={quote(job_id, safe='')}")

    def read(self, job_id: str, default: Any = None, from_first: bool = False) -> Any:
        """The stored mark. ``from_first`` starts over from ``default``."""
        self._seen[job_id], state = self._log(job_id).latest()
        return default if "mark" not in state or from_first else _decode(state["mark"])

    def commit(self, job_id: str, mark: Any) -> None:
        """Store the mark. Call it after the output was written: a crash in between
        replays the increment, it never skips one."""
        log = self._log(job_id)
        seen = self._seen.get(job_id)
        version = (log.latest()[0] if seen is None else seen) + 1
        log.commit(version, {"mark": _encode(mark)})
        self._seen[job_id] = version


def _encode(mark: Any) -> str:
    if isinstance(mark, datetime):
        return json.dumps({"time": mark.isoformat()})
    return json.dumps({"value": mark})


def _decode(text: str) -> Any:
    found = json.loads(text)
    return datetime.fromisoformat(found["time"]) if "time" in found else found["value"]

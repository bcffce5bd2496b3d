"""Files that grow: a stream that reads only what was added.

The offset of the stream maps each file to the byte up to which its records are known to be whole.
Finding that byte reads the end of a file only: back to its last line break, or with a record head
to the last line that opens a record, because that record may still go on. A file that nobody has
touched for ``idle_s`` seconds is taken to its end. New bytes are cut into ranges of ``split_bytes``
that tasks read side by side; a record belongs to the range in which it starts.

A restart goes on at the offset in the checkpoint and reads no earlier byte. On a local disk a file
is known by its inode, so a renamed (rotated) file goes on where it was; elsewhere by its path. A
file that got shorter is read anew from its first byte. Files that are gone leave the offset.
"""

from __future__ import annotations

import os
import re
import time
from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.fs as pfs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

TAIL_SCHEMA = "path string, file_id string, pointer bigint, record string"
CHUNK = 1 << 16
SPLIT_BYTES = 1 << 27
BATCH_RECORDS = 2048
# Parts of a file's entry in the offset.
PATH, BYTE, GENERATION = 0, 1, 2


def _open(path: str) -> tuple[pfs.FileSystem, str]:
    return pfs.FileSystem.from_uri(path) if "://" in path else (pfs.LocalFileSystem(), path.removeprefix("file:"))


def _lines(source: Any, at: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(start, line with its break) from byte ``at`` on, up to byte ``end``."""
    source.seek(at)
    rest, start, read = b"", at, at
    while read < end:
        data = source.read(min(CHUNK * 16, end - read))
        if not data:
            break
        read += len(data)
        *whole, rest = (rest + data).split(b"\n")
        for line in whole:
            yield start, line + b"\n"
            start += len(line) + 1
    if rest:
        yield start, rest


class _Records:
    """How bytes become records: a line each, or lines up to the next one that has a head."""

    def __init__(self, head: str | None, encoding: str):
        self.head = re.compile(head) if head else None
        self.encoding = encoding

    def text(self, line: bytes) -> str:
        return line.decode(self.encoding, errors="replace").rstrip("\r\n")

    def opens(self, line: bytes) -> bool:
        return self.head is None or self.head.search(self.text(line)) is not None

    def whole_until(self, source: Any, start: int, size: int) -> int:
        """The last byte up to which records are whole, not before ``start``."""
        begin, tail = size, b""
        complete = None
        while begin > start:
            step = max(start, begin - CHUNK)
            source.seek(step)
            tail = source.read(begin - step) + tail
            begin = step
            if complete is None:
                last = tail.rfind(b"\n")
                if last < 0:
                    continue
                complete = begin + last + 1
                tail = tail[:last + 1]
                if self.head is None:
                    return complete
            # Lines that start in what was read; the first piece may be the end of a longer line.
            at = len(tail)
            while at > 0:
                line_start = tail.rfind(b"\n", 0, at - 1) + 1
                if line_start == 0 and begin > start:
                    break
                if self.opens(tail[line_start:at]):
                    return begin + line_start
                at = line_start
            tail = tail[:at]
        return start

    def read(self, source: Any, first: int, begin: int, until: int, end: int) -> Iterator[tuple[int, str]]:
        """(start, record) of the records that start within ``begin`` to ``until``; ``first`` starts one in any case."""
        at = begin
        if begin > first:
            # The line that goes on at this byte belongs to the range before.
            at = next((start + len(line) for start, line in _lines(source, begin - 1, end)), end)
        opened, place = [], -1
        for start, line in _lines(source, at, end):
            if start == first or self.opens(line):
                if opened:
                    yield place, "\n".join(opened)
                    opened = []
                if start >= until:
                    return
                opened, place = [self.text(line)], start
            elif opened:
                opened.append(self.text(line))
            elif start >= until:
                return
        if opened:
            yield place, "\n".join(opened)


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.pattern = re.compile(options.get("pattern", ".*"))
        self.recursive = options.get("recursive", "false") == "true"
        self.idle = float(options["idle_s"]) if "idle_s" in options else None
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.records = _Records(options.get("head"), options.get("encoding", "UTF-8"))
        self.known: dict[str, list] = {}

    def _listed(self) -> Iterator[tuple[str, str, int, float]]:
        """(id, path, size, time of the last change) of the files there are."""
        files, folder = _open(self.folder)
        scheme = self.folder[:-len(folder)] if self.folder.endswith(folder) else ""
        for info in files.get_file_info(pfs.FileSelector(folder, recursive=self.recursive, allow_not_found=True)):
            if info.type == pfs.FileType.File and self.pattern.fullmatch(info.base_name):
                name = info.path
                if isinstance(files, pfs.LocalFileSystem):
                    try:
                        name = f"inode {os.stat(info.path).st_ino}"
                    except FileNotFoundError:
                        continue
                yield name, scheme + info.path, info.size, info.mtime_ns / 1e9

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        found, now = {}, time.time()
        for name, path, size, changed in self._listed():
            _, start, generation = self.known.get(name, (path, 0, 0))
            if size < start:
                start, generation = 0, generation + 1
            if self.idle is not None and now - changed >= self.idle:
                upto = size
            elif size == start:
                upto = start
            else:
                files, place = _open(path)
                with files.open_input_file(place) as source:
                    upto = self.records.whole_until(source, start, size)
            found[name] = [path, upto, generation]
        self.known = found
        return {"files": found}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # After a restart this is asked first, with the newest offset of the checkpoint.
        self.known = dict(end["files"])
        ranges = []
        for name, (path, upto, generation) in sorted(end["files"].items()):
            before = start["files"].get(name)
            first = before[BYTE] if before and before[GENERATION] == generation else 0
            for at in range(first, upto, self.split):
                ranges.append(InputPartition((name, path, first, at, min(at + self.split, upto), upto)))
        return ranges

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        name, path, first, begin, until, end = partition.value
        files, place = _open(path)
        with files.open_input_file(place) as source:
            held: list[tuple[int, str]] = []
            for found in self.records.read(source, first, begin, until, end):
                held.append(found)
                if len(held) == BATCH_RECORDS:
                    yield self._batch(path, name, held)
                    held = []
            if held:
                yield self._batch(path, name, held)

    @staticmethod
    def _batch(path: str, name: str, held: list[tuple[int, str]]) -> pa.RecordBatch:
        starts, records = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * len(held)), pa.array([name] * len(held)), pa.array(starts, pa.int64()), pa.array(records, pa.string())],
            names=["path", "file_id", "pointer", "record"],
        )


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_tail"

    def schema(self) -> str:
        return TAIL_SCHEMA

    def streamReader(self, schema: StructType) -> TailReader:
        return TailReader(dict(self.options))


def tail_files(
    spark: SparkSession, path: str, pattern: str = ".*", head_regex: str | None = None, idle_s: float | None = None,
    encoding: str = "UTF-8", recursive: bool = False, split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """The records of all files of a folder as a stream: ``path``, ``file_id``, ``pointer`` (byte at which it starts), ``record``.

    ``head_regex`` is found in the lines that open a record; without it each line is one. Lines before
    the first head of a file are a record. The encoding must keep byte 10 for the line break. A file
    is only expected to get longer.
    """
    spark.dataSource.register(TailSource)
    options = {"path": path, "pattern": pattern, "encoding": encoding, "recursive": str(recursive).lower(), "split_bytes": str(split_bytes)}
    if head_regex is not None:
        options["head"] = head_regex
    if idle_s is not None:
        options["idle_s"] = str(idle_s)
    return spark.readStream.format(TailSource.name()).options(**options).load()

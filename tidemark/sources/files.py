"""Files: selection, text lines with their place, CSV, multi-line records, archives."""

from __future__ import annotations

import io
import re
import tarfile
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime, timedelta
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions import date_from_name, ntz


def select_files(
    spark: SparkSession,
    path: str,
    prefix: str = "",
    suffix: str = "",
    regex: str | None = None,
    recursive: bool = False,
    date_prefix: str | None = None,
    after: datetime | None = None,
    min_age_s: int = 0,
    now: datetime | None = None,
) -> DataFrame:
    """The files to read: ``path``, ``file_name``, ``length``, ``modification_time``.

    ``date_prefix`` with ``after`` keeps files whose name carries a later date
    behind that prefix; ``min_age_s`` leaves out files that may still be written.
    Only the listing is read, not the contents.
    """
    if min_age_s and now is None:
        raise ValueError("min_age_s needs now")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    listing = reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        F.col("modificationTime").cast("timestamp_ntz").alias("modification_time"),
    )
    name = F.col("file_name")
    if prefix:
        listing = listing.filter(name.startswith(prefix))
    if suffix:
        listing = listing.filter(name.endswith(suffix))
    if regex:
        listing = listing.filter(name.rlike(f"^(?:{regex})$"))
    if date_prefix is not None and after is not None:
        listing = listing.filter(date_from_name(name, date_prefix) > ntz(after))
    if min_age_s:
        listing = listing.filter(F.col("modification_time") < ntz(now - timedelta(seconds=min_age_s)))
    return listing


def paths_of(files: DataFrame) -> list[str]:
    """Paths for a reader. The driver lists files for any read anyway, so this
    holds names only, never contents."""
    return sorted(r["path"] for r in files.select("path").collect())


def with_file_meta(df: DataFrame) -> DataFrame:
    """Add where each record came from. ``df`` must be a file read."""
    meta = F.col("_metadata")
    return df.select(
        "*",
        meta["file_path"].alias("file_path"),
        meta["file_name"].alias("file_name"),
        meta["file_size"].alias("file_size"),
        meta["file_modification_time"].cast("timestamp_ntz").alias("file_time"),
        meta["file_block_start"].alias("block_start"),
    )


def text_lines(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """Lines with their place: ``line``, ``file_path``, ``block_start``, ``line_seq``.

    Files are cut into blocks and read in parallel; (``block_start``,
    ``line_seq``) orders the lines of a file. Other encodings are decoded per
    line, which is right for all that keep byte 10 for the line break.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    text = F.col("value")
    unix = F.when(text.endswith("\r"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    place = raw.select(
        (unix if _is_utf8(encoding) else text).alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.octet_length(F.col("value")).alias("line_bytes"),
        F.monotonically_increasing_id().alias("line_seq"),
    )
    if _is_utf8(encoding):
        return place

    # The session's settings (``settle``) allow all charsets of the JVM.
    decoded = F.decode(F.col("line").cast("binary"), encoding)
    return place.withColumn("line", F.regexp_replace(decoded, r"\r+\z", ""))


def _is_utf8(encoding: str) -> bool:
    return encoding.upper().replace("-", "") == "UTF8"


BLOCK = ("file_path", "block_start")


def _in_block() -> Window:
    """Window over one block in line order. A block is a file split, so its size
    is set by ``spark.sql.files.maxPartitionBytes`` and not by the file."""
    return Window.partitionBy(*BLOCK).orderBy("line_seq")


def _sum_before_block(lines: DataFrame, amount: Any, name: str) -> DataFrame:
    """Per block: the sum of ``amount`` over all earlier blocks of the file."""
    per_block = lines.groupBy(*BLOCK).agg(F.sum(amount).alias("_amount"))
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    return per_block.select(*BLOCK, F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias(name))


def with_pointer(lines: DataFrame, name: str = "pointer") -> DataFrame:
    """The byte offset at which each line starts in its file."""
    size = F.col("line_bytes") + F.lit(1)
    before = _sum_before_block(lines, size, "_before")
    run = F.coalesce(F.sum(size).over(_in_block().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return lines.withColumn("_run", run).join(before, list(BLOCK)).withColumn(
        name, F.col("_before") + F.col("_run")
    ).drop("_before", "_run")


def from_pointer(lines: DataFrame, pointer: int) -> DataFrame:
    """Lines that start at byte ``pointer`` or later: a restart inside a file."""
    return with_pointer(lines).filter(F.col("pointer") >= pointer)


PIECES = "file_path string, block_start bigint, heads bigint, at_edge boolean, record string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of whole blocks, in order, to the pieces of records that each block holds.

    ``heads`` is the number of heads in the block up to the piece. A piece is at
    the edge when its record may go on in another block.
    """
    place: tuple[str, int] | None = None
    heads, opened = 0, []

    for batch in batches:
        found: list[tuple] = []
        code = batch.column(0).dictionary_encode()
        names, code = code.dictionary.to_pylist(), code.indices.to_numpy(zero_copy_only=False)
        block = batch.column(1).to_numpy(zero_copy_only=False)
        lines, marks = batch.column(2), batch.column(3).to_numpy(zero_copy_only=False)
        cuts = (np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1).tolist()
        for start, end in zip([0, *cuts], [*cuts, len(block)]):
            if start == end:
                continue
            here = (names[code[start]], int(block[start]))
            if here != place:
                if opened:
                    found.append((*place, heads, True, "\n".join(opened)))
                place, heads, opened = here, 0, []
            at = start + np.flatnonzero(marks[start:end])
            opened += lines.slice(start, (at[0] if len(at) else end) - start).to_pylist()
            if not len(at):
                continue
            if opened:
                found.append((*place, heads, heads == 0, "\n".join(opened)))
            between = pa.ListArray.from_arrays(pa.array(at, type=pa.int32()), lines)
            for i, record in enumerate(pc.binary_join(between, "\n").to_pylist(), 1):
                found.append((*place, heads + i, False, record))
            heads += len(at)
            opened = lines.slice(at[-1], end - at[-1]).to_pylist()
        yield _piece_batch(found)
    if opened:
        yield _piece_batch([(*place, heads, True, "\n".join(opened))])


def _piece_batch(found: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
    cols = zip(*found) if found else [[]] * len(types)
    names = ["file_path", "block_start", "heads", "at_edge", "record"]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names=names)


def multiline_scan(spark: SparkSession, path: str | list[str], head_regex: str, encoding: str = "UTF-8") -> DataFrame:
    """Records of several lines: ``file_path``, ``record_no``, ``record``.

    A line in which ``head_regex`` is found opens a record. Each task puts the
    lines of its blocks together as it reads them, so text is not shuffled; heads
    are counted per block and the counts of earlier blocks added. Only the first
    and the last piece of a block can belong to a record that goes on in another
    block, and only these are brought together. Lines before the first head form
    record 0.
    """
    lines = text_lines(spark, path, encoding)
    pieces = lines.select(*BLOCK, "line", F.col("line").rlike(head_regex).alias("head")).mapInArrow(_pieces, PIECES)
    edges = pieces.filter("at_edge")
    # The last piece of a block has counted all heads of the block.
    most = edges.groupBy(*BLOCK).agg(F.max("heads").alias("_most"))
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    before = most.select(*BLOCK, F.coalesce(F.sum("_most").over(earlier), F.lit(0)).alias("_before"))

    def numbered(some: DataFrame) -> DataFrame:
        return some.join(before, list(BLOCK)).withColumn("record_no", F.col("_before") + F.col("heads"))

    parts = F.sort_array(F.collect_list(F.struct("block_start", "record")))
    whole = numbered(pieces.filter("not at_edge")).select("file_path", "record_no", "record")
    ends = numbered(edges).groupBy("file_path", "record_no").agg(
        F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record")
    )
    return whole.unionByName(ends)


def csv_scan(
    spark: SparkSession,
    path: str | list[str],
    mapping: Mapping[int, str],
    skip_lines: int = 0,
    sep: str = ",",
    quote: str = '"',
    encoding: str = "UTF-8",
) -> DataFrame:
    """Cells by position. A position past the end of a row gives null; a doubled
    quote inside a quoted cell stands for one."""
    width = max(mapping) + 1
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    cells = [F.col(f"_c{i}").alias(name) for i, name in mapping.items()]
    if skip_lines <= 1 and _is_utf8(encoding):
        reader = spark.read.schema(schema).options(sep=sep, quote=quote, escape=quote, mode="PERMISSIVE")
        return reader.csv(path, header=skip_lines == 1, enforceSchema=True).select(*cells)

    lines = text_lines(spark, path, encoding)
    if skip_lines:
        # Blocks that begin within the lines to skip: mostly the first one of each file.
        early = _sum_before_block(lines, F.lit(1), "_before").filter(F.col("_before") < skip_lines)
        number = F.col("_before") + F.row_number().over(_in_block())
        kept = lines.join(early, list(BLOCK)).withColumn("_no", number).filter(F.col("_no") > skip_lines)
        lines = kept.select(*lines.columns).unionByName(lines.join(early, list(BLOCK), "left_anti").select(*lines.columns))
    parsed = F.from_csv(F.col("line"), schema.simpleString()[len("struct<"):-1].replace(":", " "),
                        {"sep": sep, "quote": quote, "escape": quote})
    return lines.filter(F.trim("line") != "").select(parsed.alias("r")).select("r.*").select(*cells)


ARCHIVE_LINES = "path string, member string, line_no bigint, line string"
# Lines that a task hands on at once.
LINES = 4096


class _Shared(io.RawIOBase):
    """A file of the shared storage with the manners of a local one: no place before its start can be sought."""

    def __init__(self, source: Any):
        self.source, self.length = source, source.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.source.tell()

    def seek(self, at: int, whence: int = 0) -> int:
        at += (0, self.source.tell(), self.length)[whence]
        if at < 0:
            raise OSError("before the start of the file")
        self.source.seek(at)
        return at

    def readinto(self, into: Any) -> int:
        data = self.source.read(len(into))
        into[:len(data)] = data
        return len(data)

    def close(self) -> None:
        self.source.close()
        super().close()


def open_input(path: str) -> io.BufferedReader:
    """A file of the shared storage that can be read at any place."""
    import pyarrow.fs as pfs

    if "://" in path:
        files, place = pfs.FileSystem.from_uri(path)
    else:
        files, place = pfs.LocalFileSystem(), path.removeprefix("file:")
    return io.BufferedReader(_Shared(files.open_input_file(place)), 1 << 16)


def zip_members(paths: DataFrame, member_regex: str | None = None) -> DataFrame:
    """``path``, ``member``, ``size`` of the files in zip archives. Only the directory at an archive's end is read."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = re.compile(member_regex) if member_regex else None
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_input(path) as data, zipfile.ZipFile(data) as archive:
                    found = [i for i in archive.infolist() if not i.is_dir() and (wanted is None or wanted.search(i.filename))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found), pa.string()), pa.array([i.filename for i in found], pa.string()), pa.array([i.file_size for i in found], pa.int64())],
                    names=["path", "member", "size"],
                )

    return paths.select("path").mapInArrow(listed, "path string, member string, size bigint")


def _numbered(path: str, member: str, lines: Iterator[str]) -> Iterator[pa.RecordBatch]:
    at, held = 0, []
    for line in lines:
        held.append(line.rstrip("\r\n"))
        if len(held) == LINES:
            yield _line_batch(path, member, at, held)
            at, held = at + LINES, []
    if held:
        yield _line_batch(path, member, at, held)


def _line_batch(path: str, member: str, at: int, lines: list[str]) -> pa.RecordBatch:
    n = len(lines)
    columns = [pa.array([path] * n), pa.array([member] * n), pa.array(range(at, at + n), pa.int64()), pa.array(lines, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["path", "member", "line_no", "line"])


def archive_scan(
    spark: SparkSession,
    path: str,
    kind: str = "zip",
    password: str | None = None,
    member_regex: str | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Lines of the members of zip or tar.gz files: ``path``, ``member``, ``line_no``, ``line``.

    Members of zip archives are dealt out over the cluster: a task reads the bytes of its own members
    from the shared storage, wherever in an archive they lie, line by line. A tar.gz is one compressed
    stream, so one task reads it, from its path and line by line. No archive and no member is ever held
    whole.
    """
    if kind not in ("zip", "tar.gz"):
        raise ValueError(f"kind must be 'zip' or 'tar.gz', got {kind!r}")
    paths = spark.read.format("binaryFile").load(path).select("path")

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["path", "member"]).to_pylist()
            for name in dict.fromkeys(r["path"] for r in rows):
                # The directory of an archive is read once for all members of it that are here.
                with open_input(name) as data, zipfile.ZipFile(data) as archive:
                    for member in (r["member"] for r in rows if r["path"] == name):
                        with archive.open(member, pwd=password.encode() if password else None) as stream:
                            yield from _numbered(name, member, io.TextIOWrapper(stream, encoding=encoding, errors="replace", newline="\n"))

    def untar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = re.compile(member_regex) if member_regex else None
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with open_input(name) as data, tarfile.open(fileobj=data, mode="r:gz") as archive:
                    for info in archive:
                        if info.isfile() and (wanted is None or wanted.search(info.name)):
                            lines = io.TextIOWrapper(archive.extractfile(info), encoding=encoding, errors="replace", newline="\n")
                            yield from _numbered(name, info.name, lines)

    if kind == "tar.gz":
        return paths.repartition("path").mapInArrow(untar, ARCHIVE_LINES)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = zip_members(paths, member_regex)
    return members.repartition(parts, "path", "member").sortWithinPartitions("path", "member").mapInArrow(unzip, ARCHIVE_LINES)


def file_read_options(prefix: str = "", suffix: str = "", modified_before: datetime | None = None) -> dict[str, str]:
    """Reader options for a plain prefix/suffix/age selection: no listing needed."""
    options = {"pathGlobFilter": f"{prefix}*{suffix}"}
    if modified_before is not None:
        options["modifiedBefore"] = modified_before.strftime("%Y-%m-%dT%H:%M:%S")
    return options


def read_selected(spark: SparkSession, files: DataFrame, schema: T.StructType | str, fmt: str = "parquet",
                  **options: str) -> DataFrame:
    """Read the files that ``select_files`` found."""
    paths: Sequence[str] = paths_of(files)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).options(**options).load(list(paths))

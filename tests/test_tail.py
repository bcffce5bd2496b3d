"""Files that grow while a stream reads them, run by run."""

import io
import os
import random

import pytest

from tidemark.sources.tail import _Records, tail_files
from tidemark.streaming import drain

HEAD = r"^\[\d+\]"


def run(spark, tmp_path, **how):
    """One run over what is there: the records it adds, as (file, pointer, record)."""
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    before = {tuple(r) for r in spark.read.schema("path string, pointer bigint, record string").parquet(out).collect()} if os.path.exists(out) else set()
    stream = tail_files(spark, str(tmp_path / "in"), **how).select("path", "pointer", "record")
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    drain(query)
    assert query.exception() is None
    after = [tuple(r) for r in spark.read.schema("path string, pointer bigint, record string").parquet(out).collect()]
    assert len(after) == len(set(after))
    return sorted((os.path.basename(p), at, text) for p, at, text in set(after) - before)


def put(tmp_path, name, text, mode="ab"):
    (tmp_path / "in").mkdir(exist_ok=True)
    with open(tmp_path / "in" / name, mode) as out:
        out.write(text if isinstance(text, bytes) else text.encode())


def test_lines_are_read_once_as_files_grow(spark, tmp_path):
    put(tmp_path, "a.log", "one\ntwo\nthr")
    put(tmp_path, "b.log", "x\r\n\ny")
    put(tmp_path, "c.tmp", "no\n")
    how = {"pattern": r".*\.log"}
    assert run(spark, tmp_path, **how) == [("a.log", 0, "one"), ("a.log", 4, "two"), ("b.log", 0, "x"), ("b.log", 3, "")]
    assert run(spark, tmp_path, **how) == []
    put(tmp_path, "a.log", "ee\nfour\nfi")
    assert run(spark, tmp_path, **how) == [("a.log", 8, "three"), ("a.log", 14, "four")]
    # A file at rest ends; what comes later is read from there.
    assert run(spark, tmp_path, idle_s=0, **how) == [("a.log", 19, "fi"), ("b.log", 4, "y")]
    put(tmp_path, "a.log", "ve\nsix\n")
    assert run(spark, tmp_path, **how) == [("a.log", 21, "ve"), ("a.log", 24, "six")]


def test_renamed_shorter_and_removed_files(spark, tmp_path):
    put(tmp_path, "a.log", "1\n2\n")
    put(tmp_path, "b.log", "long line\n")
    assert len(run(spark, tmp_path)) == 3
    os.rename(tmp_path / "in" / "a.log", tmp_path / "in" / "a.log.1")
    put(tmp_path, "a.log.1", "3\n")
    put(tmp_path, "a.log", "4\n")
    put(tmp_path, "b.log", "new\n", "wb")
    assert run(spark, tmp_path) == [("a.log", 0, "4"), ("a.log.1", 4, "3"), ("b.log", 0, "new")]
    os.remove(tmp_path / "in" / "a.log.1")
    assert run(spark, tmp_path) == []


def test_a_record_of_several_lines_stays_open_across_batches(spark, tmp_path):
    put(tmp_path, "a.log", "preamble\n[1] a\n more\n[2] b\n")
    how = {"head_regex": HEAD}
    assert run(spark, tmp_path, **how) == [("a.log", 0, "preamble"), ("a.log", 9, "[1] a\n more")]
    put(tmp_path, "a.log", " still b\n [9] no head\n[3")
    assert run(spark, tmp_path, **how) == []
    put(tmp_path, "a.log", "] c\n")
    assert run(spark, tmp_path, **how) == [("a.log", 21, "[2] b\n still b\n [9] no head")]
    assert run(spark, tmp_path, idle_s=0, **how) == [("a.log", 49, "[3] c")]


def test_a_restart_reads_no_earlier_byte(spark, tmp_path):
    put(tmp_path, "a.log", "first\nsecond\n")
    assert len(run(spark, tmp_path)) == 2
    # Nobody may look at these bytes again.
    with open(tmp_path / "in" / "a.log", "r+b") as out:
        out.write(b"xxxxx\nyyyyyy\n")
    put(tmp_path, "a.log", "third\n")
    assert run(spark, tmp_path) == [("a.log", 13, "third")]


@pytest.mark.parametrize("head", [None, HEAD])
def test_ranges_of_a_file_give_each_record_once(spark, tmp_path, head):
    rng = random.Random(5)
    text = "".join(rng.choice((f"[{i}] head", "line", "", "é" * 40)) + rng.choice(("\n", "\r\n")) for i in range(300))
    put(tmp_path, "a.log", text)
    whole = run(spark, tmp_path, head_regex=head, idle_s=0)
    (tmp_path / "again").mkdir()
    os.rename(tmp_path / "in", tmp_path / "again" / "in")
    assert run(spark, tmp_path / "again", head_regex=head, idle_s=0, split_bytes=97) == whole
    lines = [line for _, _, r in sorted(whole, key=lambda r: r[1]) for line in r.split("\n")]
    assert lines == text.replace("\r", "").split("\n")[:-1]


def test_where_records_are_whole(monkeypatch):
    from tidemark.sources import tail

    data = b"pre\n[1] a\nb\n[2] c\nddd\n[3"
    for chunk in (1, 2, 3, 7, 100):
        monkeypatch.setattr(tail, "CHUNK", chunk)
        source = io.BytesIO(data)
        assert _Records(None, "UTF-8").whole_until(source, 0, len(data)) == 22
        assert _Records(HEAD, "UTF-8").whole_until(source, 0, len(data)) == 12
        assert _Records(HEAD, "UTF-8").whole_until(source, 12, len(data)) == 12
        assert _Records(HEAD, "UTF-8").whole_until(source, 18, len(data)) == 18
        assert _Records(HEAD, "UTF-8").whole_until(source, 0, 11) == 4
        assert _Records(HEAD, "UTF-8").whole_until(source, 0, 3) == 0
        assert [r for r in _Records(HEAD, "UTF-8").read(source, 0, 0, 22, 22)] == [(0, "pre"), (4, "[1] a\nb"), (12, "[2] c\nddd")]

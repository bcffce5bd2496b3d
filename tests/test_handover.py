"""History and live feed as one stream: overlap, gap, order, and a restart in the overlap."""

from datetime import datetime, timedelta

from conftest import rows

from tidemark.streaming import EndMarks, closed_rows, drain, file_stream, write_closed
from tidemark.streaming.handover import end_history, history_then_live

SCHEMA = "seq bigint, at timestamp_ntz"


def at(minutes):
    return datetime(2024, 1, 1) + timedelta(minutes=minutes)


def test_each_change_is_taken_once(spark, tmp_path):
    old, live, out, checkpoint = (str(tmp_path / n) for n in ("old", "live", "out", "ckpt"))
    marks = EndMarks(spark, str(tmp_path / "marks"))

    def put(path, seqs):
        spark.createDataFrame([(s, None if s < 0 else at(s)) for s in seqs], SCHEMA).coalesce(1).write.mode("append").parquet(path)

    def run():
        schema = spark.read.parquet(old).schema
        both = history_then_live(
            file_stream(spark, old, schema, max_files=1), file_stream(spark, live, schema, max_files=1), ["seq"], "at", at(100), "60 minutes", marks
        )
        query = write_closed(both, out, checkpoint)
        drain(query)
        assert query.exception() is None
        state = sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"])
        return [r[0] for r in rows(closed_rows(spark, out, both.schema).select("seq"))], state

    # The newest history first, the live feed far ahead of what the history has by then.
    put(old, range(90, 130))
    put(live, [*range(100, 120), *range(300, 310)])
    assert sorted(run()[0]) == [*range(90, 130), *range(300, 310)]
    # A restart within the overlap: old rows without a time or before the seam, repeats on both sides.
    put(old, [-1, *range(0, 20), *range(120, 140)])
    put(live, [*range(110, 150), 305])
    taken, state = run()
    assert sorted(taken) == sorted([-1, *range(0, 20), *range(90, 150), *range(300, 310)])
    assert state > 0
    end_history(marks)
    put(live, [1000])
    run()
    put(live, [1001, 1000])
    taken, state = run()
    assert sorted(taken) == sorted([-1, *range(0, 20), *range(90, 150), *range(300, 310), 1000, 1001])
    assert state == 2

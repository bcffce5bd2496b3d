"""The end of a stream: a mark that moves the watermark past the windows that are still open.

A window is given out (append mode) when the watermark has passed it, so the last windows of a job
that ends would stay in its state. A mark is a record with nothing but a time. It goes through the
same watermark as the records and is taken out behind it.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.streaming.runs import file_stream

MARK = "_end_mark"
SCHEMA = "time timestamp_ntz"


class EndMarks:
    """Marks in a folder of their own. A mark is read by the next run of the stream, like any file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def attach(self, sdf: DataFrame, time: str) -> DataFrame:
        """The records and, with all fields but ``time`` null, the marks."""
        empty = self.spark.createDataFrame([], SCHEMA)
        # The folder has to be there before the stream looks for files.
        empty.write.mode("append").parquet(self.path)
        kind = dict(sdf.dtypes)[time]
        marks = file_stream(self.spark, self.path, empty.schema).select(F.col("time").cast(kind).alias(time), F.lit(True).alias(MARK))
        return sdf.withColumn(MARK, F.lit(False)).unionByName(marks, allowMissingColumns=True)

    def put(self, newest: datetime, window_s: int, delay_s: float = 0) -> None:
        """Mark the end behind the window that holds ``newest``, the newest time of the stream.

        Records that come later for a window that was given out are late.
        """
        start = datetime(1970, 1, 1)
        windows = (newest - start) // timedelta(seconds=window_s) + 1
        end = start + windows * timedelta(seconds=window_s) + timedelta(seconds=delay_s, milliseconds=1)
        self.spark.createDataFrame([(end,)], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def without_marks(sdf: DataFrame, time: str) -> DataFrame:
    """Take the marks out, behind ``withWatermark``. A stream without marks stays as it is."""
    if MARK not in sdf.columns:
        return sdf
    # The condition names the time, so that Spark does not move it to before the watermark.
    return sdf.filter(~F.col(MARK) | (F.col(time) < F.lit(datetime(1, 1, 1)))).drop(MARK)

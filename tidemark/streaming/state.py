"""Accumulators as the state of a stream: kept by key, given out and forgotten when their time is over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.times import bucket
from tidemark.operators.metrics import PAGE_EVENT, SEARCH_EVENT, SHOW_EVENT, behaviour_days, key_or_default
from tidemark.streaming.flush import MARK, without_marks


def stream_behaviour(
    sdf: DataFrame, order_cols: Sequence[str], delay: str = "0 seconds", user: str = "USER", time: str = "EVENT_TIME", event: str = "EVENT_KEY",
    search_word: str = "searchWords_var", scene: str = "XY_SCENE", create_time: str = "CREATE_TIME", update_time: str = "UPDATE_TIME",
    events: tuple[str, str, str] = (PAGE_EVENT, SEARCH_EVENT, SHOW_EVENT),
) -> DataFrame:
    """Behaviour of a user per day, as ``user_behaviour_metric``, given out once when the day is over (append mode).

    The watermark follows the ends of days: a day is closed when the newest day ends over ``delay`` after
    it, so with less than a day of delay the first record of the next day closes it. Records of an open day
    are never late. The state of a user's day is its vocabulary: a row per word, spread by word, with the
    first record that used it and counts. When the day is over its words meet, become the day's row and are
    gone. With ``EndMarks`` attached the last days come too.
    """
    page, search, show = events
    key = F.col(event)
    order = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)])
    head = F.struct(
        F.col(user).cast("string").alias("mobile"), F.col(create_time).cast("timestamp_ntz").alias("create_time"),
        F.col(update_time).cast("timestamp_ntz").alias("update_time"),
    )
    marked = [MARK] if MARK in sdf.columns else []
    rows = sdf.select(
        key_or_default(user).alias("metric"), bucket(time, "day").alias("data_time"), F.col(time).cast("timestamp_ntz").alias("at"),
        F.when(key == search, F.col(search_word)).when(key == show, F.col(scene)).alias("word"), order.alias("ord"), head.alias("head"),
        (key == page).alias("page"), *marked,
    )
    # A mark moves the watermark by its own time.
    closes = F.col("data_time") + F.expr("INTERVAL 1 DAY")
    moved = F.when(F.col(MARK), F.col("at")).otherwise(closes) if marked else closes
    # What equals the watermark is late, so it stays behind the newest day.
    watched = without_marks(rows.withColumn("watched", moved.cast("timestamp")).withWatermark("watched", f"{delay} 1 millisecond"), "watched")
    words = watched.groupBy("metric", "data_time", "watched", "word").agg(
        F.min(F.struct("ord", "head")).alias("first"), F.count_if("page").alias("pages"), F.count(F.lit(1)).alias("events")
    )
    return behaviour_days(words, ["metric", "data_time", "watched"])

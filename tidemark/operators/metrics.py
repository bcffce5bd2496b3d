"""The metrics engine: counts and accumulators per key and calendar window.

Every metric is one grouped aggregation. Spark adds up on the map side first, so
a key that holds a large part of all rows reaches the shuffle as one row per map
task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.functions import bucket, calendar_labels

UNKNOWN = "unknown"
LABELS = ("year", "month", "week", "day", "hour", "minute")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_or_default(key: Column | str, default: str = UNKNOWN) -> Column:
    """The key as text; ``default`` for a null or empty one."""
    text = _col(key).cast("string")
    return F.when(text.isNull() | (text == ""), F.lit(default)).otherwise(text)


def with_labels(df: DataFrame, time: str = "data_time", labels: Sequence[str] = LABELS) -> DataFrame:
    found = calendar_labels(time)
    return df.withColumns({name: found[name] for name in labels})


def key_metric(df: DataFrame, key: Column | str, default: str = UNKNOWN) -> DataFrame:
    """``metric``, ``count`` per key, without time."""
    return df.groupBy(key_or_default(key, default).alias("metric")).agg(F.count(F.lit(1)).alias("count"))


def key_time_metric(
    df: DataFrame, key: Column | str, time: Column | str, window_type: str,
    default: str = UNKNOWN, labels: Sequence[str] = LABELS,
) -> DataFrame:
    """``metric``, ``data_time`` (start of the window), ``count`` and time labels."""
    counted = df.groupBy(
        key_or_default(key, default).alias("metric"), bucket(time, window_type).alias("data_time")
    ).agg(F.count(F.lit(1)).alias("count"))
    return with_labels(counted, labels=labels)


def time_metric(df: DataFrame, key: Column | str, time: Column | str, window_type: str, **how) -> DataFrame:
    """Window first, key second. Persisted rows are those of ``key_time_metric``."""
    return key_time_metric(df, key, time, window_type, **how)


def time_key_metric(df: DataFrame, key: Column | str, time: Column | str, window_type: str, **how) -> DataFrame:
    """As ``time_metric``, with one text that names window and key."""
    rows = key_time_metric(df, key, time, window_type, **how)
    stamp = F.date_format("data_time", "yyyy-MM-dd HH:mm")
    return rows.withColumn("time_metric_key", F.concat_ws("_", stamp, "metric"))


def tumbling_metric(df: DataFrame, key: Column | str, time: Column | str, seconds: int, default: str = UNKNOWN) -> DataFrame:
    """Counts per key and window of a fixed number of seconds."""
    window = F.window(_col(time), f"{seconds} seconds")
    counted = df.groupBy(key_or_default(key, default).alias("metric"), window.alias("_w")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return counted.select("metric", F.col("_w.start").cast("timestamp_ntz").alias("data_time"), "count")


@dataclass(frozen=True)
class Mergeable:
    """An aggregate that can be put together out of parts, as streams and runs need it.

    ``part`` is an aggregate over records, ``merge`` one over the column that holds parts, and
    ``value`` what a part amounts to.
    """

    part: Column
    merge: Callable[[Column], Column]
    value: Callable[[Column], Column] = lambda part: part


def total_of(value: Column | str) -> Mergeable:
    return Mergeable(F.sum(_col(value)), F.sum)


def least_of(value: Column | str) -> Mergeable:
    return Mergeable(F.min(_col(value)), F.min)


def greatest_of(value: Column | str) -> Mergeable:
    return Mergeable(F.max(_col(value)), F.max)


def count_of(condition: Column) -> Mergeable:
    return Mergeable(F.count_if(condition), F.sum)


def mean_of(value: Column | str) -> Mergeable:
    """The mean, out of a sum and a count. Nulls do not count."""
    part = F.struct(F.sum(_col(value)).alias("sum"), F.count(_col(value)).alias("n"))

    def merge(parts: Column) -> Column:
        return F.struct(F.sum(parts["sum"]).alias("sum"), F.sum(parts["n"]).alias("n"))

    return Mergeable(part, merge, lambda part: part["sum"] / F.nullif(part["n"], F.lit(0).cast("bigint")))


def first_of(value: Column | str, *order: Column | str) -> Mergeable:
    """The value of the first record in this order."""
    row = F.struct(*[_col(c).alias(f"o{i}") for i, c in enumerate(order)], _col(value).alias("value"))
    return Mergeable(F.min(row), F.min, lambda part: part["value"])


@dataclass(frozen=True)
class MetricSpec:
    """One metric of a set that is computed over the same records.

    ``time`` is this metric's own event time (``None`` = the default of the
    set), ``window`` the calendar window (``None`` = no time). ``aggs`` are
    extra aggregate columns over columns of the input, named (over streams
    ``Mergeable`` ones); ``first`` are columns taken from the first record in
    ``order`` order.
    """

    name: str
    key: Column | str
    window: str | None = None
    time: Column | str | None = None
    where: Column | None = None
    default: str = UNKNOWN
    aggs: Mapping[str, Column | Mergeable] = field(default_factory=dict)
    first: Mapping[str, Column | str] = field(default_factory=dict)
    order: Sequence[str] = ()

    def entry(self, time: Column | str | None) -> Column:
        """Key and window of a record, null where the metric leaves it out."""
        own = self.time if self.time is not None else time
        when = F.lit(None).cast("timestamp_ntz")
        if self.window is not None:
            if own is None:
                raise ValueError(f"metric {self.name!r} has a window but no time")
            when = bucket(own, self.window)
        value = F.struct(key_or_default(self.key, self.default).alias("metric"), when.alias("data_time"))
        return value if self.where is None else F.when(self.where, value)


    def own_aggs(self) -> dict[str, Column | Mergeable]:
        """Extra columns by name: ``aggs``, and ``first`` as the value of the least record."""
        firsts = {
            name: first_of(value, *self.order) if self.order else Mergeable(F.min_by(_col(value), _col(value)), F.min) for name, value in self.first.items()
        }
        return {**self.aggs, **firsts}


def multi_metric(df: DataFrame, specs: Sequence[MetricSpec], time: Column | str | None = None,
                 labels: Sequence[str] = (), parts: bool = False) -> DataFrame:
    """Several metrics over the same records: one scan, one shuffle.

    With ``parts`` mergeable aggregates are left as parts, for ``merge_metrics``.

    Each record is unpivoted to one small row per metric, and all are aggregated
    at once. ``metric_type`` tells the metrics apart; an extra column is null on
    rows of a metric that does not have it.
    """
    names = {f"_metric_{i}": s.name for i, s in enumerate(specs)}
    if len(set(names.values())) < len(specs):
        raise ValueError("metric names must differ")
    needed = df.columns if any(s.aggs or s.first for s in specs) else []
    entries = [s.entry(time).alias(n) for n, s in zip(names, specs)]
    rows = df.select(*needed, *entries).unpivot(needed, list(names), "_metric", "_entry")
    if any(s.where is not None for s in specs):
        rows = rows.filter(F.col("_entry").isNotNull())
    found: dict[str, Column] = {}
    for mark, spec in zip(names, specs):
        mine = F.col("_metric") == mark
        for name, agg in spec.own_aggs().items():
            if isinstance(agg, Mergeable):
                agg = agg.part if parts else agg.value(agg.part)
            value = F.when(mine, agg)
            found[name] = F.coalesce(found[name], value) if name in found else value
    aggs = [F.count(F.lit(1)).alias("count"), *[c.alias(n) for n, c in found.items()]]
    totals = rows.select(*needed, "_metric", "_entry.*").groupBy("_metric", "metric", "data_time").agg(*aggs)
    title = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    out = totals.select(
        F.element_at(title, F.col("_metric")).alias("metric_type"), "metric", "data_time", "count", *found
    )
    return with_labels(out, labels=labels) if labels else out


def mergeable_of(specs: Sequence[MetricSpec]) -> dict[str, Mergeable]:
    """The extra columns of all metrics; a name stands for the same aggregate wherever it is used."""
    found: dict[str, Mergeable] = {}
    for spec in specs:
        for name, agg in spec.own_aggs().items():
            if not isinstance(agg, Mergeable):
                raise ValueError(f"{name!r} of metric {spec.name!r} cannot be put together out of parts: use a Mergeable")
            found.setdefault(name, agg)
    return found


def merge_metrics(partials: DataFrame, specs: Sequence[MetricSpec], done: bool = False) -> DataFrame:
    """One row per metric, key and window out of partial ones; with ``done`` parts become values."""
    aggs = mergeable_of(specs)
    merged = partials.groupBy("metric_type", "metric", "data_time").agg(
        F.sum("count").alias("count"), *[a.merge(F.col(n)).alias(n) for n, a in aggs.items()]
    )
    return merged.withColumns({n: a.value(F.col(n)) for n, a in aggs.items()}) if done and aggs else merged


def run_metric(run: DataFrame, state: DataFrame | None, keys: Sequence[str], reset: bool) -> DataFrame:
    """Counts after a run: of this run alone (``reset``), or added to those so far."""
    if reset or state is None:
        return run.select(*keys, "count")
    return merge_partials(state.select(*keys, "count").unionByName(run.select(*keys, "count")), keys)


def merge_partials(df: DataFrame, keys: Sequence[str], count: str = "count") -> DataFrame:
    """One row per key out of several partial rows."""
    return df.groupBy(*keys).agg(F.sum(count).alias(count))


def roll_up(df: DataFrame, window_type: str, keys: Sequence[str] = ("metric",)) -> DataFrame:
    """Counts per short window to counts per calendar window."""
    longer = df.withColumn("data_time", bucket("data_time", window_type))
    return merge_partials(longer, [*keys, "data_time"])


def counted(df: DataFrame, failed: Column | None = None, ignored: Column | None = None) -> tuple[DataFrame, Observation]:
    """Count records while they pass: total, success, failed, ignored.

    The numbers are in the observation after the first action on the frame.
    """
    no = F.lit(False)
    bad = no if failed is None else F.coalesce(failed, no)
    skipped = ~bad & (no if ignored is None else F.coalesce(ignored, no))
    seen = Observation()
    out = df.observe(
        seen,
        F.count(F.lit(1)).alias("total"),
        F.count_if(~bad & ~skipped).alias("success"),
        F.count_if(bad).alias("failed"),
        F.count_if(skipped).alias("ignored"),
    )
    return out, seen


def count_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).alias("count"))


# Events that the behaviour accumulator looks at (fixed values).
PAGE_EVENT = "$page"
SEARCH_EVENT = "xcxsearchEventClick"
SHOW_EVENT = "imp"


def behaviour_words(
    df: DataFrame,
    order_cols: Sequence[str],
    user: str = "USER",
    time: str = "EVENT_TIME",
    event: str = "EVENT_KEY",
    search_word: str = "searchWords_var",
    scene: str = "XY_SCENE",
    create_time: str = "CREATE_TIME",
    update_time: str = "UPDATE_TIME",
    events: tuple[str, str, str] = (PAGE_EVENT, SEARCH_EVENT, SHOW_EVENT),
) -> DataFrame:
    """Distinct words of a user's day: ``metric``, ``data_time``, ``word``, ``first``, ``pages``, ``events``.

    Parts of the records can be reduced one by one and put together by
    ``merge_behaviour_words``, as a stream does.
    """
    page, search, show = events
    key = F.col(event)
    word = F.when(key == search, F.col(search_word)).when(key == show, F.col(scene))
    order = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)])
    head = F.struct(
        F.col(user).alias("mobile"), F.col(create_time).alias("create_time"), F.col(update_time).alias("update_time")
    )
    return (
        df.select(
            key_or_default(user).alias("metric"), bucket(time, "day").alias("data_time"),
            word.alias("word"), order.alias("ord"), head.alias("head"), (key == page).alias("page"),
        )
        .groupBy("metric", "data_time", "word")
        .agg(
            F.min(F.struct("ord", "head")).alias("first"),
            F.count_if("page").alias("pages"),
            F.count(F.lit(1)).alias("events"),
        )
    )


def merge_behaviour_words(words: DataFrame) -> DataFrame:
    """One row per word of a user's day out of several partial ones."""
    return words.groupBy("metric", "data_time", "word").agg(
        F.min("first").alias("first"), F.sum("pages").alias("pages"), F.sum("events").alias("events")
    )


def behaviour_days(words: DataFrame, keys: Sequence[str] = ("metric", "data_time")) -> DataFrame:
    """Behaviour of a user per day, out of the distinct words of it; a stream's ``keys`` name its watermark too."""
    said = F.when(F.col("word").isNotNull(), F.struct(F.col("first.ord").alias("ord"), F.col("word").alias("word")))
    days = words.groupBy(*keys).agg(
        F.min("first").alias("first"),
        F.sum("pages").alias("active_level"),
        F.sum("events").alias("events"),
        F.sort_array(F.collect_list(said)).alias("said"),
    )
    return days.select(
        "metric", "data_time", "first.head.*", "active_level", _join_new_words("said").alias("qry_msg"), "events",
    )


def user_behaviour_metric(df: DataFrame, order_cols: Sequence[str], **columns: Any) -> DataFrame:
    """Behaviour of a user per day.

    ``mobile``, ``create_time``, ``update_time`` come from the first record in
    ``order_cols`` order, ``active_level`` counts page events, and ``qry_msg``
    joins search words and scenes by ``;`` in that order, leaving out a word that
    the text so far contains. ``columns`` are those of ``behaviour_words``.

    Only the first use of a word can add to the text, because the text never
    shrinks. So rows are reduced to distinct words first, spread by word over
    the cluster, and a busy user's day arrives as its vocabulary.
    """
    return behaviour_days(behaviour_words(df, order_cols, **columns))


# From this many words on a day's text is put together by an automaton.
MANY_WORDS = 512


def join_new_words(words: Sequence[str], sep: str = ";") -> str | None:
    """Words in order, leaving out each that the text so far contains.

    A word without ``sep`` is in the text if and only if it is part of an earlier word: that one is in the
    text, or is part of a word before it that is. So the words are matched against each other once, by an
    automaton over all of them, and not against a text that grows.
    """
    import ahocorasick

    first: dict[str, int] = {}
    for i, word in enumerate(words):
        first.setdefault(word, i)
    inside = ahocorasick.Automaton()
    for word, i in first.items():
        if word:
            inside.add_word(word, i)
    host: dict[int, int] = {}
    if len(inside):
        inside.make_automaton()
        for word, i in first.items():
            for _, part in inside.iter(word):
                if i < host.get(part, part):
                    host[part] = i
    text: list[str] = []
    for word, i in first.items():
        # The empty word is in any text, and a word with the separator may lie across several.
        if word == "" or sep in word:
            fresh = not text or word not in sep.join(text)
        else:
            fresh = i not in host
        if fresh:
            text.append(word)
    return sep.join(text) if text else None


def _join_new_words(said: str, sep: str = ";") -> Column:
    def add(text: Column, item: Column) -> Column:
        fresh = item["word"]
        return (
            F.when(text.isNull(), fresh).when(F.contains(text, fresh), text).otherwise(F.concat(text, F.lit(sep), fresh))
        )

    @F.pandas_udf("string")
    def joined(words: pd.Series) -> pd.Series:
        return words.map(lambda w: None if w is None else join_new_words(w, sep))

    # Adding words one by one looks through the text for each: only for days of few words.
    short = F.aggregate(F.when(F.size(said) < MANY_WORDS, F.col(said)), F.lit(None).cast("string"), add)
    many = joined(F.when(F.size(said) >= MANY_WORDS, F.transform(said, lambda item: item["word"])))
    return F.coalesce(many, short)


def metrics_by_target(metrics: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """One frame per metric type."""
    return {n: metrics.filter(F.col("metric_type") == n) for n in names}


from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_base64_text_keeps_other_rows_and_gives_null_for_bad_text(spark):
    df = spark.createDataFrame([("a", "aMOp"), ("a", "%%"), ("b", "%%"), ("a", None)], "k string, t string")
    out = df.select("k", "t", fn.base64_text("t", F.col("k") == "a").alias("x"))
    assert {(r.k, r.t): r.x for r in out.collect()} == {
        ("a", "aMOp"): "hé", ("a", "%%"): None, ("b", "%%"): "%%", ("a", None): None,
    }


@pytest.mark.parametrize(("text", "wanted"), [
    ("2024-05-06 07:08:09+08:00", datetime(2024, 5, 6, 7, 8, 9)),
    ("2024-05-06 07:08:09.123456-11:30", datetime(2024, 5, 6, 7, 8, 9, 123456)),
    ("2024-05-06 07:08:09Z", datetime(2024, 5, 6, 7, 8, 9)),
    ("2024-05-06 07:08:09.123+08:00", None),
    ("2024-05-06 07:08:09", None),
    ("2024-13-06 07:08:09Z", None),
    ("", None),
])
def test_wall_clock_drops_the_offset(spark, text, wanted):
    assert one(spark, fn.wall_clock(F.lit(text))) == wanted


def test_default_time_only_for_empty_text(spark):
    now = datetime(2024, 1, 1)
    df = spark.createDataFrame([("",), (None,), ("x",), ("20230405",)], "t string")
    got = [r[0] for r in df.select(fn.time_or_default("t", "yyyyMMdd", now)).collect()]
    assert got == [now, now, None, datetime(2023, 4, 5)]


def test_week_label_uses_the_year_of_the_week(spark):
    label = fn.calendar_labels(fn.ntz("2024-12-30 10:11:12"))
    got = {k: one(spark, c) for k, c in label.items()}
    assert got == {"year": "2024", "month": "2024-12", "week": "2025-01", "day": "2024-12-30",
                   "hour": "2024-12-30 10", "minute": "2024-12-30 10:11"}


def test_bucket_rejects_unknown_window():
    with pytest.raises(ValueError):
        fn.bucket(None, "decade")


def test_pick_takes_the_separator_literally_and_keeps_empty_items(spark):
    assert one(spark, fn.pick(F.lit("a|b||"), "|", 1)) == "b"
    assert one(spark, fn.pick(F.lit("a|b||"), "|", 3)) == ""
    assert one(spark, fn.pick(F.lit("a|b||"), "|", 4)) is None


def test_small_text_functions(spark):
    assert one(spark, fn.escape_separator(F.lit("a|b\r\nc\nd"))) == "a__bc\nd"
    assert one(spark, fn.strip_suffix(F.lit("1.2.3.4||||"))) == "1.2.3.4"
    assert one(spark, fn.strip_suffix(F.lit("||||"))) == ""
    assert one(spark, fn.strip_suffix(F.lit("1.2.3.4|||"))) == "1.2.3.4|||"
    assert one(spark, fn.zero_pad(F.lit(42))) == "000042"
    assert one(spark, fn.zero_pad(F.lit(12345678))) == "12345678"
    assert one(spark, fn.empty_if_null(F.lit(None))) == ""
    assert one(spark, fn.date_from_name(F.lit("log_20240229.txt"), "log_")) == datetime(2024, 2, 29)
    assert one(spark, fn.date_from_name(F.lit("log_20240230.txt"), "log_")) is None


def test_ipv4_number_refuses_what_is_no_address(spark):
    df = spark.createDataFrame([(t,) for t in ("0.0.0.0", "255.255.255.255", "1.2.3.256", "1.2.3", "1.2.3.4.5", "::1", "a.b.c.d", None)], "t string")
    got = [r[0] for r in df.select(fn.ipv4_number("t")).collect()]
    assert got == [0, 2**32 - 1, None, None, None, None, None, None]


def test_stable_id_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x string, y string")
    first, second, third = [r[0] for r in df.select(fn.stable_id("x", "y")).collect()]
    assert first == third != second


def test_json_maps(spark):
    got = spark.range(1).select(fn.json_maps(F.lit('[{"a":"1"},{"b":"x"}]'))).first()[0]
    assert got == [{"a": "1"}, {"b": "x"}]
    assert rows(spark.range(1).select(fn.json_maps(F.lit("no json")))) == [(None,)]


@pytest.mark.parametrize(("to", "texts"), [
    ("int", ["1", " -7 ", "+3", "2147483648", "1.5", "x", "", None, "99999999999999999999", "0x1"]),
    ("bigint", ["1", "-9223372036854775808", "9223372036854775808", "1e3", " "]),
    ("double", ["1", "-.5", "5.", "1e3", "1.5E-3", "NaN", "-Infinity", "inf", "1d", "1,5", "e3", "", "x", "0x1p3", "."]),
    ("timestamp_ntz", ["2024-01-02", "2024-01-02 03:04:05.6", "2024-01-02T03:04", "2024-13-01", "24-01-02", "x", ""]),
    ("date", ["2024-01-02", "2024", "2024-02-30", "x"]),
    ("boolean", ["true", "no", "x"]),
])
def test_loose_cast_equals_the_plain_try(spark, to, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, loose, plain in df.select("t", fn.loose_cast("t", to), F.col("t").try_cast(to)).collect():
        assert loose == plain or (loose != loose and plain != plain), t


def test_integer_text_of_any_length(spark):
    df = spark.createDataFrame([("00000000000000000000012",), ("9" * 30,), ("-7",)], "t string")
    assert [r[0] for r in df.select(fn.loose_cast("t", "bigint")).collect()] == [12, None, -7]

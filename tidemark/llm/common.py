"""Helpers that several of the operators share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import settle

# What a whole document may take in an Arrow batch is not known, so batches are
# short: rows of a few megabytes then still fit into a worker.
ARROW_ROWS = 128


def ready(spark: SparkSession) -> SparkSession:
    """The library's settings, and short Arrow batches for whole texts."""
    settle(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def named(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(named(name).cast("string"), F.lit(""))


def packed(df: DataFrame) -> Column:
    """All columns of a row as one value, so that added columns cannot clash with them."""
    return F.struct(*[named(name).alias(f"c{i}") for i, name in enumerate(df.columns)])


def unpacked(row: str, columns: list[str]) -> list[Column]:
    return [F.col(f"{row}.c{i}").alias(name) for i, name in enumerate(columns)]


# Bytes to themselves: digits, small letters and all of UTF-8 beyond ASCII. Large letters become small, the rest blank.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Bytes of a text that are cut into words at once.
CUT_BYTES = 1 << 20


def word_runs(body: bytes) -> Iterator[list[bytes]]:
    """The words of a text (``WORDS``, A-Z lower-cased), as lists of about ``CUT_BYTES`` of it."""
    blanked, at = body.translate(WORD_BYTES), 0
    while at < len(blanked):
        end = len(blanked) if at + CUT_BYTES >= len(blanked) else blanked.find(b" ", at + CUT_BYTES)
        end = len(blanked) if end < 0 else end
        yield blanked[at:end].split()
        at = end


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once for each row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


SUMMED = 256


def running_sums(amounts: Column) -> Column:
    """For each element (int) the sum of those before it; blocks, as each added element copies the array so far."""

    def added(values: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), F.array().cast("array<int>").alias("sums"))
        return F.aggregate(
            values, zero, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["sums"], acc["at"]).alias("sums")), lambda acc: acc["sums"]
        )

    def blocks(a: Column) -> Column:
        last = F.greatest(F.floor((F.size(a) - 1) / SUMMED), F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(a, b * SUMMED + 1, SUMMED))

    def summed(cut: Column) -> Column:
        totals = F.transform(cut, lambda block: F.aggregate(block, F.lit(0), lambda acc, x: acc + x))
        return F.flatten(F.zip_with(cut, added(totals, F.lit(0)), added))

    return let(amounts, lambda a: let(blocks(a), summed))

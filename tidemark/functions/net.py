"""Network addresses as numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.text import _col

OCTET = r"(?:25[0-5]|2[0-4]\d|[01]?\d?\d)"
IPV4 = rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"


def ipv4_number(c: Column | str) -> Column:
    """IPv4 text as bigint; null when it is no such address."""
    text = _col(c)
    number = F.aggregate(
        F.split(text, r"\."), F.lit(0).cast("bigint"), lambda acc, part: acc * 256 + part.cast("bigint")
    )
    return F.when(text.rlike(IPV4), number)


def prefix_value(number: Column | str, length: Column | int) -> Column:
    """The first ``length`` bits of a 32-bit address, as a number."""
    bits = F.lit(length) if isinstance(length, int) else length
    return F.call_function("shiftright", _col(number), (F.lit(32) - bits).cast("int"))

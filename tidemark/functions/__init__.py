from tidemark.functions.text import (
    as_date,
    as_int,
    as_long,
    as_string,
    base64_text,
    empty_if_null,
    escape_separator,
    json_maps,
    json_text,
    loose_cast,
    pick,
    signature,
    stable_id,
    strip_suffix,
    zero_pad,
)
from tidemark.functions.times import (
    WINDOW_TYPES,
    bucket,
    calendar_labels,
    date_from_name,
    format_time,
    from_millis,
    ntz,
    parse_time,
    time_or_default,
    to_millis,
    wall_clock,
)
from tidemark.functions.net import ipv4_number, prefix_value

__all__ = [
    "WINDOW_TYPES", "as_date", "as_int", "as_long", "as_string", "base64_text", "bucket",
    "calendar_labels", "date_from_name", "empty_if_null", "escape_separator", "format_time",
    "from_millis", "ipv4_number", "json_maps", "json_text", "loose_cast", "ntz", "parse_time", "pick",
    "prefix_value", "signature", "stable_id", "strip_suffix", "time_or_default", "to_millis",
    "wall_clock", "zero_pad",
]

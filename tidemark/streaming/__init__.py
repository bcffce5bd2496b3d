from tidemark.streaming.flush import EndMarks, without_marks
from tidemark.streaming.metrics import (
    closed_rows,
    latest_counts,
    latest_metrics,
    store_partials,
    stored_partials,
    stream_key_metric,
    stream_key_time_metric,
    stream_multi_metric,
    write_closed,
    write_updates,
)
from tidemark.streaming.runs import (
    drain,
    file_stream,
    late_rows,
    run_increment,
    stream_apply,
    stream_checked,
    stream_counts,
    stream_fan_out,
    stream_lookup_as_of,
    trigger_options,
)

__all__ = [
    "EndMarks", "closed_rows", "drain", "file_stream", "late_rows", "latest_counts", "latest_metrics", "run_increment", "store_partials", "stored_partials", "stream_apply",
    "stream_checked", "stream_counts", "stream_fan_out", "stream_lookup_as_of", "stream_key_metric", "stream_key_time_metric", "stream_multi_metric", "trigger_options", "without_marks",
    "write_closed", "write_updates",
]

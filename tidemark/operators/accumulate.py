"""Metrics with a foreign accumulator, for what no Spark aggregate can say."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

# Keys that one task holds before it hands its partial results on.
KEYS_IN_TASK = 100_000


class Accumulator(Protocol):
    """State of one key, held in plain attributes. ``add`` takes each record,
    ``merge`` the state of another task, in any order; ``result`` gives the
    output fields."""

    def add(self, record: Mapping[str, Any]) -> None: ...

    def merge(self, other: Any) -> None: ...

    def result(self) -> Mapping[str, Any]: ...


def accumulate(df: DataFrame, keys: Sequence[str], new: Callable[[], Accumulator], schema: T.StructType | str,
               fields: Sequence[str] | None = None) -> DataFrame:
    """``keys`` and the result fields, one row per key.

    Each task folds its own records first, so a key with most of all rows
    arrives as one partial state per task. Prefer ``MetricSpec`` with Spark
    aggregates: they stay inside the JVM.
    """
    keys = list(keys)
    inputs = df.select(*keys, *[f for f in (fields or df.columns) if f not in keys])
    names, width = inputs.columns, len(keys)
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    key_fields = [inputs.schema[k] for k in keys]
    partial = T.StructType([*key_fields, T.StructField("_state", T.BinaryType())])
    final = T.StructType([*key_fields, *out.fields])
    partial_types, final_types = ([to_arrow_type(f.dataType) for f in s.fields] for s in (partial, final))

    def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
        return zip(*[c.to_pylist() for c in batch.columns])

    def batch_of(rows: list[tuple], schema_names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
        cols = zip(*rows) if rows else ([] for _ in types)
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names=schema_names)

    def hand_on(found: dict[tuple, Accumulator]) -> pa.RecordBatch:
        states = [(*key, pickle.dumps(vars(state))) for key, state in found.items()]
        return batch_of(states, partial.names, partial_types)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, Accumulator] = {}
        for batch in batches:
            for row in rows_of(batch):
                key = row[:width]
                if key not in found:
                    if len(found) >= KEYS_IN_TASK:
                        yield hand_on(found)
                        found = {}
                    found[key] = new()
                found[key].add(dict(zip(names, row)))
        if found:
            yield hand_on(found)

    def restored(data: bytes) -> Accumulator:
        state = new()
        vars(state).update(pickle.loads(data))
        return state

    def finish(key: tuple, state: Accumulator) -> tuple:
        result = state.result()
        return (*key, *[result[n] for n in out.names])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by key: one state is open at a time.
        last: tuple | None = None
        state: Accumulator | None = None
        for batch in batches:
            done = []
            for row in rows_of(batch):
                key, data = row[:width], row[width]
                if state is not None and key == last:
                    state.merge(restored(data))
                    continue
                if state is not None:
                    done.append(finish(last, state))
                last, state = key, restored(data)
            yield batch_of(done, final.names, final_types)
        if state is not None:
            yield batch_of([finish(last, state)], final.names, final_types)

    states = inputs.mapInArrow(fold, partial)
    ordered = states.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return ordered.mapInArrow(combine, final)

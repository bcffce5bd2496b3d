"""A table kept by hash buckets of its key, to which changes are added and merged when it is read.

Rows and changes lie in folders, one per write, cut by bucket. The newest commit says which of them
make up each bucket: a base and the changes since. Changes are written for the buckets that they
touch, and a bucket that has gathered ``most_deltas`` of them is rewritten: no other one is.

A reader takes the base of a bucket without changes as it is. In the other buckets only the changed
keys are compared, so a small batch shuffles little of a large table. The last change of a key (by
``seq``, then by batch) decides; a delete stays as a row, so that an older change that comes late
does not bring the key back, until ``forget_deletes`` removes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import DELETE, UPDATE, flatten_changes, having_key
from tidemark.session import drop_folder
from tidemark.sinks.commits import CommitConflict, CommitLog
from tidemark.streaming.runs import trigger_options

OP, SEQ, BATCH, BUCKET = "_op", "_seq", "_batch", "_bucket"


@dataclass(frozen=True)
class BucketTable:
    """``keys`` are columns of ``schema``; both and ``buckets`` stay as the table was made with."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = 256
    most_deltas: int = 8

    def _log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.path.rstrip('/')}/_commits")

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, *T.StructType.fromDDL(f"{OP} string, {SEQ} bigint, {BATCH} bigint, {BUCKET} int").fields])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        """A new folder with the rows (values, op, seq, batch) by bucket, and the buckets there."""
        folder = f"data-{uuid.uuid4().hex}"
        dealt = rows.select(*self.schema.names, OP, SEQ, BATCH, self._bucket()).repartition(BUCKET)
        dealt.write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        # At most one folder per bucket; their names tell which there are.
        context = self.spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        listed = place.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(place)
        names = [found.getPath().getName() for found in listed]
        return folder, sorted(int(name.partition("=")[2]) for name in names if name.startswith(f"{BUCKET}="))

    def _read(self, folders: Mapping[str, Sequence[int]]) -> DataFrame:
        """Stored rows of some buckets of some folders; each bucket is a path of its own, so nothing else is opened."""
        found = None
        for folder, buckets in sorted(folders.items()):
            root = f"{self.path}/{folder}"
            part = self.spark.read.schema(self._stored()).option("basePath", root).parquet(*[f"{root}/{BUCKET}={b}" for b in buckets])
            found = part if found is None else found.unionByName(part)
        return self.spark.createDataFrame([], self._stored()) if found is None else found

    def _latest(self, rows: DataFrame) -> DataFrame:
        """The row that counts of each key."""
        values = [SEQ, BATCH, OP, *[c for c in self.schema.names if c not in self.keys]]
        last = rows.groupBy(BUCKET, *self.keys).agg(F.max(F.struct(*values)).alias("_last"))
        return last.select(*self.keys, BUCKET, "_last.*").select(*self._stored().names)

    @staticmethod
    def _folders(state: Mapping[str, Any], buckets: Sequence[str], part: str) -> dict[str, list[int]]:
        found: dict[str, list[int]] = {}
        for bucket in buckets:
            entry = state["buckets"][bucket]
            for folder in entry[part] if part == "deltas" else [entry[part]] if entry[part] else []:
                found.setdefault(folder, []).append(int(bucket))
        return found

    def _merged(self, state: Mapping[str, Any], buckets: Sequence[str]) -> DataFrame:
        base = self._read(self._folders(state, buckets, "base"))
        deltas = self._read(self._folders(state, buckets, "deltas"))
        asked = [BUCKET, *self.keys]
        keys = deltas.select(*asked).distinct()
        # Only rows of changed keys are compared with the changes.
        met = having_key(base, keys, asked)
        return having_key(base, keys, asked, "left_anti").unionByName(self._latest(met.unionByName(deltas)))

    def put(self, changes: DataFrame, op: str = "op", seq: str = "seq", writer: str | None = None, batch_id: int = 0) -> bool:
        """Add changes; false if ``writer`` has put this or a later batch before: then nothing is done.

        Another writer's commit in between raises ``CommitConflict``; the changes can be put again.
        """
        version, state = self._log().latest()
        if writer is not None and state.get("writers", {}).get(writer, -1) >= batch_id:
            return False
        rows = changes.select(
            *[F.col(c).cast(self.schema[c].dataType).alias(c) for c in self.schema.names], F.col(op).cast("string").alias(OP), F.col(seq).cast("bigint").alias(SEQ),
            F.lit(version + 1).cast("bigint").alias(BATCH),
        )
        folder, touched = self._write(self._latest(rows.select("*", self._bucket())))
        buckets = {b: dict(entry) for b, entry in state.get("buckets", {}).items()}
        for number in touched:
            entry = buckets.setdefault(str(number), {"base": None, "deltas": []})
            buckets[str(number)] = {**entry, "deltas": [*entry["deltas"], folder]}
        writers = state.get("writers", {}) | ({writer: batch_id} if writer is not None else {})
        self._commit(version, {"buckets": buckets, "writers": writers, "gone": []}, [folder])
        full = [b for b, entry in buckets.items() if len(entry["deltas"]) >= self.most_deltas]
        if full:
            self.compact(full)
        return True

    def compact(self, buckets: Sequence[str] | None = None, forget_deletes: bool = False) -> list[int]:
        """Rewrite these buckets (none named: all that have changes) as one base each; the numbers of those rewritten."""
        version, state = self._log().latest()
        chosen = [b for b, entry in state.get("buckets", {}).items() if entry["deltas"]] if buckets is None else list(buckets)
        if not chosen:
            return []
        rows = self._merged(state, chosen)
        if forget_deletes:
            rows = rows.filter(F.col(OP) != DELETE)
        folder, written = self._write(rows)
        entries = dict(state["buckets"])
        for bucket in chosen:
            entries[bucket] = {"base": folder if int(bucket) in written else None, "deltas": []}
        # What no bucket names any more goes with the next rewrite: a reader may still be at it.
        before, after = (self._named(e) for e in (state["buckets"], entries))
        self._commit(version, {"buckets": entries, "writers": state.get("writers", {}), "gone": sorted(before - after)}, [folder])
        for old in state.get("gone", []):
            drop_folder(self.spark, f"{self.path}/{old}")
        return sorted(map(int, chosen))

    @staticmethod
    def _named(buckets: Mapping[str, Any]) -> set[str]:
        return {f for entry in buckets.values() for f in (entry["base"], *entry["deltas"]) if f}

    def _commit(self, version: int, state: dict[str, Any], written: Sequence[str]) -> None:
        last = self._log().latest()[1].get("gone", [])
        state["gone"] = sorted({*state["gone"], *(last if not state["gone"] else [])})
        try:
            self._log().commit(version + 1, state)
        except CommitConflict:
            for folder in written:
                drop_folder(self.spark, f"{self.path}/{folder}")
            raise

    def load(self, rows: DataFrame) -> None:
        """Put a whole table as inserts before all changes (seq below any other)."""
        least = rows.withColumns({"op": F.lit(UPDATE), "seq": F.lit(-(1 << 63)).cast("bigint")})
        self.put(least)
        self.compact()

    def read(self) -> DataFrame:
        """The table after all changes."""
        _, state = self._log().latest()
        plain = [b for b, entry in state.get("buckets", {}).items() if not entry["deltas"]]
        changed = [b for b, entry in state.get("buckets", {}).items() if entry["deltas"]]
        rows = self._read(self._folders(state, plain, "base")) if plain else None
        if changed:
            merged = self._merged(state, changed)
            rows = merged if rows is None else rows.unionByName(merged)
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        return rows.filter(F.col(OP) != DELETE).select(*self.schema.names)


def stream_into(sdf: DataFrame, table: BucketTable, checkpoint: str, writer: str, idle_s: float | None = None) -> StreamingQuery:
    """Apply a change feed to a table, batch by batch; a replayed batch changes nothing."""

    def put(batch: DataFrame, batch_id: int) -> None:
        table.put(flatten_changes(batch, table.keys), writer=writer, batch_id=batch_id)

    return sdf.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**trigger_options(idle_s)).start()

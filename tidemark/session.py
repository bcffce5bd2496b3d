"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that the operators count on. Everything here can be changed
# on a running session; sizes (memory, cores, shuffle partitions) stay with the
# caller because they belong to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key over several tasks; the second flag allows it even
    # where it costs one more shuffle further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Text in any charset of the JVM; bytes that are none of it become the replacement sign.
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
    # Keeps the open windows of a stream on disk instead of in the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def settle(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return settle(builder.getOrCreate())


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, unique path under the folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting only a session inside one process (a local test) gets a
    temporary folder; on a cluster each executor would write to its own disk, so
    that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``shared_folder`` named, wherever the cluster keeps it."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def stage(df: DataFrame, name: str = "stage", parts: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder, in folders by ``parts``, and read it back.

    Several outputs then share one computation that outlives lost executors,
    and each of them still gets column pruning and filter pushdown.
    """
    return _staged(df, shared_folder(df.sparkSession, name), parts)


def _staged(df: DataFrame, path: str, parts: Sequence[str] = ()) -> DataFrame:
    df.write.mode("errorifexists").partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """As ``stage``, for results that are written before the block ends: the copy then goes."""
    path = shared_folder(df.sparkSession, name)
    try:
        yield _staged(df, path)
    finally:
        drop_folder(df.sparkSession, path)

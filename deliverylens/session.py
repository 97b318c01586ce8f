"""Session construction and the shared work folder.

Everything that is written (stream checkpoints, bronze and current tables,
lineage cuts) goes below the folder the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "deliverylens") -> SparkSession:
    """Session with the settings this library is tuned for.

    * UTC session zone: the driver tables hold TIMESTAMP_NTZ values and the
      payload timestamps carry explicit offsets; pinning the zone keeps both
      readings identical on every executor.
    * AQE with partition coalescing and skew-join splitting on.
    * UI off: no server ports.

    ``master`` and ``shuffle_partitions`` are set only when given, so that what
    spark-submit or the cluster says holds otherwise.
    """
    builder = (
        SparkSession.builder
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory",
                                                os.environ.get("DELIVERYLENS_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    event_dir = os.environ.get("DELIVERYLENS_EVENT_LOG_DIR")
    if event_dir:  # stage and task times for profiling, read offline
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: HotSpot compiles no method beyond this many bytes of bytecode.
COMPILED_BYTES = 8000


def compiled_methods(spark: SparkSession) -> None:
    """Keep generated code within what the JVM compiles.

    A stage that builds or reads payloads is one generated method, larger than
    HotSpot compiles, and would be interpreted row by row. With the limit Spark
    splits such a stage's projections instead. Never raises a limit that is smaller.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > COMPILED_BYTES:
        spark.conf.set(key, str(COMPILED_BYTES))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session with ``key`` set to ``value`` inside, and as it was after."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint folder).
    Where neither is set, a local master gets a private folder, as in tests; on
    a cluster executors would each write to their own disk, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="deliverylens-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


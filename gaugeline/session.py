"""Session defaults, shared scratch space and materialised intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "gaugeline", master: str | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; ``conf`` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session whose state lives in RocksDB with changelog checkpoints,
    so state size is bounded by local disk and a lost executor reloads it.

    ``state_partitions`` is fixed by a query's first start; by default it is the
    session's ``spark.sql.shuffle.partitions``.
    """
    sibling = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone",
                 "spark.sql.ansi.enabled"):
        sibling.conf.set(name, spark.conf.get(name))
    if state_partitions:
        sibling.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    sibling.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    sibling.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return sibling


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting: on a cluster a machine-local
    folder would be invisible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = context.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="gaugeline-")
        root = _local_scratch[app]
    return f"{root.rstrip('/')}/gaugeline/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts lineage, survives lost executors, and gives Catalyst the true file size,
    so it broadcasts the result only when it is below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

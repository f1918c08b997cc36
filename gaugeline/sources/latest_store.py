"""Latest value per key, kept as a base table plus per-batch deltas.

A micro-batch writes one row per key it saw, so the cost follows the batch and
not the number of stations. Compaction folds the deltas into a new base; readers
find the current version in an append-only list, so nothing is replaced in place. Folders of older
versions are no longer read and can be expired by age.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.latest import latest_by_station
from ..schemas import LATEST_DELTA, LATEST_ENTRY, LATEST_VERSION
from .commits import BATCH, REPLAY, CommitLog
from .tables import read_or_empty


class LatestStore:
    """With a commit ``log``, readers see deltas of committed numbers only."""

    def __init__(self, spark: SparkSession, root: str, log: CommitLog | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = log

    def _version(self) -> int:
        versions = read_or_empty(self.spark, f"{self.root}/versions", LATEST_VERSION)
        return versions.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def write_batch(self, readings: DataFrame, batch_id: int, kind: str = BATCH) -> None:
        """Record the newest value per station of one batch (or replay). A retry replaces
        the batch's own directory; a replay changes nothing."""
        version = None
        while version != self._version():  # a compaction by someone else may have come between
            version = self._version()
            target = f"{self.root}/deltas/version={version}/kind={kind}/batch_id={batch_id}"
            latest_by_station(readings).write.mode("overwrite").parquet(target)

    def _entries(self, version: int) -> DataFrame:
        """The base and the deltas since. Those of the version before are read too: one of
        them may have been committed after it was folded; the others change nothing."""
        entries = read_or_empty(self.spark, f"{self.root}/base/version={version}", LATEST_ENTRY)
        for number in (version - 1, version):
            deltas = read_or_empty(self.spark, f"{self.root}/deltas/version={number}", LATEST_DELTA)
            if self.log:
                seen = F.lit(False)
                for kind in (BATCH, REPLAY):
                    seen |= (F.col("kind") == kind) & (F.col("batch_id") <= self.log.last(kind))
                deltas = deltas.where(seen)
            entries = entries.unionByName(deltas.select(*entries.columns))
        return entries

    def _merged(self, version: int) -> DataFrame:
        newest = F.max_by(
            F.struct("value", "kafka_partition", "kafka_offset"), F.col("kafka_offset"))
        return self._entries(version).groupBy("key").agg(newest.alias("_last")) \
            .select("key", "_last.*")

    def read(self) -> DataFrame:
        """Every key with its latest value."""
        return self._merged(self._version())

    def compact(self) -> int:
        """Fold all deltas into the next base version and return it."""
        version = self._version()
        following = version + 1
        self._merged(version).write.mode("overwrite").parquet(f"{self.root}/base/version={following}")
        self.spark.range(1).select(
            F.lit(following).cast("bigint").alias("version"),
        ).write.mode("append").parquet(f"{self.root}/versions")
        return following

    def export_csv(self, path: str) -> None:
        export_csv(self.read(), path)


def export_csv(latest: DataFrame, path: str) -> None:
    """``key,value`` with a header, every field quoted and inner quotes doubled."""
    latest.select("key", "value").write.option("header", True).option("quoteAll", True) \
        .option("escape", '"').csv(path)


def read_csv_export(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key STRING, value STRING").option("header", True) \
        .option("escape", '"').option("multiLine", True).csv(path)

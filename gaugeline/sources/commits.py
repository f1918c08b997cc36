"""What readers may see: numbers of finished micro-batches, replays and merges.

A writer stores rows under its number in every sink and commits the number last; readers
take rows up to the last committed number only, so all sinks change at one moment and a
half-written batch is unseen. Each kind of number has one writer and only rises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import COMMIT
from .tables import read_or_empty

BATCH, REPLAY, MERGE = "batch", "replay", "merge"
NONE = -1


class CommitLog:
    """One small file per commit, in ``slots`` folders used in turn.

    A commit replaces the file written ``slots`` commits earlier, so the log does not grow,
    and a crash while it does so harms a number that is no longer the last.
    """

    def __init__(self, spark: SparkSession, root: str, slots: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.slots = slots

    def _path(self, kind: str) -> str:
        return f"{self.root}/kind={kind}"

    def last(self, kind: str) -> int:
        """The last committed number, or -1."""
        found = read_or_empty(self.spark, self._path(kind), COMMIT, ignoreMissingFiles="true")
        return found.agg(F.coalesce(F.max("number"), F.lit(NONE))).first()[0]

    def commit(self, kind: str, number: int, last: int | None = None) -> None:
        """Make everything written under ``number`` visible; doing it again changes nothing.
        A writer that knows the ``last`` number saves the reading of it."""
        if number > (self.last(kind) if last is None else last):
            row = self.spark.range(1).select(F.lit(number).cast("bigint").alias("number"),
                                             F.unix_millis(F.current_timestamp()).alias("committed_at_ms"))
            row.coalesce(1).write.mode("overwrite").parquet(f"{self._path(kind)}/slot={number % self.slots}")

    def seen(self, rows: DataFrame, column: str = "batch_id", kind: str = BATCH) -> DataFrame:
        """Rows of committed numbers; ``column`` is a partition column, so others are not read."""
        return rows.where(F.col(column) <= self.last(kind))

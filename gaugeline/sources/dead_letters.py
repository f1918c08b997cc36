"""Dead-letter store: JSON rows under ``dl_date=/stage=/batch_id=``.

Deleting writes the ids to a side table that every read subtracts, so a delete
costs what it removes and no reader ever sees a half-rewritten partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

from ..schemas import DEAD_LETTER, DEAD_LETTER_ID, with_field
from .commits import BATCH, CommitLog
from .tables import read_or_empty

ID_COLUMNS = DEAD_LETTER_ID.fieldNames()
_APPENDED = -1


class DeadLetterStore:
    """With a commit ``log``, rows of a micro-batch are seen once it is committed."""

    def __init__(self, spark: SparkSession, root: str, log: CommitLog | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = log

    def write(self, rows: DataFrame, batch_id: int | None = None) -> None:
        """Store rows from ``operators.envelopes.dead_letters``. With a
        ``batch_id`` the write replaces what an earlier try of it left.

        A micro-batch fails at one moment, so its tasks write straight to the one
        date; a batch of many dates is rebalanced by directory first.
        """
        leaf = F.lit(_APPENDED if batch_id is None else batch_id).cast("bigint")
        if batch_id is None:
            rows = rows.hint("rebalance", "dl_date", "stage")
        rows.withColumn("batch_id", leaf).write \
            .mode("append" if batch_id is None else "overwrite") \
            .option("partitionOverwriteMode", "dynamic") \
            .option("ignoreNullFields", "false") \
            .partitionBy("dl_date", "stage", "batch_id") \
            .json(f"{self.root}/messages")

    def read(self, date: str | None = None, stage: str | None = None) -> DataFrame:
        """All dead letters, or those of one date and stage, of which alone the directories
        are listed; unreadable rows are skipped, a missing date is simply empty."""
        folder = f"dl_date={date or '*'}" + (f"/stage={stage}" if stage else "") if date or stage else ""

        def within(name: str, schema: StructType, fmt: str) -> DataFrame:
            base = f"{self.root}/{name}"
            rows = read_or_empty(self.spark, f"{base}/{folder}", schema, fmt, basePath=base)
            for column, value in (("dl_date", date), ("stage", stage)):
                if value is not None:
                    rows = rows.where(F.col(column) == value)
            return rows

        rows = within("messages", with_field(DEAD_LETTER, "batch_id", LongType()), "json")
        if self.log:
            rows = rows.where((F.col("batch_id") == _APPENDED) | (F.col("batch_id") <= self.log.last(BATCH)))
        gone = within("deleted", DEAD_LETTER_ID, "parquet")
        return (
            rows.where(F.col("kafka_offset").isNotNull())
            .select(*DEAD_LETTER.fieldNames())
            .join(gone.select(*ID_COLUMNS), ID_COLUMNS, "left_anti")
        )

    def by_station(self, station_id: int) -> DataFrame:
        return self.read().where(F.col("station_id") == station_id)

    def delete(self, rows: DataFrame) -> None:
        """Remove the given dead letters from every later read."""
        rows.select(*ID_COLUMNS).write.mode("append") \
            .partitionBy("dl_date", "stage").parquet(f"{self.root}/deleted")

    def vacuum(self, target: str) -> "DeadLetterStore":
        """Copy what is left into a fresh store."""
        fresh = DeadLetterStore(self.spark, target)
        fresh.write(self.read())
        return fresh

    def export(self, path: str, date: str, stage: str | None = None) -> None:
        """The envelopes of a date as JSON lines."""
        self.read(date, stage).drop("dl_date", "stage") \
            .write.option("ignoreNullFields", "false").json(path)

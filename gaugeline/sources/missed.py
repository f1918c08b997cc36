"""Missed-message store: base64 envelopes under ``missed_date=``, their ids beside them, so
that counting opens no envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.text import base64_line, from_base64
from ..functions.timeparts import utc_date_text
from ..schemas import MISSED_BODY, MISSED_TABLE, REPLAYED_ID
from ..session import materialise
from .tables import read_or_empty

ID_COLUMNS = REPLAYED_ID.fieldNames()


class MissedStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def write(self, rows: DataFrame) -> None:
        """Store rows from ``operators.outages.missed_rows``, a few files per date
        however many tasks hold its rows."""
        body = F.to_json(F.struct(*MISSED_BODY.fieldNames()), {"ignoreNullFields": "false"})
        rows.select(base64_line(body).alias("payload"), "kafkaPartition", "kafkaOffset", "missed_date") \
            .hint("rebalance", "missed_date") \
            .write.mode("append").partitionBy("missed_date").parquet(f"{self.root}/missed")

    def _dated(self, name: str, schema: StructType, date: str | None) -> DataFrame:
        """A table, or one date of it, of which alone the directory is listed."""
        base = f"{self.root}/{name}"
        return read_or_empty(self.spark, f"{base}/missed_date={date}" if date else base, schema, basePath=base)

    def _stored(self, date: str | None = None) -> DataFrame:
        return self._dated("missed", MISSED_TABLE, date)

    @staticmethod
    def _opened(table: DataFrame) -> DataFrame:
        """Envelopes decoded once; what is not base64 of such JSON is dropped."""
        body = F.from_json(from_base64(F.col("payload")), MISSED_BODY)
        return table.select("missed_date", F.inline(F.array(body))) \
            .where(F.col("kafkaOffset").isNotNull())

    def pending_ids(self, date: str | None = None) -> DataFrame:
        """Ids of what is not cleared, without opening an envelope."""
        stored = self._stored(date).where(F.col("kafkaOffset").isNotNull())
        return stored.select(*ID_COLUMNS).join(self.replayed(date).select(*ID_COLUMNS), ID_COLUMNS, "left_anti")

    def all(self) -> DataFrame:
        """What is stored and not cleared."""
        return self.pending()

    def by_date(self, date: str) -> DataFrame:
        """What is not cleared of one date, in storage order."""
        return self.pending(date).orderBy("missedAtTimestamp", "kafkaOffset", "kafkaPartition")

    def since(self, epoch_ms: int) -> DataFrame:
        """What was missed at or after a moment and is not cleared, in replay order.
        Whole dates before it are pruned."""
        recent = F.col("missed_date") >= utc_date_text(F.lit(epoch_ms))
        return self._uncleared(self._stored().where(recent), self.replayed().where(recent)) \
            .where(F.col("missedAtTimestamp") >= epoch_ms) \
            .orderBy("kafkaPartition", "kafkaOffset")

    def counts(self) -> DataFrame:
        """Messages per date that are not cleared."""
        return self.pending_ids().groupBy("missed_date").agg(F.count("*").alias("messages"))

    def statistics(self) -> DataFrame:
        """Dates with messages that are not cleared, how many messages, and the first and last date."""
        return self.counts().agg(
            F.count("*").alias("dates"), F.coalesce(F.sum("messages"), F.lit(0).cast("bigint")).alias("messages"),
            F.min("missed_date").alias("first_date"), F.max("missed_date").alias("last_date"))

    def mark_replayed(self, messages: DataFrame) -> None:
        """Clear exactly the messages that were replayed."""
        messages.select(*ID_COLUMNS).write.mode("append") \
            .partitionBy("missed_date").parquet(f"{self.root}/replayed")

    def replayed(self, date: str | None = None) -> DataFrame:
        return self._dated("replayed", REPLAYED_ID, date)

    def pending(self, date: str | None = None) -> DataFrame:
        """Missed and not yet replayed, over all dates or one."""
        return self._uncleared(self._stored(date), self.replayed(date))

    def _uncleared(self, stored: DataFrame, done: DataFrame) -> DataFrame:
        return self._opened(stored).join(done.select(*ID_COLUMNS), ID_COLUMNS, "left_anti")

    def clear_date(self, date: str) -> int:
        """Mark all pending messages of a date as replayed and count them."""
        cleared = materialise(self.pending_ids(date), "cleared")
        self.mark_replayed(cleared)
        return cleared.count()

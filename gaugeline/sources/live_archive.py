"""The archive of a running stream: micro-batches, replays and merged dates under one log.

    archive/year=/month=/day=/station_id=/batch_id=              what the stream wrote
    archive-replays/replay_id=/year=/month=/day=/station_id=     what came back from a side channel
    archive-merged/version=/year=/month=/day=/station_id=        closed dates in few files
    archive-states/version=                                      which dates are merged, up to which numbers

Readers see committed numbers only. A merge writes the touched dates and a new state under
the next version and commits that version last: until then, and if it is interrupted,
readers go on with the old files.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType

from ..schemas import ARCHIVE, ARCHIVE_COLUMNS, ARCHIVE_PARTITIONS, MERGED_DATE, UNDATED_YEAR, with_field
from .archive import write_archive
from .commits import BATCH, MERGE, NONE, REPLAY, CommitLog
from .tables import read_or_empty

Dates = tuple[datetime.date, datetime.date]
_DATE_COLUMNS = ARCHIVE_PARTITIONS[:3]


@dataclass(frozen=True)
class Merged:
    """A merged date: the version that holds it and the numbers it includes."""

    version: int
    batch: int
    replay: int


@dataclass(frozen=True)
class Snapshot:
    """What is visible at one moment: the last numbers and the merged dates."""

    batch: int
    replay: int
    merged: dict[int, Merged]


def date_number() -> Column:
    return F.col("year").cast("bigint") * 10_000 + F.col("month") * 100 + F.col("day")


def _folder(number: int) -> str:
    return f"year={number // 10_000}/month={number // 100 % 100:02d}/day={number % 100:02d}"


def date_folders(dates: Dates) -> list[str]:
    """Folders of all days from the first to the last."""
    first, last = dates
    days = [first + datetime.timedelta(n) for n in range((last - first).days + 1)]
    return [_folder(d.year * 10_000 + d.month * 100 + d.day) for d in days]


class LiveArchive:
    def __init__(self, spark: SparkSession, root: str, log: CommitLog):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = log

    # --- writing ---------------------------------------------------------------

    def write_batch(self, rows: DataFrame, batch_id: int, rows_per_task: int, rows_per_file: int = 0) -> None:
        """Rows of one micro-batch; a retry replaces them. Unseen until the batch is committed.

        ``rows`` should be persisted: the rows of every directory are counted first, so that
        each small directory gets one file and only large ones are spread over tasks.
        """
        large = rows.groupBy(*ARCHIVE_PARTITIONS).agg(F.count("*").alias("n")).where(F.col("n") > rows_per_task)
        # At most one row for every rows_per_task rows of the batch.
        splits = {tuple(r[c] for c in ARCHIVE_PARTITIONS): -(-r["n"] // rows_per_task) for r in large.collect()}
        write_archive(rows, self.root, batch_id, splits, rows_per_file)

    def write_replay(self, rows: DataFrame, replay_id: int) -> None:
        """Rows of one replay, in place of what an interrupted try of it left."""
        write_archive(rows, f"{self.root}-replays/replay_id={replay_id}", mode="overwrite")

    def missing(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """Those of ``rows`` (archive rows) that the archive lacks, by ``keys``; only the
        dates that occur in ``rows`` are listed and read."""
        found = rows.select(F.coalesce(date_number(), F.lit(0)).alias("date")).distinct().collect()
        stored = self._read([_folder(r["date"]) for r in found])
        return rows.join(stored.select(*keys), keys, "left_anti")

    # --- reading ---------------------------------------------------------------

    def snapshot(self) -> Snapshot:
        """The merged dates grow with the calendar, not with the data."""
        version = self.log.last(MERGE)
        rows = read_or_empty(self.spark, f"{self.root}-states/version={version}", MERGED_DATE)
        merged = {r["date_number"]: Merged(r["version"], r["batch"], r["replay"]) for r in rows.collect()}
        return Snapshot(self.log.last(BATCH), self.log.last(REPLAY), merged)

    def read(self, dates: Dates | None = None) -> DataFrame:
        """All visible rows with a date, or those of a range of dates: of the rest not even
        the directories are listed."""
        return self._read(None if dates is None else date_folders(dates)).where(F.col("year") != UNDATED_YEAR)

    def read_undated(self) -> DataFrame:
        """Visible rows whose time has no calendar date."""
        return self._read([_folder(0)]).drop(*_DATE_COLUMNS)

    def _read(self, folders: list[str] | None, seen: Snapshot | None = None) -> DataFrame:
        seen = seen or self.snapshot()
        return (
            self._unmerged(BATCH, folders, seen)
            .unionByName(self._unmerged(REPLAY, folders, seen), True)
            .unionByName(self._merged_rows(seen.merged, folders), True)
            .select(*ARCHIVE_COLUMNS)
        )

    def _unmerged(self, which: str, folders: list[str] | None, seen: Snapshot) -> DataFrame:
        """Visible rows of micro-batches or replays that no merge includes."""
        base, prefix, number = {"batch": (self.root, "", "batch_id"),
                                "replay": (f"{self.root}-replays", "replay_id=*/", "replay_id")}[which]
        paths = base if folders is None else f"{base}/{prefix}{{{','.join(folders)}}}" if folders else ""
        rows = read_or_empty(self.spark, paths, with_field(ARCHIVE, number, LongType()), basePath=base)
        return rows.where((F.col(number) <= getattr(seen, which)) & (F.col(number) > _upto(seen.merged, which)))

    def _merged_rows(self, state: dict[int, Merged], folders: list[str] | None) -> DataFrame:
        base = f"{self.root}-merged"
        paths = []
        for number, date in state.items():
            if folders is None or _folder(number) in folders:
                paths.append(f"{base}/version={date.version}/{_folder(number)}")
        return read_or_empty(self.spark, paths, with_field(ARCHIVE, "version", LongType()), basePath=base)

    # --- merging ---------------------------------------------------------------

    def touched(self, seen: Snapshot | None = None) -> list[int]:
        """Date numbers with visible rows that no merge includes yet; from directory names and
        row counts, without reading a data column."""
        seen = seen or self.snapshot()
        rows = [self._unmerged(which, None, seen).select(date_number().alias("date")) for which in (BATCH, REPLAY)]
        return [r["date"] for r in rows[0].unionByName(rows[1]).distinct().orderBy("date").collect()]

    def merge(self, before: datetime.date, rows_per_file: int = 0) -> int | None:
        """Rewrite the touched dates before a day into few files each and return the new version."""
        seen = self.snapshot()
        limit = before.year * 10_000 + before.month * 100 + before.day
        dates = [d for d in self.touched(seen) if d < limit]
        if not dates:
            return None
        version = self.log.last(MERGE) + 1
        write_archive(self._read([_folder(d) for d in dates], seen), f"{self.root}-merged/version={version}",
                      mode="overwrite", rows_per_file=rows_per_file)
        state = seen.merged | {d: Merged(version, seen.batch, seen.replay) for d in dates}
        self.spark.createDataFrame(
            [(d, m.version, m.batch, m.replay) for d, m in sorted(state.items())], MERGED_DATE,
        ).coalesce(1).write.mode("overwrite").parquet(f"{self.root}-states/version={version}")
        self.log.commit(MERGE, version)
        return version


def _upto(state: dict[int, Merged], which: str) -> Column:
    """The number up to which a row's date is merged, or -1: an expression of partition columns
    and constants, so that superseded files are pruned."""
    numbers = {d: getattr(m, which) for d, m in state.items()}
    if not numbers:
        return F.lit(NONE)
    table = ",".join(f"{d}:{n}" for d, n in sorted(numbers.items()))
    known = F.str_to_map(F.lit(table), F.lit(","), F.lit(":"))
    return F.coalesce(F.try_element_at(known, date_number().cast("string")).cast("bigint"), F.lit(NONE))


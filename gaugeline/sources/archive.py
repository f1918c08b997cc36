"""Columnar archive laid out as ``year=/month=/day=/station_id=``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import zero_padded
from ..operators.decode import flatten
from ..schemas import ARCHIVE, ARCHIVE_COLUMNS, ARCHIVE_PARTITIONS, UNDATED_YEAR
from .tables import read_or_empty


def archive_rows(readings: DataFrame) -> DataFrame:
    """The ten archive columns, each row under its own UTC date."""
    flat = flatten(readings).withColumn(
        "battery_status", F.coalesce("battery_status", F.lit("unknown")))
    return flat.select(*ARCHIVE_COLUMNS)


def placed(rows: DataFrame) -> DataFrame:
    """Partition columns as directory names. A row without a calendar date goes to year 0, so
    that no directory name is ever null."""
    undated = F.col("year").isNull()
    part = lambda name: F.when(undated, F.lit(UNDATED_YEAR)).otherwise(F.col(name))
    return rows.withColumns({
        "year": part("year"), "month": zero_padded(part("month"), 2), "day": zero_padded(part("day"), 2)})


def write_archive(rows: DataFrame, path: str, batch_id: int | None = None,
                  splits: dict[tuple, int] | int = 1, rows_per_file: int = 0,
                  mode: str = "errorifexists") -> None:
    """Write archive rows.

    A batch job rebalances by partition directory: AQE merges small pieces and
    splits a directory that is too large for one task, so a hot station is
    written by many tasks. A micro-batch runs without AQE; there every directory
    (``year, month, day, station_id``) goes to as many tasks as ``splits`` says of
    it (one, if it does not), and ``batch_id`` becomes a leaf directory that a
    retry replaces.
    """
    out = placed(rows)
    leaves = list(ARCHIVE_PARTITIONS)
    if batch_id is None:
        out = out.hint("rebalance", *ARCHIVE_PARTITIONS)
    else:
        out = out.repartition(*ARCHIVE_PARTITIONS, _share(splits))
        out = out.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        leaves.append("batch_id")
        mode = "overwrite"
    writer = out.write.mode(mode).partitionBy(*leaves) \
        .option("compression", "uncompressed") \
        .option("partitionOverwriteMode", "static" if batch_id is None else "dynamic")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def _share(splits: dict[tuple, int] | int) -> Column:
    """The share of a large directory a placed row falls into; 0 in all others."""
    if isinstance(splits, int):
        return F.pmod(F.col("s_no"), F.lit(splits))
    share = F.lit(0).cast("bigint")
    for directory, parts in splits.items():
        here = F.lit(True)
        for name, value in zip(ARCHIVE_PARTITIONS, directory):
            here &= F.col(name).cast("bigint") == F.lit(value or 0)
        share = F.when(here, F.pmod(F.col("s_no"), F.lit(parts))).otherwise(share)
    return share


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive with typed partition columns; filters on them prune directories."""
    return spark.read.schema(ARCHIVE).parquet(path).where(F.col("year") != UNDATED_YEAR)


def read_undated(spark: SparkSession, path: str) -> DataFrame:
    """Rows whose time has no calendar date, without their date parts."""
    return read_or_empty(spark, f"{path}/year={UNDATED_YEAR}", ARCHIVE, basePath=path) \
        .drop("year", "month", "day")


def compact_archive(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite an archive of many small micro-batch files into a fresh one, undated rows
    included. ``live_archive`` merges single dates of a running one in place."""
    write_archive(spark.read.schema(ARCHIVE).parquet(source).select(*ARCHIVE_COLUMNS), target)

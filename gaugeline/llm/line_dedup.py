"""Boilerplate lines by their frequency on a site, in column functions only.

Pages are grouped by host. A line goes when the share of its host's pages that
contain it exceeds ``max_ratio``; hosts with under ``min_pages`` pages are left
alone. Lines are split at ``\\n`` and compared without white space around them;
blank lines neither count nor go.

A host's boilerplate is bounded: at most (lines per page) / ``max_ratio`` lines, so
it is held as one array per host, however many pages the host has. Lines are counted
by their 64-bit hash.

Repeated rows count as pages of their own. With ``copies_once`` the rows of a host that
have the same text (told by its hash) count as one page instead, in the share and in the
number of pages, so that a large group of copies doesn't make boilerplate of its own text.

Edge cases: a null text stays null with no lines; a null host is a host of its own; other
columns, whatever their names, are carried along; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise

MAX_RATIO, MIN_PAGES = 0.10, 20


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """``host``, ``hashes``: the lines to drop, for hosts that have any."""
    pages = docs.select(
        F.coalesce(docs[host_col].cast("string"), F.lit("")).alias("host"),
        F.array_distinct(F.transform(
            F.filter(F.split(docs[text_col], "\n"), lambda line: F.trim(line) != ""), _line_hash)
        ).alias("hashes"), *[F.xxhash64(docs[text_col]).alias("page")] * copies_once)
    if copies_once:
        # Partial results per task here as well: a group of copies sends few rows.
        pages = pages.groupBy("host", "page").agg(F.first("hashes").alias("hashes"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    # Partial sums per task: a line on every page of a hot host sends few rows.
    counts = pages.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(
        F.count("*").alias("on")).where(F.col("on") > max_ratio * min_pages)
    return (counts.join(totals, "host").where(F.col("on") > max_ratio * F.col("pages"))
            .groupBy("host").agg(F.collect_set("hash").alias("hashes")))


def cleaned(docs: DataFrame, text_col: str = "text", host_col: str = "source",
            max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """``row`` (the input row), ``text`` without boilerplate, ``n_lines``, ``n_dropped``."""
    # A written table tells Spark its size: it is broadcast only below the threshold,
    # else hot hosts are split by the adaptive skew join.
    drops = materialise(boilerplate(docs, text_col, host_col, max_ratio, min_pages, copies_once), "boilerplate")
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs[text_col].alias("text"),
        F.coalesce(docs[host_col].cast("string"), F.lit("")).alias("host"))
    rows = rows.join(drops, "host", "left").withColumn("lines", F.split("text", "\n"))
    rows = rows.withColumn("kept", F.when(F.col("hashes").isNull(), F.col("lines")).otherwise(F.filter(
        "lines", lambda line: (F.trim(line) == "") | ~F.array_contains("hashes", _line_hash(line)))))
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("lines"))
    return rows.select(
        "row",
        F.when(F.col("hashes").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("lines") - F.size("kept"))
        .cast("long").alias("n_dropped"))

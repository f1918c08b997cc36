"""Order-dependent work over few, possibly huge, groups.

A station may hold a third of all rows, so none of these sorts a whole station
in one task. Rows are cut into blocks of the order column; the ordinary window
runs per (key, block), and a second window over one small row per block carries
what crosses the block borders. Results equal the plain window's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_ROWS = 1_000_000


def block_of(order: Column, width: int) -> Column:
    return F.floor(order / width)


def number_rows(df: DataFrame, keys: list[str], order: list[str], into: str,
                width: int = BLOCK_ROWS) -> DataFrame:
    """``row_number()`` per ``keys`` in ``order``, counted block by block.

    ``order[0]`` must be an integer column; blocks are ``width`` of it wide.
    The count of earlier rows joins each block as one extra row in front, so the
    rows move once and null keys are numbered like any other.
    """
    blocked = df.withColumn("_block", block_of(F.col(order[0]), width))
    block = [*keys, "_block"]
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (
        blocked.groupBy(*block).agg(F.count("*").alias("_rows"))
        .select(*block, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    both = blocked.withColumn("_row", F.lit(True)).unionByName(
        starts.withColumn("_row", F.lit(False)), allowMissingColumns=True)
    within = Window.partitionBy(*block).orderBy("_row", *order)
    return (
        both.withColumn("_nth", F.row_number().over(within) - 1)
        .withColumn("_before", F.first("_start").over(
            within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .where("_row")
        .select(*df.columns, (F.col("_before") + F.col("_nth")).alias(into))
    )


def transmissions(decoded: DataFrame) -> DataFrame:
    """Distinct transmissions with their first offset: redelivered copies go,
    a restarted station that reuses a number with a new time stays."""
    return decoded.groupBy("station_id", "s_no", "status_timestamp").agg(
        F.min("kafka_offset").alias("kafka_offset"))


def _ordered_blocks(sent: DataFrame, width: int) -> tuple[DataFrame, list[str]]:
    return sent.withColumn("_block", block_of(F.col("kafka_offset"), width)), \
        ["station_id", "_block"]


def _distance(low: str, high: str) -> Column:
    """Exact difference: any two 64-bit numbers are valid sequence numbers."""
    return F.col(high).cast("decimal(20,0)") - F.col(low).cast("decimal(20,0)")


def gap_list(sent: DataFrame, width: int = BLOCK_ROWS) -> DataFrame:
    """Every missing run of ``s_no`` per station, in arrival order. A number
    that falls starts a new run and is no gap. ``missing`` is null beyond 64 bits."""
    blocked, block = _ordered_blocks(sent, width)
    within = Window.partitionBy(*block).orderBy("kafka_offset")
    inside = blocked.select(
        "station_id", F.lag("s_no").over(within).alias("before"), F.col("s_no").alias("after"))
    edges = blocked.groupBy(*block).agg(
        F.min_by("s_no", "kafka_offset").alias("first"),
        F.max_by("s_no", "kafka_offset").alias("last"),
    )
    across = Window.partitionBy("station_id").orderBy("_block")
    between = edges.select(
        "station_id", F.lag("last").over(across).alias("before"), F.col("first").alias("after"))
    return (
        inside.unionByName(between)
        .where(_distance("before", "after") > 1)
        .select(
            "station_id",
            (F.col("before") + 1).alias("gap_from"),
            (F.col("after") - 1).alias("gap_to"),
            (_distance("before", "after") - 1).try_cast("bigint").alias("missing"),
        )
    )


def lost_readings(sent: DataFrame, width: int = BLOCK_ROWS) -> DataFrame:
    """Per station and run: first and last number, how many came, how many are lost
    (null beyond 64 bits)."""
    blocked, block = _ordered_blocks(sent, width)
    within = Window.partitionBy(*block).orderBy("kafka_offset")
    fell = F.when(F.lag("s_no").over(within) > F.col("s_no"), 1).otherwise(0)
    pieces = (
        blocked.withColumn("_fell", fell)
        .withColumn("_piece", F.sum("_fell").over(
            within.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*block, "_piece")
        .agg(
            F.min("s_no").alias("low"),
            F.max("s_no").alias("high"),
            F.count_distinct("s_no").alias("received"),
        )
    )
    # Within a piece the number never falls, so its bounds are its ends.
    across = Window.partitionBy("station_id").orderBy("_block", "_piece")
    before = F.lag("high").over(across)
    runs = (
        pieces.withColumn("_before", before)
        .withColumn("_new", F.when(F.col("_before") <= F.col("low"), 0).otherwise(1))
        .withColumn("_again", F.when(F.col("_before") == F.col("low"), 1).otherwise(0))
        .withColumn("run", F.sum("_new").over(
            across.rowsBetween(Window.unboundedPreceding, 0)))
    )
    return runs.groupBy("station_id", "run").agg(
        F.min("low").alias("first_s_no"),
        F.max("high").alias("last_s_no"),
        F.sum(F.col("received") - F.col("_again")).alias("received"),
    ).withColumn("lost", (_distance("first_s_no", "last_s_no") + 1 - F.col("received")).try_cast("bigint"))


def key_conflicts(readings: DataFrame) -> DataFrame:
    """Keys seen with more than one distinct payload, which de-duplication would
    silently drop."""
    return (
        readings.groupBy("station_id", "s_no")
        .agg(F.count_distinct("value").alias("payloads"), F.count("*").alias("arrivals"))
        .where("payloads > 1")
    )

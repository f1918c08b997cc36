"""The readings source: five transport columns from Kafka or from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import MAX_OFFSETS_PER_BATCH, READINGS_TOPIC
from ..schemas import ARRIVAL


def kafka_options(bootstrap: str, topic: str = READINGS_TOPIC,
                  max_offsets: int | None = MAX_OFFSETS_PER_BATCH,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Options of the Kafka source: earliest on first start, the checkpoint after that.

    ``max_offsets`` caps one micro-batch, not the data. Set ``min_partitions`` above the
    topic's partition count so that one hot partition is read by several tasks.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def from_kafka_columns(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("arrival_ts"),
    )


def kafka_stream(spark: SparkSession, bootstrap: str, **options) -> DataFrame:
    """Streaming arrivals. Needs the Spark Kafka package on the class path."""
    return from_kafka_columns(
        spark.readStream.format("kafka").options(**kafka_options(bootstrap, **options)).load())


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming arrivals from a Parquet directory."""
    reader = spark.readStream.schema(ARRIVAL)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def file_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ARRIVAL).parquet(path)

"""Stateless side channels: rain alerts and invalid messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.alerts import alert_messages
from ..operators.decode import decode
from ..operators.envelopes import invalid_messages
from ..operators.validate import rejected
from ..sources.channels import kafka_sink_options


def start(messages: DataFrame, path: str, checkpoint: str, name: str,
          trigger: dict | None = None) -> StreamingQuery:
    """Append ``messages`` to a Parquet table, exactly once."""
    return (
        messages.writeStream.queryName(name).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .format("parquet").start(path)
    )


def start_to_kafka(messages: DataFrame, bootstrap: str, topic: str, checkpoint: str,
                   name: str, trigger: dict | None = None) -> StreamingQuery:
    """Append ``messages`` to a topic, at least once."""
    return (
        messages.writeStream.queryName(name).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .format("kafka").options(**kafka_sink_options(bootstrap, topic)).start()
    )


def alert_stream(arrivals: DataFrame) -> DataFrame:
    return alert_messages(decode(arrivals))


def invalid_stream(arrivals: DataFrame) -> DataFrame:
    return invalid_messages(rejected(decode(arrivals)))

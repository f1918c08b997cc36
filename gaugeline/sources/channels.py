"""Output topics: the same messages to Kafka or to files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.routing import Rule, routed_messages


def kafka_sink_options(bootstrap: str, topic: str | None = None) -> dict[str, str]:
    """Options of an idempotent, fully acknowledged producer. Without ``topic``
    every row names its own in a ``topic`` column."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.compression.type": "snappy",
    }
    if topic:
        options["topic"] = topic
    return options


def kafka_route_writer(bootstrap: str, rules: list[Rule] | None = None
                       ) -> Callable[[DataFrame, int], None]:
    """A ``FanOut`` route writer that sends each message to the topics its rules name.

    Delivery is at least once: a retried batch is sent again under the same keys.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        routed_messages(batch, rules).write.format("kafka") \
            .options(**kafka_sink_options(bootstrap)).save()
    return write

"""Delivery of lines to Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from logharbor.functions.lines import kafka_record
from logharbor.schemas import DEFAULT_TOPIC, KAFKA_COMPRESSION, KAFKA_LINGER_MS


def kafka_options(
    bootstrap_servers: str, compression: str | None = None, linger_ms: int = 0
) -> dict[str, str]:
    """Producer options; every record is acknowledged before its micro-batch ends."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "kafka.compression.type": compression or KAFKA_COMPRESSION,
        "kafka.linger.ms": str(linger_ms if linger_ms > 0 else KAFKA_LINGER_MS),
    }


def kafka_sink(
    lines: DataFrame,
    bootstrap_servers: str,
    checkpoint: str,
    topic: str = DEFAULT_TOPIC,
    compression: str | None = None,
    linger_ms: int = 0,
    raw_value: bool = False,
) -> DataStreamWriter:
    """Stream of cleaned lines to one record each. Needs Spark's Kafka connector on the
    class path."""
    records = lines.select(*kafka_record(F.col("line"), F.col("channel"), topic, raw_value))
    return (
        records.writeStream.format("kafka")
        .options(**kafka_options(bootstrap_servers, compression, linger_ms))
        .option("checkpointLocation", checkpoint)
    )

"""Kafka sources and sinks (needs the spark-sql-kafka package on the cluster).

Not exercised in this repository's tests: the Kafka connector is not on the
local classpath. Offline, :mod:`payguard.sources.records` provides the same
record shape on files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from payguard.config import KafkaSecurity, RunSettings


def raw_stream_options(settings: RunSettings, security: KafkaSecurity,
                       max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Source options of the raw topic: from the earliest offset (a fresh
    checkpoint replays everything), headers included, at most
    ``max_offsets_per_trigger`` records per micro-batch (default
    ``settings.max_records_per_trigger``), so a long backlog is read in
    bounded batches."""
    cap = max_offsets_per_trigger or settings.max_records_per_trigger
    return {**security.options(), "subscribe": settings.raw_topic, "startingOffsets": "earliest",
            "includeHeaders": "true", "kafka.group.id": settings.group_id, "maxOffsetsPerTrigger": str(cap)}


def raw_stream(spark: SparkSession, settings: RunSettings, security: KafkaSecurity,
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Raw topic as a stream (see :func:`raw_stream_options`)."""
    opts = raw_stream_options(settings, security, max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**opts).load()


def risk_stream_new_only(spark: SparkSession, settings: RunSettings, security: KafkaSecurity) -> DataFrame:
    """Risk topic, only records that arrive after the subscription starts."""
    return (spark.readStream.format("kafka").options(**security.options())
            .option("subscribe", settings.risk_topic).option("startingOffsets", "latest").load())


def publish(df: DataFrame, topic: str, security: KafkaSecurity) -> None:
    """Batch publish (key, value[, headers]); all in-sync replicas ack, 10 retries.
    Write ids into the frame (and persist it) before calling: a retried task
    must resend the same ids."""
    (df.write.format("kafka").options(**security.options()).option("topic", topic)
       .option("kafka.acks", "all").option("kafka.retries", "10").save())


def publish_stream(df: DataFrame, topic: str, security: KafkaSecurity, checkpoint: str):
    return (df.writeStream.format("kafka").options(**security.options()).option("topic", topic)
            .option("kafka.acks", "all").option("kafka.retries", "10")
            .option("checkpointLocation", checkpoint).start())


def paced_options(group_size: int, pause_s: int) -> tuple[dict[str, str], str]:
    """Live pacing on a Kafka source: at most ``group_size`` records per
    micro-batch, one micro-batch per ``pause_s`` seconds. Returns (source
    options, processing-time trigger interval)."""
    return {"maxOffsetsPerTrigger": str(max(group_size, 1))}, f"{max(pause_s, 0)} seconds"

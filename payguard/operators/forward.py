"""Forward new risk events to a subscriber; prune old events.

A subscription sees only records that arrive after it starts: offline, the
subscription records the high-water offset of each topic partition, and
forwarding keeps records at or above it. Each forwarded event gets delivery
attributes: id ``partition:P/offset:O``, subject ``partition:P#O``, source
``<prefix>#<topic>``, type ``dev.knative.kafka.event``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from payguard import config as C


def new_records(topic_df: DataFrame, high_water: DataFrame) -> DataFrame:
    """Records at or past the subscription's high-water offsets. ``high_water``
    has one row per topic partition (bounded by the partition count)."""
    hw = F.broadcast(high_water.select("partition", F.col("next_offset").alias("_hw")))
    joined = topic_df.join(hw, "partition", "left")
    return joined.where(F.col("offset") >= F.coalesce(F.col("_hw"), F.lit(0))).drop("_hw")


def delivery_attributes(df: DataFrame, source_prefix: str = "/apis/v1/sources/subscriber") -> DataFrame:
    p, o = F.col("partition").cast("string"), F.col("offset").cast("string")
    return df.select(
        F.concat(F.lit("partition:"), p, F.lit("/offset:"), o).alias("ce_id"),
        F.concat(F.lit("partition:"), p, F.lit("#"), o).alias("ce_subject"),
        F.concat(F.lit(source_prefix), F.lit("#"), F.col("topic")).alias("ce_source"),
        F.lit(C.FORWARD_EVENT_TYPE).alias("ce_type"),
        F.lit(C.SPEC_VERSION).alias("ce_specversion"),
        F.col("timestamp").alias("ce_time"),
        F.col("value").cast("string").alias("data"),
        "partition", "offset")


def retention_window(df: DataFrame, ts_col: str = "ts", retention_ms: int = C.RETENTION_MS) -> DataFrame:
    """Rows no older than ``retention_ms`` before the newest row.

    The newest time is a scalar subquery (one partial max per task, then one
    value), so the filter itself is a narrow pass over the data. On a dated
    table :func:`payguard.streaming.tables.drop_old_days` removes whole days
    without reading any row; this filter is then exact within the oldest one.
    """
    newest = df.select(F.max(ts_col)).scalar()
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                              (F.lit(retention_ms).cast("decimal(20,6)") / 1000).cast("decimal(18,6)"))
    return df.where(F.col(ts_col) >= newest - span)

"""Forward new risk events to a subscriber as a stream.

A subscription sees only what arrives after it first started. On Kafka that is
``startingOffsets=latest`` on a fresh checkpoint; on archived records it is a
table of the offsets that each partition had then. Both are kept in the
subscription's folder, so a later start goes on where it stopped. Every micro-batch of new
records goes, with its delivery attributes, to ``deliver(batch, batch_id)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from payguard.config import JSON_CONTENT_TYPE
from payguard.operators.forward import delivery_attributes, new_records
from payguard.session import path_exists
from payguard.sources.records import next_offsets

class Subscription:
    """A named subscription: the folder of its checkpoint and of the offsets at which it began."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/checkpoint"

    def marks(self, records: DataFrame) -> DataFrame:
        """The offsets of ``records`` at the subscription's first start (one row per topic partition):
        written then, read at every later start."""
        spark, path = records.sparkSession, f"{self.path}/began"
        if not path_exists(spark, f"{path}/_SUCCESS"):
            next_offsets(records).coalesce(1).write.mode("overwrite").parquet(path)
        return spark.read.schema("partition int, next_offset bigint").parquet(path)


ATTRIBUTES = ("ce_id", "ce_subject", "ce_source", "ce_type", "ce_specversion", "ce_time")


def forward_stream(records: DataFrame, deliver: Callable[[DataFrame, int], None], checkpoint: str, marks: DataFrame | None = None,
                   source_prefix: str = "/apis/v1/sources/subscriber", available_now: bool = True):
    """Start forwarding ``records`` (those past ``marks``, if given). Returns the StreamingQuery."""
    fresh = records if marks is None else new_records(records, marks)
    w = delivery_attributes(fresh, source_prefix).writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def post_to(url: str, timeout_s: float = 30.0, retries: int = 5, ca_data: str | None = None, connect=None) -> Callable[[DataFrame, int], None]:
    """A ``deliver`` that posts each event to a subscriber's URL: the attributes as
    ``ce-`` headers, the data as the body. One connection per task; an answer other
    than 2xx is tried again with a growing pause and fails the batch in the end,
    so Spark runs the batch again (at least once)."""
    def rows(batches):
        from payguard.operators.score import HttpClient
        client = HttpClient(url, timeout_s, retries, ca_data, connect)
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    heads = {a.replace("ce_", "ce-"): str(row[a]) for a in ATTRIBUTES if row[a] is not None}
                    client.post(row["data"] or "", heads | {"Content-Type": JSON_CONTENT_TYPE})
                yield batch.slice(0, 0)
        finally:
            client.close()

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.mapInArrow(rows, batch.schema).write.format("noop").mode("overwrite").save()
    return deliver

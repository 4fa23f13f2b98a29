"""The stream job: one read of the raw topic, fanned out to every sink.

Per micro-batch (``foreachBatch``) the payload is decoded once; one write makes the
raw index's rows and the few columns and rows that the other sinks share, then:

* good rows -> the raw index table (35 columns, unfiltered),
* good rows -> valid -> late -> graded -> the risk index table (7 columns)
  and the risk sink (structured events),
* rows that can't be decoded, graded or published -> the quarantine table,
  with the payload, its topic, partition and offset, and the reason.

What is stored depends only on the records read. Every sink is keyed by the
run and the batch number: a batch that Spark runs again replaces all that its
earlier attempt wrote, also where it has no rows now. A run is named in a
pointer file beside the tables and owns a checkpoint; plain starts go on with
that run. ``replay`` starts a new run from the first record: it becomes the
pointer's run, and every start removes what other runs left in any sink.

With an ``index`` both index tables' documents also go to a search index, in
bounded bulk requests (:mod:`payguard.sources.bulk`).

``RunSettings.dedupe_within`` takes each record once, however often it is
delivered (keyed state, bounded by a watermark on the records' time).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from payguard.config import RunSettings
from payguard.operators.decode import ERROR_COL, decode
from payguard.operators.encode import anomaly_documents, json_document, raw_documents, structured_risk_events
from payguard.operators.risk import is_late, is_valid
from payguard.plans.risk_job import grade_late_invoices
from payguard.schemas import INVOICE_FIELDS, INVOICE_SCHEMA, RAW_FIELDS, RAW_SCHEMA
from payguard.session import WIDE, free, materialise, path_exists, scratch_dir
from payguard.sources.bulk import BulkIndex
from payguard.streaming import tables

ALL_FIELDS = RAW_FIELDS + ("Risk", "Model_Name")
#: The store of ``dedupe_within``'s keys where the session names none: off the heap, on the executors' disks.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Where a record came from, kept beside what was decoded from it.
ORIGIN = ("topic", "partition", "offset", "timestamp")
QUARANTINE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("payload", T.StringType()), T.StructField("reason", T.StringType())])
#: The two sets of rows that a batch stages, and what the second holds beside the invoice's fields.
SET, RAW, KEPT = "_set", "raw", "kept"
KEPT_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()), T.StructField("payload", T.StringType()), T.StructField("day", T.DateType()),
    T.StructField("Risk", T.StringType()), T.StructField("Model_Name", T.StringType()), T.StructField(ERROR_COL, T.StringType())])
EVENT_SCHEMA = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())])


@dataclass(frozen=True)
class Sinks:
    """Where a job's tables are; their names are settings of the job."""

    root: str
    raw_table: str = RunSettings.raw_table
    risk_table: str = RunSettings.risk_table
    quarantine_table: str = "quarantine"

    @property
    def raw(self) -> str:
        return f"{self.root}/{self.raw_table}"

    @property
    def anomaly(self) -> str:
        return f"{self.root}/{self.risk_table}"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/{self.quarantine_table}"

    @property
    def staged(self) -> str:
        return f"{self.root}/_batches"

    @property
    def pointer(self) -> str:
        return f"{self.root}/_active_run"

    def checkpoint(self, run: str) -> str:
        return f"{self.root}/_checkpoints/{run}"


class RiskSink(Protocol):
    """Where risk events go. ``write`` may be called again for a batch that was written before."""

    def write(self, events: DataFrame, run: str, batch_id: int) -> None: ...
    def keep_only(self, spark: SparkSession, run: str) -> None: ...


class RiskEventTable:
    """Risk events as a dated table (columns ``key`` and ``value``)."""

    def __init__(self, path: str):
        self.path = path

    def write(self, events: DataFrame, run: str, batch_id: int) -> None:
        tables.write_batch(events, self.path, run, batch_id)

    def keep_only(self, spark: SparkSession, run: str) -> None:
        tables.drop_other_runs(spark, self.path, run)

    def read(self, spark: SparkSession) -> DataFrame:
        return tables.read_index(spark, self.path, EVENT_SCHEMA)


class PublishOnce:
    """Risk events through ``send(events, batch_id)``, to a store that can't take
    a batch back (a Kafka topic). A batch is recorded after it is sent and not
    sent again in its run; only a failure between the two sends it twice. Only
    the newest record of a run is kept: Spark never runs an earlier batch again."""

    def __init__(self, send, markers: str):
        self.send, self.markers = send, markers

    def write(self, events: DataFrame, run: str, batch_id: int) -> None:
        spark, here = events.sparkSession, f"{self.markers}/{run}"
        last = tables.read_text(spark, here)
        if last is not None and int(last) >= batch_id:
            return
        self.send(events.select("key", "value"), batch_id)
        tables.write_text(spark, here, str(batch_id))

    def keep_only(self, spark: SparkSession, run: str) -> None:
        for found in tables.folders(spark, f"{self.markers}/*"):
            if not found.endswith(f"/{run}"):
                tables.drop(spark, found)


def kafka_risk_sink(settings: RunSettings, security, sinks: Sinks) -> PublishOnce:
    """Risk events to the risk topic (at least once; see :class:`PublishOnce`)."""
    from payguard.sources.kafka import publish
    return PublishOnce(lambda events, _: publish(events, settings.risk_topic, security), f"{sinks.root}/_published")


def process_batch(batch: DataFrame, batch_id: int, sinks: Sinks, settings: RunSettings, risk_sink: RiskSink, run: str = "run-0",
                  scorer=None, mode: str = "quarantine", index: BulkIndex | None = None) -> None:
    """One micro-batch, read and decoded once (once more for an ``index``; it must then give the same rows).

    One write makes two sets of rows beside the tables: the raw index's, whose folders are then moved to their places,
    and what the other sinks need: valid late invoices and errors, their payloads only where quarantine may want them.
    Nothing wide is kept in the executors' memory."""
    spark = batch.sparkSession
    uses_model = settings.uses_model or scorer is not None
    for c in set(ORIGIN) - set(batch.columns):
        batch = batch.withColumn(c, F.lit(None))
    origin = [F.col(c).cast(t).alias(c) for c, t in zip(ORIGIN, ("string", "int", "bigint", "timestamp"))]
    batch = batch.select(*origin, F.col("value").cast("string").alias("payload"))
    decoded = decode(batch, ALL_FIELDS, "payload", mode=mode, keep=(*ORIGIN, "payload"))
    if ERROR_COL not in decoded.columns:
        decoded = decoded.withColumn(ERROR_COL, F.lit(None).cast("string"))
    error = F.col(ERROR_COL).isNotNull()
    # A risk event is keyed by its Invoice_ID: a NULL id can't be
    # published (a blank one can), and an ungraded invoice has no risk.
    unnamed = F.col("Invoice_ID").isNull()
    place, staged = scratch_dir(spark, "batch"), f"{sinks.staged}/{run}-{batch_id}"
    try:
        _stage(decoded, staged, error, error | unnamed | F.lit(uses_model))
        tables.move_batch(spark, f"{staged}/{SET}={RAW}", sinks.raw, run, batch_id)
        if index is not None:
            index.write(decoded.where(~error), settings.raw_table, run, batch_id, json_document(RAW_FIELDS))
        kept = _staged(spark, f"{staged}/{SET}={KEPT}")
        graded = grade_late_invoices(kept.where(~error).drop(ERROR_COL), settings, scorer)
        graded = graded.withColumn(ERROR_COL, F.coalesce(ERROR_COL, F.when(unnamed, F.lit("null event id"))))
        if uses_model:  # asked once; the rule is a projection of what is kept already
            graded = graded.select(*ORIGIN, F.when(error, F.col("payload")).alias("payload"), "day", *INVOICE_FIELDS, ERROR_COL)
            graded = materialise(graded, "graded", f"{place}/graded", **WIDE)
        risk = graded.where(~error)
        tables.write_batch(anomaly_documents(risk, ("day",)), sinks.anomaly, run, batch_id)
        if index is not None:
            index.write(risk, settings.risk_table, run, batch_id, json_document(INVOICE_FIELDS))
        risk_sink.write(structured_risk_events(risk, settings, keep=("day",)), run, batch_id)
        aside = [df.where(error).select(*ORIGIN[:3], "payload", F.col(ERROR_COL).alias("reason"), "day") for df in (kept, graded)]
        tables.write_batch(aside[0].unionByName(aside[1]), sinks.quarantine, run, batch_id)
    finally:
        free(spark, place)
        free(spark, staged)


def _stage(decoded: DataFrame, path: str, error: Column, with_payload: Column) -> None:
    """Write a decoded batch once, as two sets of rows: good ones by day, with the raw index's fields (and ``_kept``, which is
    NULL there); valid late invoices and errors, with the invoice's fields and the rest in ``_kept``."""
    late = is_valid(F.col("Invoice_Amount")) & is_late(F.col("Pay_Type"))
    sets = F.when(error, F.array(F.lit(KEPT))).when(late, F.array(F.lit(RAW), F.lit(KEPT))).otherwise(F.array(F.lit(RAW)))
    # A record without a time has no day; retention and compaction leave those alone.
    rows = decoded.select(*RAW_FIELDS, *[F.col(f.name) for f in KEPT_SCHEMA.fields if f.name not in ("payload", "day")],
                          F.when(with_payload, F.col("payload")).alias("payload"), F.to_date("timestamp").alias("day"), F.explode(sets).alias(SET))
    kept = F.col(SET) == KEPT
    fields = [F.col(f) if f in INVOICE_FIELDS else F.when(~kept, F.col(f)).alias(f) for f in RAW_FIELDS]
    rest = F.when(kept, F.struct(*KEPT_SCHEMA.names)).alias("_kept")
    rows.select(*fields, rest, F.when(~kept, F.col("day")).alias("day"), SET).write.mode("overwrite").options(**WIDE).partitionBy(SET, "day").parquet(path)


def _staged(spark: SparkSession, path: str) -> DataFrame:
    """What a batch staged for the sinks beside the raw index."""
    named = [f for f in RAW_SCHEMA.fields if f.name in INVOICE_FIELDS]
    schema = T.StructType([*named, T.StructField("_kept", KEPT_SCHEMA)])
    rows = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    rows = rows.select(*[f.name for f in named], "_kept.*")
    return rows.select(*ORIGIN, "payload", "day", *INVOICE_FIELDS, ERROR_COL)


def active_run(spark: SparkSession, sinks: Sinks, replay: bool = False) -> str:
    """The run to go on with; a new one if there is none or on ``replay``.

    A pointer that is missing though runs have left checkpoints is an error: a new
    run would remove their rows, of which the topic may hold only the newest."""
    run = None if replay else tables.read_text(spark, sinks.pointer)
    if run is None:
        if not replay and (left := tables.folders(spark, sinks.checkpoint("*"))):
            raise RuntimeError(f"{sinks.pointer} is missing but there are runs ({len(left)}): write the run's name there, or start with replay")
        run = f"run-{uuid.uuid4().hex[:12]}"
        tables.write_text(spark, sinks.pointer, run)
    return run


def once(source: DataFrame, within: str) -> DataFrame:
    """Each record once, though a broker or an archive delivers it again, in the same batch, a later
    one or after a restart. A record is known by topic, partition and offset, never by its fields.

    The state holds one key for each record whose time is within ``within`` of the newest; what is
    older than that is dropped as late, so ``within`` should be no less than the tables' retention."""
    return source.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(["topic", "partition", "offset"])


def start_fanout(source: DataFrame, sinks: Sinks, risk_sink: RiskSink, settings: RunSettings | None = None,
                 scorer=None, mode: str = "quarantine", available_now: bool = True, replay: bool = False, index: BulkIndex | None = None):
    """Start the fan-out stream over a Kafka-shaped source. Returns the StreamingQuery."""
    settings = settings or RunSettings()
    spark = source.sparkSession
    # A batch is made row by row with all the source's columns, whatever is read of it later.
    source = source.select("value", *[c for c in ORIGIN if c in source.columns])
    if settings.dedupe_within:
        source = once(source, settings.dedupe_within)
    run = active_run(spark, sinks, replay)
    tables.drop(spark, sinks.staged)  # of a batch that was cut short; it runs again
    for path in (sinks.raw, sinks.anomaly, sinks.quarantine):
        tables.drop_other_runs(spark, path, run)
    risk_sink.keep_only(spark, run)

    def work(batch: DataFrame, batch_id: int) -> None:
        if not settings.dedupe_within or index is None:  # the batch is read once
            return process_batch(batch, batch_id, sinks, settings, risk_sink, run, scorer, mode, index)
        place = scratch_dir(batch.sparkSession, "first")  # the keyed state is run once a batch
        try:
            first = materialise(batch.select("value", *ORIGIN), "first", f"{place}/rows", **WIDE)
            process_batch(first, batch_id, sinks, settings, risk_sink, run, scorer, mode, index)
        finally:
            free(batch.sparkSession, place)

    w = source.writeStream.foreachBatch(work).option("checkpointLocation", sinks.checkpoint(run)).queryName(f"fanout_{uuid.uuid4().hex[:8]}")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=settings.trigger_interval)
    # The default store holds every key of the window in the executors' heap. A checkpoint keeps the one it began with.
    mine = bool(settings.dedupe_within) and spark.conf.get(STATE_STORE, None) is None
    if mine:
        spark.conf.set(STATE_STORE, ROCKS)
    try:
        return w.start()
    finally:
        if mine:
            spark.conf.unset(STATE_STORE)


def create_index_tables(spark: SparkSession, sinks: Sinks) -> list[str]:
    """The index tables in the catalog, typed and dated, at the folders the job writes."""
    from payguard.operators.readback import init_tables
    return init_tables(spark, {sinks.raw_table: RAW_SCHEMA, sinks.risk_table: INVOICE_SCHEMA, sinks.quarantine_table: QUARANTINE_SCHEMA},
                       sinks.root, tables.PARTS)


def refresh_index_tables(spark: SparkSession, sinks: Sinks) -> None:
    """Make the catalog's tables see the folders that batches have added or dropped."""
    for name, path in ((sinks.raw_table, sinks.raw), (sinks.risk_table, sinks.anomaly), (sinks.quarantine_table, sinks.quarantine)):
        if not path_exists(spark, path):  # nothing is written yet
            continue
        spark.sql(f"MSCK REPAIR TABLE {tables.catalog_name(name)} SYNC PARTITIONS")


def read_raw(spark: SparkSession, sinks: Sinks) -> DataFrame:
    return raw_documents(tables.read_index(spark, sinks.raw, RAW_SCHEMA))


def read_anomaly(spark: SparkSession, sinks: Sinks) -> DataFrame:
    return anomaly_documents(tables.read_index(spark, sinks.anomaly, INVOICE_SCHEMA))


def read_quarantine(spark: SparkSession, sinks: Sinks) -> DataFrame:
    return tables.read_index(spark, sinks.quarantine, QUARANTINE_SCHEMA).select(*QUARANTINE_SCHEMA.names)


__all__ = ["PublishOnce", "RiskEventTable", "RiskSink", "Sinks", "active_run", "create_index_tables", "kafka_risk_sink", "path_exists",
           "process_batch", "refresh_index_tables", "read_anomaly", "read_quarantine", "read_raw", "start_fanout"]

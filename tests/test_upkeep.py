import datetime as dt

import pytest
from pyspark.sql import functions as F

from payguard.config import RunSettings
from payguard.jobs import upkeep_job
from payguard.schemas import RAW_SCHEMA
from payguard.session import path_exists, scratch_dir
from payguard.sources.records import stream_records
from payguard.streaming import tables
from payguard.streaming.fanout import RiskEventTable, Sinks, active_run, process_batch, read_raw, start_fanout

DAY = dt.date(2024, 1, 1)


class Job:
    """A stream job over records of (offset, id, time)."""

    def __init__(self, spark, settings=None):
        self.spark, self.settings = spark, settings or RunSettings()
        root = scratch_dir(spark, "t_upkeep")
        self.sinks, self.events, self.topic = Sinks(f"{root}/tables"), RiskEventTable(f"{root}/risk"), f"{root}/topic"

    def records(self, *rows):
        value = F.to_json(F.struct(F.col("id").alias("Invoice_ID"), F.lit("9000").alias("Invoice_Amount"), F.lit("Late").alias("Pay_Type"), F.lit("9").alias("Pay_Delay")))
        return self.spark.createDataFrame([*rows], "offset bigint, id string, time string").select(
            F.lit(None).cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset",
            F.to_timestamp("time").alias("timestamp"), F.lit(0).alias("timestampType"), F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"))

    def batch(self, *rows, **more):
        self.records(*rows).coalesce(1).write.mode("append").parquet(self.topic)
        start_fanout(stream_records(self.spark, self.topic), self.sinks, self.events, self.settings, **more).awaitTermination()

    def ids(self):
        return sorted(r["Invoice_ID"] for r in read_raw(self.spark, self.sinks).collect())

    def folders(self, day):
        return sorted(f.rsplit("=", 1)[1] for f in tables.folders(self.spark, f"{self.sinks.raw}/day={day}/run=*/batch_id=*"))

    def upkeep(self, *more):
        return upkeep_job(["--tableRoot", self.sinks.root, "--compact", *more], self.spark)


@pytest.fixture
def job(spark):
    job = Job(spark)
    for i in range(3):
        job.batch((i, f"a{i}", "2024-01-01 10:00:00"), (10 + i, f"b{i}", "2024-01-02 10:00:00"))
    return job


def test_compaction_keeps_what_is_written_meanwhile(spark, job):
    run, done = active_run(spark, job.sinks), tables.committed(spark, job.sinks.checkpoint(active_run(spark, job.sinks)))
    assert tables.stage_day(spark, job.sinks.raw, RAW_SCHEMA, DAY, run, upto=done)
    job.batch((20, "late", "2024-01-01 11:00:00"))  # to the day that is being compacted
    tables.swap_day(spark, job.sinks.raw, DAY, run)
    want = ["a0", "a1", "a2", "b0", "b1", "b2", "late"]
    assert job.ids() == want and len(job.folders(DAY)) == 2
    job.upkeep()
    assert job.ids() == want and len(job.folders(DAY)) == 1
    job.upkeep()
    assert job.ids() == want


@pytest.mark.parametrize("listed", [True, False])
def test_compaction_cut_in_the_middle_of_the_swap(spark, job, listed):
    run = active_run(spark, job.sinks)
    tables.stage_day(spark, job.sinks.raw, RAW_SCHEMA, DAY, run)
    staged = f"{job.sinks.raw}/day={DAY}/{tables.STAGED}"
    if listed:
        tables.drop(spark, f"{job.sinks.raw}/day={DAY}/run=*/batch_id=0")
    else:
        tables.drop(spark, f"{staged}/{tables.SOURCES}")
    job.batch((20, "late", "2024-01-01 11:00:00"))
    job.upkeep()
    assert job.ids() == ["a0", "a1", "a2", "b0", "b1", "b2", "late"] and not path_exists(spark, staged)


def test_a_batch_that_runs_again_is_not_compacted_before(spark, job):
    run = active_run(spark, job.sinks)
    done = tables.committed(spark, job.sinks.checkpoint(run))
    again = job.records((30, "c", "2024-01-01 12:00:00"))
    process_batch(again, done + 1, job.sinks, job.settings, job.events, run)  # written, and not committed
    job.upkeep()
    process_batch(again, done + 1, job.sinks, job.settings, job.events, run)
    assert job.ids() == ["a0", "a1", "a2", "b0", "b1", "b2", "c"]


def test_retention_goes_by_a_clock(spark, job):
    job.batch((40, "future", "2031-05-05 00:00:00"), (41, "undated", None))
    assert job.upkeep("--retentionDays", "2", "--today", "2024-01-04")["procure_raw"] == [DAY]
    assert job.ids() == ["b0", "b1", "b2", "future", "undated"]
    assert job.upkeep("--retentionDays", "36500")["procure_raw"] == []
    # Without a clock: the newest day, but never a future one.
    today = dt.datetime.now(dt.timezone.utc).date()
    keep = (today - dt.date(2024, 1, 2)).days
    assert job.upkeep("--retentionDays", str(keep))["procure_raw"] == [] and job.upkeep("--retentionDays", str(keep - 1))["procure_raw"] == [dt.date(2024, 1, 2)]
    assert job.ids() == ["future", "undated"]


def test_a_missing_pointer_removes_nothing(spark, job):
    run = active_run(spark, job.sinks)
    tables.drop(spark, job.sinks.pointer)
    with pytest.raises(RuntimeError, match="is missing"):
        job.batch((50, "x", "2024-01-01 10:00:00"))
    assert len(job.ids()) == 6
    tables.write_text(spark, job.sinks.pointer, run)
    job.batch()
    assert len(job.ids()) == 7


def test_small_texts_are_replaced(spark):
    path = f"{scratch_dir(spark, 't_text')}/name"
    for text in ("one", "two"):
        tables.write_text(spark, path, text)
        assert tables.read_text(spark, path) == text and not path_exists(spark, f"{path}.new")


def test_records_delivered_again_are_taken_once(spark):
    job = Job(spark, RunSettings(dedupe_within="2 days"))
    row = lambda i, day=1: (i, f"r{i}", f"2024-01-0{day} 10:00:00")
    job.batch(row(0), row(0), row(1), (2, "r0", "2024-01-01 10:00:00"))  # equal fields at another offset are another record
    job.batch(row(1), row(3))
    job.batch(row(0), row(4, 2))
    assert job.ids() == ["r0", "r0", "r1", "r3", "r4"]
    for _ in range(2):  # the watermark moves on and the state forgets
        job.batch(row(9, 9))
    state = spark.read.format("statestore").load(job.sinks.checkpoint(active_run(spark, job.sinks)))
    assert {r["key"]["offset"] for r in state.collect()} == {9}
    assert job.ids() == ["r0", "r0", "r1", "r3", "r4", "r9"]


def test_compaction_shuffles_nothing(spark):
    """Rows dealt out anew are sorted and spilled on the way: a day's files are only put together."""
    from pyspark.sql import types as T
    path, day = f"{scratch_dir(spark, 't_together')}/t", dt.date(2024, 1, 1)
    for n in range(3):
        tables.write_batch(spark.range(n, n + 2).withColumn("day", F.lit(day)), path, "r", n)
    plans = []
    from pyspark.sql.readwriter import DataFrameWriter
    write = DataFrameWriter.parquet
    try:
        DataFrameWriter.parquet = lambda self, *a, **k: (plans.append(self._df._jdf.queryExecution().executedPlan().toString()), write(self, *a, **k))[1]
        tables.compact_day(spark, path, T.StructType([T.StructField("id", T.LongType())]), day, "r")
    finally:
        DataFrameWriter.parquet = write
    assert len(plans) == 1 and "Exchange" not in plans[0]
    assert len(tables.folders(spark, f"{path}/day={day}/run=r/batch_id=*/*.parquet")) == 1
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 1, 2, 2, 3]


@pytest.mark.parametrize("heap_first", [False, True])
def test_keys_of_delivered_records_are_kept_off_the_heap(spark, heap_first):
    """A checkpoint that began with another store goes on with it."""
    from payguard.streaming.fanout import STATE_STORE
    job = Job(spark, RunSettings(dedupe_within="30 days"))
    if heap_first:
        spark.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        job.batch((0, "a", "2024-01-01 10:00:00"), (0, "a", "2024-01-01 10:00:00"))
    finally:
        spark.conf.unset(STATE_STORE)
    job.batch((0, "a", "2024-01-01 10:00:00"), (1, "b", "2024-01-01 10:00:00"))
    assert job.ids() == ["a", "b"] and spark.conf.get(STATE_STORE, None) is None
    state = f"{job.sinks.checkpoint(active_run(spark, job.sinks))}/state/0/0"
    assert bool(tables.folders(spark, f"{state}/*.delta")) == heap_first and bool(tables.folders(spark, f"{state}/*.zip")) != heap_first

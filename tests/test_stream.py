"""Stream job: fan-out, quarantine, replays, retries, forwarding, dated tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from payguard.config import RunSettings
from payguard.operators.decode import decode_invoice, split_errors
from payguard.operators.score import EmptyScorer, LinearScorer
from payguard.plans.risk_job import late_invoice_risk
from payguard.schemas import INVOICE_SCHEMA, RAW_SCHEMA
from payguard.session import scratch_dir
from payguard.sources.records import as_records, next_offsets, read_records, stream_records
from payguard.streaming import tables
from payguard.streaming.fanout import (PublishOnce, RiskEventTable, Sinks, active_run, process_batch, read_anomaly,
                                       read_quarantine, read_raw, start_fanout)


def late(i, amount="9000", delay="120"):
    return json.dumps({"Invoice_ID": i, "Invoice_Amount": amount, "Pay_Type": "Late", "Pay_Delay": delay})


def records(spark, values, first=0, day="2024-01-01"):
    rows = [(f"k{first + i}", v, first + i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "key STRING, value STRING, at BIGINT")
    return as_records(df, "raw", F.col("at") % 2, F.col("at"), F.lit(day).cast("timestamp"))


PAYLOADS = [late("", "0", "0").replace("Late", ""), late("", "0", "0").replace("Late", ""), late("I3", "1625", "18"), late("I4"), "{bad"]


class Job:
    """A topic folder, the job's tables and its risk events."""

    def __init__(self, spark, name, values=PAYLOADS):
        self.spark, root = spark, scratch_dir(spark, name)
        self.topic, self.sinks, self.events = f"{root}/topic", Sinks(f"{root}/tables"), RiskEventTable(f"{root}/events")
        self.sent = 0
        for v in values:
            self.publish(v)

    def publish(self, value, day="2024-01-01"):
        """One record, in a file of its own."""
        records(self.spark, [value], self.sent, day).coalesce(1).write.mode("append").parquet(self.topic)
        self.sent += 1

    def drain(self, files=None, **options):
        start_fanout(stream_records(self.spark, self.topic, files), self.sinks, options.pop("risk_sink", self.events), **options).awaitTermination()

    def stored(self):
        raw = sorted(str(r.Invoice_ID) for r in read_raw(self.spark, self.sinks).collect())
        risk = sorted((r.Invoice_ID, r.Risk) for r in read_anomaly(self.spark, self.sinks).collect())
        events = sorted(json.loads(bytes(r.value))["id"] for r in self.events.read(self.spark).collect())
        aside = sorted((r.offset, r.reason, r.payload) for r in read_quarantine(self.spark, self.sinks).collect())
        return raw, risk, events, aside


ALL = (["", "", "I3", "I4"], [("I3", "Low"), ("I4", "High")], ["I3", "I4"], [(4, "malformed json", "{bad")])


def test_fanout_sinks(spark):
    job = Job(spark, "t_fanout")
    job.drain()
    assert job.stored() == ALL


def test_bounded_batches_store_the_same(spark):
    job = Job(spark, "t_bounded")
    job.drain(files=1)
    assert job.stored() == ALL
    assert read_raw(spark, job.sinks).count() == 4 and tables.read_index(spark, job.sinks.raw, RAW_SCHEMA).select("batch_id").distinct().count() == 4


def test_restart_processes_only_new_records(spark):
    job = Job(spark, "t_restart")
    job.drain()
    job.drain()  # nothing new
    job.publish(late("I5"))
    job.drain()
    assert job.stored()[2] == ["I3", "I4", "I5"]


def test_replay_then_plain_start_loses_and_doubles_nothing(spark):
    """Batches of the replay are cut elsewhere than those before it."""
    job = Job(spark, "t_replay", [late("a"), late("b")])
    job.drain()
    job.publish(late("c"))
    job.drain(files=1, replay=True)
    assert job.stored()[0] == ["a", "b", "c"]
    job.drain()
    job.publish(late("d"))
    job.drain()
    raw, risk, events, aside = job.stored()
    assert raw == events == [i for i, _ in risk] == ["a", "b", "c", "d"] and aside == []


def test_replay_empties_every_sink(spark):
    job = Job(spark, "t_clear", ["{bad", late("a"), "{bad", late("b"), "{bad", late("c")])
    job.drain(files=1)
    job.drain(replay=True)
    raw, risk, events, aside = job.stored()
    assert raw == events == ["a", "b", "c"] and len(aside) == 3


def test_interrupted_replay_is_cleaned_by_the_next_start(spark):
    job = Job(spark, "t_cut")
    job.drain()
    active_run(spark, job.sinks, replay=True)  # the pointer moved, then the job was lost
    job.drain()
    assert job.stored() == ALL


def test_retried_batch_replaces_its_first_attempt(spark):
    job = Job(spark, "t_retry")
    batch = read_records(spark, job.topic)
    for _ in range(2):
        process_batch(batch, 0, job.sinks, RunSettings(), job.events)
    assert job.stored() == ALL
    process_batch(batch, 0, job.sinks, RunSettings(), job.events, scorer=LinearScorer())
    process_batch(batch, 0, job.sinks, RunSettings(), job.events, scorer=EmptyScorer())
    raw, risk, events, aside = job.stored()
    assert len(raw) == 4 and risk == [] and events == []
    assert [(o, r) for o, r, _ in aside] == [(2, "empty predictions"), (3, "empty predictions"), (4, "malformed json")]
    process_batch(batch.limit(0), 0, job.sinks, RunSettings(), job.events)
    assert job.stored() == ([], [], [], [])


def test_a_batch_is_read_once(spark):
    """Ids that differ from reading to reading are the same in all sinks; nothing is left of what was staged."""
    job = Job(spark, "t_read_once", [])
    body = F.concat(F.lit(late("x").split("x")[0]), F.expr("uuid()"), F.lit(late("x").split("x")[1]))
    process_batch(spark.range(20).select(body.alias("value")), 0, job.sinks, RunSettings(), job.events)
    raw, risk, events, _ = job.stored()
    assert raw == events == [i for i, _ in risk] and len(set(raw)) == 20
    assert tables.folders(spark, f"{job.sinks.staged}/*") == []


def test_publish_once(spark):
    job = Job(spark, "t_once")
    calls = []
    sink = PublishOnce(lambda events, n: calls.append((n, events.count())), f"{job.sinks.root}/_published")
    batch = read_records(spark, job.topic)
    for n in (0, 0, 1, 1, 0):
        process_batch(batch, n, job.sinks, RunSettings(), sink)
    assert calls == [(0, 2), (1, 2)]
    assert len(tables.folders(spark, f"{sink.markers}/*")) == 1
    calls.clear()
    job.drain(risk_sink=sink)
    job.drain(risk_sink=sink)  # nothing new
    job.drain(risk_sink=sink, replay=True)
    assert sum(n for _, n in calls) == 4  # two events, sent once in each run


def test_quarantine_keeps_what_is_needed_to_send_again(spark):
    rows = [late("x"), late("x").replace('"Invoice_ID": "x", ', ""), late(""), "{bad", '{"Pay_Delay":"17.0"}']
    job = Job(spark, "t_aside", rows)
    job.drain()
    assert [r for r, _ in job.stored()[1]] == ["", "x"]
    got = [(r.topic, r.partition, r.offset, r.reason, r.payload) for r in read_quarantine(spark, job.sinks).orderBy("offset").collect()]
    assert got == [("raw", 1, 1, "null event id", rows[1]), ("raw", 1, 3, "malformed json", "{bad"), ("raw", 0, 4, "bad int Pay_Delay", rows[4])]


def test_model_path_runs_in_a_stream(spark):
    job = Job(spark, "t_model")
    job.drain(scorer=LinearScorer())
    # delay 18 -> 13.6 -> 14 Low; delay 120 -> 90.1 -> 91 Medium (the amount is not used)
    got = {r.Invoice_ID: (r.Risk, r.Model_Name) for r in read_anomaly(spark, job.sinks).collect()}
    assert got == {"I3": ("Low", "anomaly-classifier-predictor"), "I4": ("Medium", "anomaly-classifier-predictor")}


def test_days_are_pruned_compacted_and_dropped(spark):
    job = Job(spark, "t_days", [])
    for day in range(1, 6):
        for i in range(2):
            job.publish(late(f"{day}{i}"), f"2024-01-0{day}")
    job.drain(files=1)
    everything = job.stored()
    rows = tables.read_index(spark, job.sinks.raw, RAW_SCHEMA)
    plan = rows.where(F.col("day") == F.lit("2024-01-02").cast("date"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and rows.where(F.col("day") == F.lit("2024-01-02").cast("date")).count() == 2
    run = active_run(spark, job.sinks)
    tables.compact_day(spark, job.sinks.raw, RAW_SCHEMA, dt.date(2024, 1, 1), run)
    assert len(tables.folders(spark, f"{job.sinks.raw}/day=2024-01-01/run={run}/batch_id=*")) == 1
    assert job.stored() == everything
    gone = tables.drop_old_days(spark, job.sinks.raw, keep_days=2)
    assert gone == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert job.stored()[0] == [f"{d}{i}" for d in (3, 4, 5) for i in (0, 1)]


def test_cut_short_compaction_is_finished(spark):
    job = Job(spark, "t_compact", [late("a"), late("b")])
    job.drain(files=1)
    run, day = active_run(spark, job.sinks), dt.date(2024, 1, 1)
    here = f"{job.sinks.raw}/day={day}"
    tables.read_index(spark, job.sinks.raw, RAW_SCHEMA).drop(*tables.PARTS.names).write.parquet(f"{here}/{tables.STAGED}")
    assert len(job.stored()[0]) == 2  # staged rows are not read
    tables.drop(spark, f"{here}/run=*/batch_id=0")  # lost in the middle of the swap
    tables.compact_day(spark, job.sinks.raw, RAW_SCHEMA, day, run)
    assert job.stored()[0] == ["a", "b"]


def test_kafka_source_caps_records_per_batch():
    from payguard.config import KafkaSecurity
    from payguard.sources.kafka import raw_stream_options
    opts = raw_stream_options(RunSettings(), KafkaSecurity())
    assert opts["maxOffsetsPerTrigger"] == str(RunSettings().max_records_per_trigger)
    assert opts["startingOffsets"] == "earliest" and opts["includeHeaders"] == "true"
    assert raw_stream_options(RunSettings(), KafkaSecurity(), 500)["maxOffsetsPerTrigger"] == "500"


def test_stream_equals_batch(spark):
    job = Job(spark, "t_eq")
    batch = late_invoice_risk(split_errors(decode_invoice(read_records(spark, job.topic)))[0])
    out = scratch_dir(spark, "t_eq_out")
    good = split_errors(decode_invoice(stream_records(spark, job.topic)))[0]
    q = (late_invoice_risk(good).writeStream.format("parquet").option("path", f"{out}/d")
         .option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(spark.read.parquet(f"{out}/d").collect()) == sorted(batch.collect())


def test_forward_stream_delivers_only_new(spark):
    from payguard.streaming.forward import forward_stream
    job = Job(spark, "t_fwd", ["old0", "old1", "old2"])
    out = scratch_dir(spark, "t_fwd_out")
    next_offsets(read_records(spark, job.topic)).write.parquet(f"{out}/marks")
    job.publish("new3")

    def deliver(df, batch_id):
        df.write.mode("append").parquet(f"{out}/got")

    forward_stream(stream_records(spark, job.topic), deliver, f"{out}/ck", spark.read.parquet(f"{out}/marks")).awaitTermination()
    (r,) = spark.read.parquet(f"{out}/got").collect()
    assert (r.data, r.ce_id, r.ce_subject) == ("new3", "partition:1/offset:3", "partition:1#3")
    assert r.ce_type == "dev.knative.kafka.event" and r.ce_source == "/apis/v1/sources/subscriber#raw"


def test_init_tables_idempotent(spark, tmp_path):
    from payguard.operators.readback import init_tables
    names = {"pg_raw_t": RAW_SCHEMA, "pg_risk_t": INVOICE_SCHEMA}
    assert init_tables(spark, names, str(tmp_path)) == list(names)
    spark.sql("INSERT INTO pg_risk_t VALUES ('I', 1.0, '', 'Late', 1, 'Low', NULL)")
    assert init_tables(spark, names, str(tmp_path)) == []  # already there: no error, data kept
    assert spark.table("pg_risk_t").count() == 1
    types = {f.name: f.dataType.simpleString() for f in spark.table("pg_raw_t").schema.fields}
    assert types["Invoice_Amount"] == "float" and types["Pay_Delay"] == "int" and types["Plant"] == "string"


def test_strict_mode_fails_even_when_only_filter_columns_are_read(spark):
    import pytest
    from pyspark.errors import PySparkException
    bad = spark.createDataFrame([('{"Invoice_Amount":"abc","Pay_Type":"On Time"}',)], "value STRING")
    with pytest.raises(PySparkException):
        decode_invoice(bad, mode="strict").where(F.col("Pay_Type") == "Late").count()


def test_retention_to_the_instant_rewrites_one_day(spark):
    """Rows before the limit go, whatever batch they are in; files of other days stay as they are."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("timestamp", T.TimestampType())])
    path = f"{scratch_dir(spark, 't_exact')}/t"
    times = ["2024-01-01 05:00:00", "2024-01-02 05:59:59.999", "2024-01-02 06:00:00", "2024-01-02 07:00:00", "2024-01-03 00:00:00", None]
    for n in range(2):
        df = spark.createDataFrame(list(enumerate(times)), "i INT, t STRING").select("i", F.col("t").cast("timestamp").alias("timestamp"))
        tables.write_batch(df.withColumn("day", F.to_date("timestamp")), path, "r", n)
    files = lambda day: {f.rsplit("/", 1)[1] for f in tables.folders(spark, f"{path}/day={day}/run=*/batch_id=*/*.parquet")}
    rows = lambda: sorted(r.i for r in tables.read_index(spark, path, schema).collect())
    later = files("2024-01-03")
    limit = dt.datetime(2024, 1, 2, 6)
    assert tables.drop_older(spark, path, schema, limit, "r", upto=0) == [dt.date(2024, 1, 1)]
    assert rows() == [1, 2, 2, 3, 3, 4, 4, 5, 5]  # batch 1 isn't committed
    tables.drop_older(spark, path, schema, limit, "r")
    assert rows() == [2, 2, 3, 3, 4, 4, 5, 5] and files("2024-01-03") == later
    cut = files("2024-01-02")
    tables.drop_older(spark, path, schema, limit, "r")
    assert files("2024-01-02") == cut  # nothing to drop, nothing rewritten
    tables.write_batch(df.where("i = 3").withColumn("day", F.to_date("timestamp")), path, "r", 2)
    tables.compact_day(spark, path, schema, limit.date(), "r")
    assert rows() == [2, 2, 3, 3, 3, 4, 4, 5, 5]
    tables.drop_older(spark, path, schema, dt.datetime(2024, 1, 2, 23), "r")
    assert rows() == [4, 4, 5, 5]

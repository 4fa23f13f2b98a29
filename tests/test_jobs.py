"""Submit-able jobs: producer from a sample CSV, then the stream processor."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from payguard.jobs import finish, forward_job, parse_options, produce_job, stream_job, upkeep_job
from payguard.schemas import RAW_FIELDS
from payguard.session import scratch_dir
from payguard.sources.records import as_records
from payguard.streaming.fanout import RiskEventTable, Sinks, read_raw, refresh_index_tables


def _sample_csv(spark):
    from payguard.functions.timefmt import sample_time_text
    from payguard.sources.adapter import raw_text_adapter
    from payguard.sources.files import write_sample_csv
    raw = raw_text_adapter(spark, SMOKE)
    raw = raw.withColumn("DateTime", sample_time_text(F.to_timestamp("DateTime", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    path = f"{scratch_dir(spark, 't_jobs_sample')}/sample"
    write_sample_csv(raw.select(*RAW_FIELDS), path)
    return path, raw.count()


def test_parse_options_flags_and_values():
    opts = parse_options(["--tableRoot", "/t", "--availableNow", "--rawTopic", "x", "--replay"],
                         ("tableRoot",))
    assert opts == {"tableRoot": "/t", "availableNow": "true", "replay": "true"}
    # A flag given a value ("true") and a blank value both parse as meant.
    opts = parse_options(["--availableNow", "true", "--modelPredictorURL", "", "--tableRoot", "/t"],
                         ("tableRoot", "modelPredictorURL"))
    assert opts == {"availableNow": "true", "modelPredictorURL": "", "tableRoot": "/t"}


def _produce(spark, sample, out, *args, tick_s=0.25):
    query, last, pacing = produce_job(["--sample", sample, "--outPath", out, *args], spark, tick_s)
    finish(query, last, pacing, tick_s)
    return spark.read.parquet(out)


def test_produce_then_stream(spark):
    from payguard.plans.risk_job import late_invoice_risk
    from payguard.sources.adapter import invoice_adapter
    sample, n = _sample_csv(spark)
    root = scratch_dir(spark, "t_jobs")
    group = (n + 2) // 3  # three groups: three steps
    sent = _produce(spark, sample, f"{root}/sent", "--messagesPerGroup", str(group), "--secondsToPause", "1", "--repetitions", "1")
    assert sent.count() == n and sent.select("key").distinct().count() == n
    as_records(sent.select("key", "value", "headers"), "raw", F.lit(0), F.monotonically_increasing_id(),
               F.lit("2024-01-01").cast("timestamp")).repartition(4).write.parquet(f"{root}/topic")

    tag = uuid.uuid4().hex[:8]
    args = ["--recordsPath", f"{root}/topic", "--riskPath", f"{root}/risk", "--tableRoot", f"{root}/tables", "--availableNow",
            "--modelPredictorURL", "", "--maxFilesPerTrigger", "2", "--esRawIndex", f"raw-{tag}", "--esRiskIndex", f"risk-{tag}"]
    stream_job(args, spark).awaitTermination()
    sinks = Sinks(f"{root}/tables", f"raw-{tag}", f"risk-{tag}")
    assert read_raw(spark, sinks).count() == n
    refresh_index_tables(spark, sinks)
    got = spark.table(f"risk_{tag}").drop("day", "run", "batch_id")
    want = late_invoice_risk(invoice_adapter(spark, SMOKE))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert RiskEventTable(f"{root}/risk").read(spark).count() == want.count()
    assert upkeep_job(["--tableRoot", f"{root}/tables", "--retentionDays", "7", "--compact", "--esRawIndex", f"raw-{tag}"], spark)[f"raw-{tag}"] == []


def test_produce_without_pause_sends_all_passes(spark):
    sample, n = _sample_csv(spark)
    sent = _produce(spark, sample, f"{scratch_dir(spark, 't_jobs1')}/sent", "--repetitions", "2")
    assert sent.count() == 2 * n and sent.select("key").distinct().count() == 2 * n
    split = _produce(spark, sample, f"{scratch_dir(spark, 't_jobs1')}/split", "--repetitions", "2", "--splitSample")
    assert split.count() == 2 * n and split.select("value").exceptAll(sent.select("value")).count() == 0


def test_endless_replay_starts_and_stops(spark):
    sample, n = _sample_csv(spark)
    out = f"{scratch_dir(spark, 't_jobs2')}/sent"
    query, last, _ = produce_job(["--sample", sample, "--outPath", out, "--repetitions", "-1"], spark, 0.25)
    assert last is None
    deadline = time.time() + 90
    while time.time() < deadline and query.isActive:
        time.sleep(1)
        done = query.lastProgress
        if done and (done["sources"][0].get("endOffset") or 0) and int(done["sources"][0]["endOffset"]) >= 3:
            break
    query.stop()
    sent = spark.read.parquet(out)
    assert sent.count() >= 2 * n and sent.count() == sent.select("key").distinct().count()


def test_a_missing_ca_file_fails_at_the_start(spark):
    with pytest.raises(FileNotFoundError):
        stream_job(["--modelPredictorURL", "https://model:8443/v1", "--modelCaFile", "/nowhere/ca.pem", "--recordsPath", "/nowhere"], spark)


def test_forward_job_posts_new_events(spark):
    root = scratch_dir(spark, "t_jobs_fwd")
    rows = spark.createDataFrame([("k", f'{{"n":{i}}}', i) for i in range(3)], "key STRING, value STRING, at BIGINT")
    as_records(rows, "risk", F.lit(0), F.col("at"), F.lit("2024-01-01").cast("timestamp")).write.parquet(f"{root}/topic")
    job = ["--recordsPath", f"{root}/topic", "--outPath", f"{root}/got", "--checkpoint", f"{root}/ck", "--availableNow"]
    forward_job(job, spark).awaitTermination()  # nothing is new yet
    with pytest.raises(ValueError):
        forward_job(["--recordsPath", f"{root}/topic"], spark)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from payguard.session import scratch_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        scratch_root(Session())


def test_paced_sample_reads_only_its_ranges(spark, monkeypatch):
    """Steps that wrap into the next pass, the remainder of a pass, a sample within one group, an empty one; the scan is pruned."""
    from payguard.operators import replay
    monkeypatch.setattr(replay, "RANGE_ROWS", 4)
    ticks = lambda *steps: spark.createDataFrame([(s,) for s in steps], "step BIGINT")
    got = lambda paced, *steps: sorted((r.step, r.rep, r.seq) for r in paced.due(ticks(*steps)).collect())
    want = lambda n, g, reps: sorted((r * (n // g) + i // g, r, i) for r in range(reps) for i in range(n))
    paced = replay.PacedSample(spark.range(23), ["id"], replay.Pacing(2, 1, 3))
    every = want(23, 2, 3)
    for a in range(0, 36, 4):
        assert got(paced, *range(a, a + 4)) == [x for x in every if a <= x[0] < a + 4]
    assert got(paced, *range(40)) == every
    plan = paced.due(ticks(12, 13))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_range" in plan and "(_range" in plan.split("PartitionFilters: [")[1].split("]")[0]
    endless = replay.PacedSample(spark.range(23), ["id"], replay.Pacing(2, 1, -1))
    assert got(endless, 100, 101) == [x for x in want(23, 2, 12) if x[0] in (100, 101)]
    assert got(replay.PacedSample(spark.range(3), ["id"], replay.Pacing(5, 1, 2)), 0, 1) == [(0, r, i) for r in (0, 1) for i in range(3)]
    assert got(replay.PacedSample(spark.range(3), ["id"], replay.Pacing(5, 1, -1)), 4) == [(4, 4, i) for i in range(3)]
    assert got(replay.PacedSample(spark.range(0), ["id"], replay.Pacing(2, 1, -1)), 0, 1) == []
    assert paced.due(spark.createDataFrame([], "step BIGINT")).count() == 0

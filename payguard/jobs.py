"""Submit-able jobs: the stream processor, the sample producer, the forwarder, table upkeep.

    spark-submit payguard_job.py stream  --rawTopic procure-raw --riskTopic procure-risk \\
        --modelPredictorURL https://... --modelCaFile ca.pem --tableRoot s3://bucket/tables --bootstrapServers host:9093
    spark-submit payguard_job.py produce --sample s3://bucket/sample.csv \\
        --messagesPerGroup 10 --secondsToPause 1 --repetitions 1 --bootstrapServers host:9093
    spark-submit payguard_job.py forward --riskTopic procure-risk --subscriberURL http://... --bootstrapServers host:9093
    spark-submit payguard_job.py upkeep  --tableRoot s3://bucket/tables --retentionDays 7

(or ``python -m payguard.jobs ...``). The processor takes the original job's
argument names (``groupId rawTopic riskTopic esRawIndex esRiskIndex
modelPredictorURL``; blank -> default) plus our own: ``tableRoot`` (where the
index tables are; default ``<spark.checkpoint.dir>/tables``; ``esRawIndex`` and
``esRiskIndex`` name them), ``modelName``, ``modelCaFile``, Kafka connection
and security (``bootstrapServers scramUser scramPasswordFile truststore
truststorePasswordFile``), the bound of a micro-batch (``maxOffsetsPerTrigger``),
``indexURL`` (a search index's bulk address; its requests are bounded by ``bulk_rows``,
``bulk_bytes`` and ``bulk_interval_ms`` of the settings), ``availableNow`` (drain what is there and stop), ``dedupeWithin`` (take records that
are delivered again once, e.g. ``7 days``) and ``replay`` (start over from the first
record). Archived records stand in for Kafka where they are named:
``recordsPath`` (Kafka-shaped parquet to read, with ``maxFilesPerTrigger``) and
``riskPath`` or ``outPath`` (a table for what would be published).
``repetitions`` below 0 replays without end; ``splitSample`` reads a large sample file in splits.
"""

from __future__ import annotations

import sys
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from payguard.config import KafkaSecurity, RunSettings

_FLAGS = ("availableNow", "replay", "compact", "splitSample")


def parse_options(argv: list[str], names: tuple[str, ...]) -> dict[str, str]:
    """``--name value`` pairs for ``names``; flags in ``_FLAGS`` take no value."""
    out: dict[str, str] = {}
    i = 0
    while i < len(argv):
        if not argv[i].startswith("--"):  # a stray word, e.g. a flag's "true"
            i += 1
            continue
        name = argv[i][2:]
        if name in _FLAGS:
            out[name] = "true"
            i += 1
            continue
        has_value = i + 1 < len(argv) and not argv[i + 1].startswith("--")
        if name in names and has_value:
            out[name] = argv[i + 1]
        i += 2 if has_value else 1
    return out


_SECURITY = ("bootstrapServers", "scramUser", "scramPasswordFile", "truststore", "truststorePasswordFile")


def security_from(opts: dict[str, str]) -> KafkaSecurity:
    return KafkaSecurity(bootstrap_servers=opts.get("bootstrapServers", "localhost:9092"),
                         scram_username=opts.get("scramUser"), scram_password_path=opts.get("scramPasswordFile"),
                         truststore_path=opts.get("truststore"),
                         truststore_password_path=opts.get("truststorePasswordFile"))


def _session() -> SparkSession:
    from payguard.session import prepare
    return prepare(SparkSession.builder.appName("payguard").getOrCreate())


def _limit(opts: dict[str, str], name: str) -> int | None:
    return int(opts[name]) if opts.get(name) else None


def _tables(spark: SparkSession, settings: RunSettings, opts: dict[str, str]):
    from payguard.session import scratch_root
    from payguard.streaming.fanout import Sinks
    return Sinks(opts.get("tableRoot") or f"{scratch_root(spark).rstrip('/')}/tables", settings.raw_table, settings.risk_table)


def stream_job(argv: list[str], spark: SparkSession | None = None, scorer=None, connect=None):
    """Start the processor; returns the StreamingQuery. ``connect`` makes the index's connections (default: http)."""
    from payguard.streaming.fanout import RiskEventTable, create_index_tables, kafka_risk_sink, refresh_index_tables, start_fanout
    spark = spark or _session()
    settings = RunSettings.from_argv(argv)
    settings.ca_data()  # a missing file is an error now, not in the first batch
    opts = parse_options(argv, _SECURITY + ("tableRoot", "recordsPath", "riskPath", "maxOffsetsPerTrigger", "maxFilesPerTrigger", "indexURL"))
    sinks = _tables(spark, settings, opts)
    create_index_tables(spark, sinks)
    refresh_index_tables(spark, sinks)
    if opts.get("recordsPath"):
        from payguard.sources.records import stream_records
        source = stream_records(spark, opts["recordsPath"], _limit(opts, "maxFilesPerTrigger"))
    else:
        from payguard.sources.kafka import raw_stream
        source = raw_stream(spark, settings, security_from(opts), _limit(opts, "maxOffsetsPerTrigger"))
    risk = RiskEventTable(opts["riskPath"]) if opts.get("riskPath") else kafka_risk_sink(settings, security_from(opts), sinks)
    index = None
    if opts.get("indexURL"):
        from payguard.sources.bulk import BulkIndex, Limits
        index = BulkIndex(opts["indexURL"], f"{sinks.root}/_bulk", Limits(settings.bulk_rows, settings.bulk_bytes, settings.bulk_interval_ms), connect)
    return start_fanout(source, sinks, risk, settings, scorer, available_now="availableNow" in opts, replay="replay" in opts, index=index)


def producer_events(rows: DataFrame, settings: RunSettings, seed: str) -> DataFrame:
    """Paced rows (``rep``, ``seq``, ``step``) as binary-mode events. An event's id
    is a UUID made of the producer's seed, its pass and its position, so a step
    that is sent again sends the same ids."""
    from payguard.operators.encode import binary_events
    from payguard.schemas import RAW_FIELDS
    h = F.md5(F.concat_ws(":", F.lit(seed), F.col("rep").cast("string"), F.col("seq").cast("string")).cast("binary"))
    eid = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return binary_events(rows, RAW_FIELDS, id_col=eid, settings=settings, keep=("rep", "seq", "step"))


def produce_job(argv: list[str], spark: SparkSession | None = None, tick_s: float = 1.0):
    """Publish the sample, paced by one streaming query. Returns that query; it
    ends by itself after the last step of a finite replay (:func:`finish`)."""
    from payguard.operators.decode import normalise_datetime
    from payguard.operators.replay import PacedSample, Pacing, last_step, step_ticks
    from payguard.session import materialise, scratch_dir
    from payguard.sources.files import POSITION, read_large_csv, read_sample_csv
    spark = spark or _session()
    settings = RunSettings.from_argv(argv)
    opts = parse_options(argv, _SECURITY + ("sample", "outPath", "messagesPerGroup", "secondsToPause", "repetitions", "checkpoint", "splitSample"))
    pacing = Pacing.from_text(opts.get("messagesPerGroup"), opts.get("secondsToPause"), opts.get("repetitions"))
    # The rows' order is their place in the files; a bad time fails the job.
    read = read_large_csv if opts.get("splitSample") else read_sample_csv
    sample = normalise_datetime(read(spark, opts["sample"], position=True), strict=True).drop("event_time")
    sample = materialise(sample, "producer-sample")
    send = _sender(settings, opts)
    checkpoint = opts.get("checkpoint") or scratch_dir(spark, "producer")
    seed = f"{settings.event_source}|{checkpoint}"

    paced = PacedSample(sample, list(POSITION), pacing)

    def step(ticks: DataFrame, batch_id: int) -> None:
        send(producer_events(paced.due(ticks), settings, seed), batch_id)

    ticks = step_ticks(spark, pacing, tick_s)
    query = ticks.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).queryName(f"produce_{uuid.uuid4().hex[:8]}").start()
    return query, last_step(sample.count(), pacing), pacing


def finish(query, last: int | None, pacing, tick_s: float = 1.0) -> None:
    """Wait for a producer: until its last step is sent, or for ever."""
    if last is None:
        query.awaitTermination()
        return
    pause = max(pacing.pause_s * tick_s, 0.001)
    need = last * int(pause) if pause > 1 else last
    while query.isActive:
        done = query.lastProgress
        end = done["sources"][0].get("endOffset") if done else None
        # The rate source's offset is in whole seconds.
        if end is not None and int(end) * (1 if pause > 1 else max(int(1 / pause), 1)) > need:
            query.stop()
            return
        query.awaitTermination(0.2)


def _sender(settings: RunSettings, opts: dict[str, str]):
    """Publishes a step's events: to the raw topic, or to the table named by ``outPath``."""
    if opts.get("outPath"):
        from payguard.streaming.tables import write_batch
        return lambda events, n: write_batch(events.withColumn("day", F.current_date()), opts["outPath"], "produced", n)
    from payguard.sources.kafka import publish
    security = security_from(opts)
    return lambda events, n: publish(events.select("key", "value", "headers"), settings.raw_topic, security)


def forward_job(argv: list[str], spark: SparkSession | None = None, connect=None):
    """Forward risk events to a subscriber's URL; returns the StreamingQuery.

    The subscription is named by ``groupId`` (or ``subscription``): its offsets are kept
    under the table root. It begins with what arrives after its first start and goes on
    where it stopped at every later one, so what came in between is delivered then.
    ``checkpoint`` keeps it elsewhere.
    """
    from payguard.streaming.forward import Subscription, forward_stream, post_to
    spark = spark or _session()
    settings = RunSettings.from_argv(argv)
    opts = parse_options(argv, _SECURITY + ("tableRoot", "subscriberURL", "outPath", "recordsPath", "sourcePrefix", "checkpoint", "subscription"))
    if opts.get("outPath"):
        from payguard.streaming.tables import write_batch
        deliver = lambda batch, n: write_batch(batch.withColumn("day", F.current_date()), opts["outPath"], "forwarded", n)
    elif opts.get("subscriberURL"):
        deliver = post_to(opts["subscriberURL"], ca_data=settings.ca_data(), connect=connect)
    else:
        raise ValueError("forward needs --subscriberURL or --outPath")
    place = opts.get("checkpoint") or f"{_tables(spark, settings, opts).root}/_subscriptions/{opts.get('subscription') or settings.group_id}"
    subscription, marks = Subscription(place), None
    if opts.get("recordsPath"):
        from payguard.sources.records import read_records, stream_records
        records = stream_records(spark, opts["recordsPath"])
        marks = subscription.marks(read_records(spark, opts["recordsPath"]))
    else:
        from payguard.sources.kafka import risk_stream_new_only
        records = risk_stream_new_only(spark, settings, security_from(opts))
    more = {"source_prefix": opts["sourcePrefix"]} if opts.get("sourcePrefix") else {}
    return forward_stream(records, deliver, subscription.checkpoint, marks, available_now="availableNow" in opts, **more)


def upkeep_job(argv: list[str], spark: SparkSession | None = None) -> dict[str, list]:
    """Retention and compaction of the index tables; returns the days dropped of each.

    Run it beside the stream job: ``compact`` rewrites only batches that the run's
    checkpoint has committed. ``today`` (a date) is the clock that ``retentionDays``
    counts back from; without it, the newest stored day that isn't in the future.
    """
    import datetime as dt

    from payguard.schemas import INVOICE_SCHEMA, RAW_SCHEMA
    from payguard.streaming import tables
    from payguard.streaming.fanout import QUARANTINE_SCHEMA
    spark = spark or _session()
    settings = RunSettings.from_argv(argv)
    opts = parse_options(argv, ("tableRoot", "retentionDays", "today"))
    sinks = _tables(spark, settings, opts)
    keep = _limit(opts, "retentionDays")
    clock = dt.date.fromisoformat(opts["today"]) if opts.get("today") else None
    run = tables.read_text(spark, sinks.pointer)
    gone = {}
    for path, schema in ((sinks.raw, RAW_SCHEMA), (sinks.anomaly, INVOICE_SCHEMA), (sinks.quarantine, QUARANTINE_SCHEMA)):
        gone[path.rsplit("/", 1)[1]] = tables.drop_old_days(spark, path, keep, clock) if keep is not None else []
        if "compact" in opts and run is not None:
            upto = tables.committed(spark, sinks.checkpoint(run))
            for day in sorted(tables.days_of(spark, path)):
                tables.compact_day(spark, path, schema, day, run, upto=upto)
    return gone


def main(argv: list[str] | None = None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    role = argv.pop(0) if argv else ""
    if role == "stream":
        stream_job(argv).awaitTermination()
    elif role == "produce":
        query, last, pacing = produce_job(argv)
        finish(query, last, pacing)
    elif role == "forward":
        forward_job(argv).awaitTermination()
    elif role == "upkeep":
        upkeep_job(argv)
    else:
        raise SystemExit("usage: payguard.jobs stream|produce|forward|upkeep [--name value ...]")


if __name__ == "__main__":
    main()

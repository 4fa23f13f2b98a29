"""Registered queries: one per operator, each over the driver's tables.

Every entry is ``key -> Query(run, sql)``: ``run(spark, sf_dir)`` returns a
Spark DataFrame; ``sql`` is the DuckDB text computing the same rows (None
when the result is not expressible in SQL, e.g. random ids).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from payguard.config import RunSettings
from payguard.functions.coerce import bad_float, bad_int, lenient_float, lenient_int
from payguard.functions.scoring import (decode_predictions, int64_le_bytes, linear_score, model_risk,
                                        round_up, round_up_text, signed_first_byte)
from payguard.operators.decode import ERROR_COL, decode_invoice, decode_raw, normalise_datetime
from payguard.operators.encode import (anomaly_documents, binary_attributes, binary_events, name_based_id,
                                       parse_structured_events, raw_documents, structured_risk_events)
from payguard.operators.forward import delivery_attributes, new_records, retention_window
from payguard.operators.readback import clear_table, index_total, search
from payguard.operators.replay import Pacing, pace, repeat
from payguard.operators.risk import grade_by_rule, grade_by_score, late_invoices, valid_invoices
from payguard.operators.score import EmptyScorer, LinearScorer
from payguard.plans import oracle as O
from payguard.plans.risk_job import late_invoice_risk
from payguard.schemas import INVOICE_SCHEMA, RAW_FIELDS, RAW_SCHEMA
from payguard.session import WIDE, materialise, prepare, scratch_dir
from payguard.sources.adapter import (defective_payloads, invoice_adapter, invoice_view, raw_payloads,
                                      raw_text_adapter, token_payloads)
from payguard.sources.files import read_large_csv, read_sample_csv, write_sample_csv
from payguard.sources.tables import read_table
from payguard.sources.records import as_records, next_offsets, stream_records
from payguard.streaming import scenario, tables
from payguard.streaming.fanout import active_run, process_batch, read_anomaly, read_quarantine, read_raw
from payguard.streaming.scenario import run_scenario


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(key: str, sql: str | None, doc: str = ""):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__ = fn.__name__
        REGISTRY[key] = Query(run, sql, doc or (fn.__doc__ or "").strip())
        return fn
    return deco


INV_COLS = "Invoice_ID, Invoice_Amount, Invoice_Due_Date, Pay_Type, Pay_Delay"

# ---------------------------------------------------------------- filters, rule


@register("valid_filter", O.with_inv(f"SELECT {INV_COLS} FROM inv WHERE {O.VALID_SQL}"))
def q_valid_filter(spark, sf_dir):
    """Invoices with a positive, non-NaN amount."""
    return valid_invoices(invoice_adapter(spark, sf_dir))


@register("late_filter", O.with_inv(f"SELECT {INV_COLS} FROM inv WHERE Pay_Type = 'Late'"))
def q_late_filter(spark, sf_dir):
    """Invoices paid late (exact, case-sensitive match)."""
    return late_invoices(invoice_adapter(spark, sf_dir))


@register("risk_rule", O.with_inv(
    f"SELECT {INV_COLS}, {O.RULE_RISK_SQL} AS Risk, CAST(NULL AS VARCHAR) AS Model_Name FROM inv"))
def q_risk_rule(spark, sf_dir):
    """Rule grade on every invoice (no filter)."""
    return grade_by_rule(invoice_adapter(spark, sf_dir))


FLAGSHIP_SQL = O.with_inv(
    f"SELECT {INV_COLS}, {O.RULE_RISK_SQL} AS Risk, CAST(NULL AS VARCHAR) AS Model_Name "
    f"FROM inv WHERE {O.VALID_SQL} AND Pay_Type = 'Late'")


@register("late_invoice_risk", FLAGSHIP_SQL)
def q_late_invoice_risk(spark, sf_dir):
    """Flagship: valid late invoices graded by the rule."""
    return late_invoice_risk(invoice_adapter(spark, sf_dir))

# ---------------------------------------------------------------- decode


NULL_S = "CAST(NULL AS VARCHAR)"


@register("raw_events", O.with_raw(f"SELECT {O.RAW_TYPED_COLS}, {NULL_S} AS _error FROM raw"))
def q_raw_events(spark, sf_dir):
    """Raw JSON payloads decoded to 35 typed columns (quarantine column kept)."""
    return decode_raw(raw_payloads(spark, sf_dir))


@register("invoice_projection", O.with_raw(
    "SELECT Invoice_ID, cast(Invoice_Amount AS FLOAT) AS Invoice_Amount, Invoice_Due_Date, Pay_Type, "
    f"cast(Pay_Delay AS INT) AS Pay_Delay, {NULL_S} AS Risk, {NULL_S} AS Model_Name, {NULL_S} AS _error FROM raw"))
def q_invoice_projection(spark, sf_dir):
    """Same payloads decoded to the 7-column invoice; unknown fields ignored."""
    return decode_invoice(raw_payloads(spark, sf_dir))


_LENIENT_SQL = """
WITH t AS (
  SELECT concat(cast(l_orderkey AS VARCHAR), '_', cast(l_linenumber AS VARCHAR), '_L1') AS Invoice_ID,
         CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN ''
              WHEN l_returnflag = 'A' THEN concat(' ', cast(cast(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR), ' ')
              ELSE cast(cast(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) END AS amount_text,
         CASE WHEN l_returnflag = 'N' THEN NULL
              WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN cast(l_quantity AS VARCHAR)
              ELSE cast(cast(l_quantity AS INT) * 4 AS VARCHAR) END AS delay_text
  FROM lineitem)
SELECT Invoice_ID, amount_text, delay_text,
       coalesce(try_cast(nullif(trim(amount_text), '') AS FLOAT), CAST(0 AS FLOAT)) AS Invoice_Amount,
       coalesce(CASE WHEN regexp_full_match(trim(delay_text), '[+-]?[0-9]+') THEN try_cast(trim(delay_text) AS INTEGER) END, 0) AS Pay_Delay,
       coalesce(nullif(trim(amount_text), '') IS NOT NULL AND try_cast(trim(amount_text) AS FLOAT) IS NULL, false) AS bad_amount,
       coalesce(nullif(trim(delay_text), '') IS NOT NULL AND NOT (regexp_full_match(trim(delay_text), '[+-]?[0-9]+')
                AND try_cast(trim(delay_text) AS INTEGER) IS NOT NULL), false) AS bad_delay
FROM t
"""


@register("lenient_coercion", _LENIENT_SQL)
def q_lenient_coercion(spark, sf_dir):
    """Text -> FLOAT/INT: blank or missing -> 0, padded text trimmed, '17.0' is not an int."""
    li = read_table(spark, sf_dir, "lineitem")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    dec = F.col("l_extendedprice").cast("decimal(15,2)").cast("string")
    t = li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"),
                 F.lit("_L1")).alias("Invoice_ID"),
        F.when((ls == "O") & (rf == "N"), F.lit("")).when(rf == "A", F.concat(F.lit(" "), dec, F.lit(" ")))
         .otherwise(dec).alias("amount_text"),
        F.when(rf == "N", F.lit(None).cast("string"))
         .when((rf == "A") & (ls == "F"), F.col("l_quantity").cast("string"))
         .otherwise((F.col("l_quantity").cast("int") * 4).cast("string")).alias("delay_text"),
    )
    a, d = F.col("amount_text"), F.col("delay_text")
    return t.select("Invoice_ID", "amount_text", "delay_text",
                    lenient_float(a).alias("Invoice_Amount"), lenient_int(d).alias("Pay_Delay"),
                    bad_float(a).alias("bad_amount"), F.coalesce(bad_int(d), F.lit(False)).alias("bad_delay"))


_QUARANTINE_SQL = """
SELECT src_key,
       CASE WHEN err IS NULL THEN Invoice_ID END AS Invoice_ID,
       CASE WHEN err IS NULL THEN cast(amount_text AS FLOAT) END AS Invoice_Amount,
       CASE WHEN err IS NULL THEN Pay_Delay END AS Pay_Delay,
       err AS _error
FROM (
  SELECT concat(cast(l_orderkey AS VARCHAR), '-', cast(l_linenumber AS VARCHAR)) AS src_key,
         concat(cast(l_orderkey AS VARCHAR), '_', cast(l_linenumber AS VARCHAR), '_L1') AS Invoice_ID,
         CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN '0'
              ELSE cast(cast(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) END AS amount_text,
         cast(l_quantity AS INT) * 4 AS Pay_Delay,
         CASE WHEN l_tax = 0 THEN 'malformed json'
              WHEN l_discount > 0.08 THEN 'bad int Pay_Delay' END AS err
  FROM lineitem) q
"""


@register("quarantine", _QUARANTINE_SQL)
def q_quarantine(spark, sf_dir):
    """Malformed payloads (broken JSON, '17.0' as an int) set aside with a reason; good ones decoded.

    The feed is the raw payload of every line item, with two defects planted
    from the data: lines with zero tax carry broken JSON syntax, lines with
    a discount above 8% carry their quantity text ('17.0') as the delay.
    """
    li = read_table(spark, sf_dir, "lineitem", spread=True)
    src_key = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    feed = defective_payloads(li.withColumn("src_key", src_key), keep=("src_key",)).select("src_key", "value")
    dec = decode_invoice(feed, keep=("src_key",))
    ok = F.col("_error").isNull()
    return dec.select("src_key", *[F.when(ok, F.col(c)).alias(c)
                                   for c in ("Invoice_ID", "Invoice_Amount", "Pay_Delay")], "_error")


@register("token_typed_decode", """
SELECT src_key, CASE WHEN err IS NULL THEN CASE WHEN ln >= 7 THEN '{' || activity || '}' ELSE activity END END AS Activity,
       CASE WHEN err IS NULL THEN CAST(amount_text AS FLOAT) END AS Invoice_Amount,
       CASE WHEN err IS NULL THEN CASE ln WHEN 2 THEN -quantity WHEN 4 THEN quantity * 10 + 5 ELSE quantity * 4 END END AS Pay_Delay,
       err AS _error
FROM (
  SELECT concat(cast(l_orderkey AS VARCHAR), '-', cast(l_linenumber AS VARCHAR)) AS src_key, l_linenumber AS ln, CAST(l_quantity AS INTEGER) AS quantity,
         CASE WHEN l_linestatus = 'F' THEN 'Settled' ELSE 'Ordered' END AS activity,
         CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN '0'
              ELSE cast(cast(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) END AS amount_text,
         CASE WHEN l_linenumber IN (3, 5) OR (l_linenumber = 1 AND l_tax = 0) THEN 'bad int Pay_Delay'
              WHEN l_linenumber = 6 THEN 'nested value Activity' END AS err
  FROM lineitem) q
""")
def q_token_typed_decode(spark, sf_dir):
    """The decoder by token type: a bare 12.5 for an INT is cut to 12 while "12.5" in
    quotes, an array or a number out of range is set aside, and an object in a text
    field is set aside while text that looks like one is kept. Planted by line number."""
    li = read_table(spark, sf_dir, "lineitem", spread=True)
    src_key = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    dec = decode_raw(token_payloads(li.withColumn("src_key", src_key), keep=("src_key",)), keep=("src_key",))
    ok = F.col("_error").isNull()
    return dec.select("src_key", *[F.when(ok, F.col(c)).alias(c) for c in ("Activity", "Invoice_Amount", "Pay_Delay")], "_error")


@register("normalise_datetime", """
SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%SZ') AS DateTime,
       date_trunc('minute', ts) AS event_time, false AS _time_error
FROM events""")
def q_normalise_datetime(spark, sf_dir):
    """Sample-file time text (M/d/yy H:mm) -> RFC3339 UTC text and timestamp."""
    from payguard.functions.timefmt import sample_time_text
    ev = read_table(spark, sf_dir, "events")
    return normalise_datetime(ev.select("event_id", sample_time_text(F.col("ts")).alias("DateTime")))


# ---------------------------------------------------------------- envelopes


def _event_id_sql() -> str:
    return "md5(concat_ws('|', Invoice_ID, DateTime, Req_Line_ID))"


@register("event_attributes", O.with_raw(f"""
SELECT {_event_id_sql()} AS key, {_event_id_sql()} AS ce_id, 'urn:payguard:producer' AS ce_source,
       '1.0' AS ce_specversion, 'procure.events.sample' AS ce_type, DateTime AS ce_time,
       'application/json' AS content_type, Invoice_ID, cast(Pay_Delay AS INT) AS Pay_Delay
FROM raw"""))
def q_event_attributes(spark, sf_dir):
    """Binary-mode events built from raw rows, then their header attributes read back."""
    raw = raw_text_adapter(spark, sf_dir)
    events = binary_events(raw, id_col=name_based_id("Invoice_ID", "DateTime", "Req_Line_ID"))
    attrs = binary_attributes(events)
    inv = decode_invoice(attrs, keep=("key", "ce_id", "ce_source", "ce_specversion", "ce_type",
                                      "ce_time", "content_type"))
    return inv.select("key", "ce_id", "ce_source", "ce_specversion", "ce_type", "ce_time",
                      "content_type", "Invoice_ID", "Pay_Delay")


@register("risk_event_encode", O.with_inv(
    "SELECT '1.0' AS specversion, Invoice_ID AS id, 'urn:payguard:producer' AS source, "
    "'procure.risk' AS type, 'application/json' AS datacontenttype, "
    f"{INV_COLS}, {O.RULE_RISK_SQL} AS Risk, {NULL_S} AS Model_Name "
    f"FROM inv WHERE {O.VALID_SQL} AND Pay_Type = 'Late'"))
def q_risk_event_encode(spark, sf_dir):
    """Flagship rows as structured risk events, parsed back by the risk-topic decoder."""
    return parse_structured_events(structured_risk_events(late_invoice_risk(invoice_adapter(spark, sf_dir))))

# ---------------------------------------------------------------- scoring


_MODEL_SQL_COLS = (f"{INV_COLS}, " + O.MODEL_RISK_SQL.format(o=O.ROUND_UP_SQL.format(x=O.LINEAR_SCORE_SQL.format(d="Pay_Delay")))
                   + " AS Risk, 'anomaly-classifier-predictor' AS Model_Name")


@register("risk_model", O.with_inv(
    f"SELECT {_MODEL_SQL_COLS}, {O.ROUND_UP_SQL.format(x=O.LINEAR_SCORE_SQL.format(d='Pay_Delay'))} AS output "
    f"FROM inv WHERE {O.VALID_SQL} AND Pay_Type = 'Late'"))
def q_risk_model(spark, sf_dir):
    """Model grading of valid late invoices with the surrogate score as a column
    expression (no Python): output > 100 High, > 50 Medium, else Low; default model name."""
    inv = late_invoices(valid_invoices(invoice_adapter(spark, sf_dir)))
    graded = grade_by_score(inv.withColumn("score", linear_score(F.col("Pay_Delay"))))
    return graded.select(*INV_COLS.split(", "), "Risk", "Model_Name", "output")


@register("model_scoring_batch", O.with_inv(
    f"SELECT {_MODEL_SQL_COLS} FROM inv WHERE {O.VALID_SQL} AND Pay_Type = 'Late'"))
def q_model_scoring_batch(spark, sf_dir):
    """Flagship on the model path: valid late invoices scored in Arrow batches
    by a scorer session per partition (surrogate linear model)."""
    return late_invoice_risk(invoice_adapter(spark, sf_dir), scorer=LinearScorer())


# The forms in which a model server may write its scores, by delay: an exponent,
# more digits than a decimal holds, tiny, huge, and none.
_FORM = "CAST(Pay_Delay / 4 AS INTEGER) % 6"
_PRED_SCORE = O.LINEAR_SCORE_SQL.format(d="Pay_Delay")
_PRED_WHOLE = "CAST(CAST(Pay_Delay AS DECIMAL(18,2)) * 3 / 4 AS BIGINT)"
_HUGE_OUT = (10**25) % 2**32 - (2**32 if (10**25) % 2**32 >= 2**31 else 0)
_PRED_OUT = f"""CASE WHEN Pay_Type = '' THEN NULL WHEN {_FORM} = 2 THEN {_PRED_WHOLE} + 1 WHEN {_FORM} = 3 THEN 1
  WHEN {_FORM} = 4 THEN {_HUGE_OUT} WHEN {_FORM} = 5 THEN NULL ELSE {O.ROUND_UP_SQL.format(x=_PRED_SCORE)} END"""


@register("predictions_decode", O.with_inv(f"""
SELECT Invoice_ID, Pay_Delay, score, CAST(output AS INTEGER) AS output, CASE WHEN output IS NOT NULL THEN {O.MODEL_RISK_SQL.format(o="output")} END AS Risk,
       CASE WHEN output IS NULL THEN 'empty predictions' END AS _error
FROM (SELECT *, {_PRED_OUT} AS output,
        CASE WHEN Pay_Type = '' THEN NULL WHEN {_FORM} = 2 THEN CAST({_PRED_WHOLE} AS DOUBLE) WHEN {_FORM} = 3 THEN 1.2345678e-12
          WHEN {_FORM} = 4 THEN 1e25 WHEN {_FORM} = 5 THEN NULL ELSE CAST({_PRED_SCORE} AS DOUBLE) END AS score FROM inv) q"""))
def q_predictions_decode(spark, sf_dir):
    """Model responses (JSON text) decoded: predictions[0][0] with all its digits
    and any exponent, rounded away from zero, cut to 32 bits and graded; an empty
    or null prediction is an error. Responses come from the surrogate model,
    written in the forms that servers use; it has none for a blank payment type."""
    inv = invoice_adapter(spark, sf_dir)
    score, delay = linear_score(F.col("Pay_Delay")), F.col("Pay_Delay")
    form = (delay / 4).cast("int") % 6
    whole = (delay.cast("decimal(18,2)") * 3 / 4).cast("bigint").cast("string")
    number = (F.when(form == 1, F.concat((score * 100).cast("bigint").cast("string"), F.lit("e-2")))
              .when(form == 2, F.concat(whole, F.lit("." + "0" * 24 + "1"))).when(form == 3, F.lit("1.2345678E-12"))
              .when(form == 4, F.lit("1e+25")).when(form == 5, F.lit("null")).otherwise(score.cast("string")))
    resp = F.when(F.col("Pay_Type") == "", F.lit('{"predictions":[]}')).otherwise(
        F.concat(F.lit('{"predictions":[['), number, F.lit("]]}")))
    got = inv.withColumn("text", decode_predictions(resp)).withColumn("output", round_up_text(F.col("text")))
    out = F.col("output")
    return got.select("Invoice_ID", "Pay_Delay", F.col("text").cast("double").alias("score"), "output",
                      model_risk(out).alias("Risk"), F.when(out.isNull(), F.lit("empty predictions")).alias("_error"))


_ROUND_X = "CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(0.01 AS DECIMAL(3,2)) - 250"


@register("round_up", f"""
SELECT concat(cast(l_orderkey AS VARCHAR), '_', cast(l_linenumber AS VARCHAR), '_L1') AS Invoice_ID,
       CAST({_ROUND_X} AS DOUBLE) AS x, {O.ROUND_UP_SQL.format(x=_ROUND_X)} AS output
FROM lineitem""")
def q_round_up(spark, sf_dir):
    """Round away from zero on exact decimals (50.0001 -> 51, -0.2 -> -1)."""
    li = read_table(spark, sf_dir, "lineitem")
    x = F.col("l_extendedprice").cast("decimal(15,2)") * F.lit("0.01").cast("decimal(3,2)") - F.lit(250)
    return li.select(F.concat(F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"),
                              F.lit("_L1")).alias("Invoice_ID"),
                     x.cast("double").alias("x"), round_up(x).alias("output"))


def _tensor_out_sql(v: str) -> str:
    return O.ROUND_UP_SQL.format(x=O.LINEAR_SCORE_SQL.format(d=v))


_SWEEP_V = "CAST(l_partkey % 500 + 1 AS INTEGER)"
_BYTE_SQL = "CASE WHEN ({o}) % 256 > 127 THEN ({o}) % 256 - 256 ELSE ({o}) % 256 END"


@register("raw_tensor_risk", f"""
SELECT l_orderkey, l_linenumber, {_SWEEP_V} AS Value,
       {_BYTE_SQL.format(o=_tensor_out_sql(_SWEEP_V))} AS out,
       {O.MODEL_RISK_SQL.format(o=_BYTE_SQL.format(o=_tensor_out_sql(_SWEEP_V)))} AS Risk
FROM lineitem""")
def q_raw_tensor_risk(spark, sf_dir):
    """Binary model output (INT64 tensor, little-endian): first byte read as a
    signed int8, so outputs above 127 wrap negative and grade Low."""
    li = read_table(spark, sf_dir, "lineitem")
    v = (F.col("l_partkey") % 500 + 1).cast("int")
    tensor = int64_le_bytes(round_up(linear_score(v)))
    b = signed_first_byte(tensor)
    return li.select("l_orderkey", "l_linenumber", v.alias("Value"), b.alias("out"), model_risk(b).alias("Risk"))


@register("score_sweep", f"""
SELECT DISTINCT {_SWEEP_V} AS Value,
       {O.MODEL_RISK_SQL.format(o=_BYTE_SQL.format(o=_tensor_out_sql(_SWEEP_V)))} AS Risk
FROM lineitem""")
def q_score_sweep(spark, sf_dir):
    """Model audit: every distinct input value scored once, emitted as (Value, Risk).
    Inputs are part keys folded into 1..500; distinct is a partial (map-side)
    aggregate, so only distinct values cross the shuffle."""
    li = read_table(spark, sf_dir, "lineitem")
    vals = li.select((F.col("l_partkey") % 500 + 1).cast("int").alias("Value")).distinct()
    b = signed_first_byte(int64_le_bytes(round_up(linear_score(F.col("Value")))))
    return vals.select("Value", model_risk(b).alias("Risk"))

# ---------------------------------------------------------------- stream job, sinks, readback


_FLAG_COUNT = f"(SELECT count(*) FROM ({FLAGSHIP_SQL}) f)"
_RAW_TYPED_SQL = O.with_raw(f"SELECT {O.RAW_TYPED_COLS} FROM raw")


def _sink_rows(spark, run) -> DataFrame:
    """Every row of the four sinks as (sink, row): its columns as JSON text."""
    def rows(name, df):
        return df.select(F.lit(name).alias("sink"), F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns])).alias("row"))
    events = parse_structured_events(run.events.read(spark)).select(*INV_COLS.split(", "), "Risk")
    return (rows("raw_index", read_raw(spark, run.sinks).select("Invoice_ID", "DateTime", "Pay_Type", "Pay_Delay", "Order_Vendor"))
            .unionByName(rows("anomaly_index", read_anomaly(spark, run.sinks).select("Invoice_ID", "Invoice_Due_Date", "Pay_Type", "Pay_Delay", "Risk")))
            .unionByName(rows("risk_topic", events.select("Invoice_ID", "Invoice_Due_Date", "Pay_Type", "Pay_Delay", "Risk")))
            .unionByName(rows("quarantine", read_quarantine(spark, run.sinks).select("topic", "partition", "offset", "payload", "reason"))))


def _row_sql(cols: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols.split(", ")) + "))"


_RISK_ROW = _row_sql("Invoice_ID, Invoice_Due_Date, Pay_Type, Pay_Delay, Risk")
_SINKS_SQL = f"""
SELECT 'raw_index' AS sink, {_row_sql("Invoice_ID, DateTime, Pay_Type, Pay_Delay, Order_Vendor")} AS row FROM ({_RAW_TYPED_SQL}) r
UNION ALL SELECT 'anomaly_index', {_RISK_ROW} FROM ({FLAGSHIP_SQL}) f
UNION ALL SELECT 'risk_topic', {_RISK_ROW} FROM ({FLAGSHIP_SQL}) f"""


@register("fanout", f"""
SELECT sink, count(*) AS total, count(DISTINCT row) AS different, min(row) AS first_row, max(row) AS last_row
FROM ({_SINKS_SQL}) s GROUP BY sink
UNION ALL SELECT 'quarantine', 0, 0, NULL, NULL""")
def q_fanout(spark, sf_dir):
    """One read of the raw topic fanned out to raw index, anomaly index, risk
    events and quarantine by the stream job; per sink its rows, different rows,
    and the first and last of their hashes."""
    counts = _sink_rows(spark, run_scenario(spark, sf_dir)).groupBy("sink").agg(
        F.count(F.lit(1)).alias("total"), F.countDistinct("row").alias("different"), F.min("row").alias("first_row"), F.max("row").alias("last_row"))
    names = spark.createDataFrame([("raw_index",), ("anomaly_index",), ("risk_topic",), ("quarantine",)], "sink STRING")
    return names.join(counts, "sink", "left").select("sink", F.coalesce("total", F.lit(0)).alias("total"),
                                                     F.coalesce("different", F.lit(0)).alias("different"), "first_row", "last_row")


@register("raw_index_docs", _RAW_TYPED_SQL)
def q_raw_index_docs(spark, sf_dir):
    """Raw index documents written by the stream job: all 35 fields, every event once."""
    return read_raw(spark, run_scenario(spark, sf_dir).sinks)


@register("anomaly_index_docs", FLAGSHIP_SQL)
def q_anomaly_index_docs(spark, sf_dir):
    """Anomaly index documents written by the stream job (7 fields)."""
    return read_anomaly(spark, run_scenario(spark, sf_dir).sinks)


@register("stream_raw", _RAW_TYPED_SQL)
def q_stream_raw(spark, sf_dir):
    """Raw topic read as a stream from the earliest record, decoded to 35 typed
    columns, written by the file sink and read back."""
    run = scenario.new_run(spark, "stream_raw")
    scenario.append(scenario.raw_records(read_table(spark, sf_dir, "lineitem", spread=True), RunSettings()), run)
    out = scratch_dir(spark, "stream_raw_out")
    decoded = decode_raw(stream_records(spark, run.topic))
    q = (decoded.where(F.col(ERROR_COL).isNull()).drop(ERROR_COL).writeStream.format("parquet").options(**WIDE)
         .option("path", f"{out}/data").option("checkpointLocation", f"{out}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{out}/data")


@register("stream_risk", FLAGSHIP_SQL)
def q_stream_risk(spark, sf_dir):
    """The flagship transforms on a streaming frame: the line-item file as a
    stream, graded by the same code as the batch query."""
    li_schema = read_table(spark, sf_dir, "lineitem").schema
    out = scratch_dir(spark, "stream_risk")
    src = (spark.readStream.schema(li_schema).option("pathGlobFilter", "lineitem.parquet")
           .parquet(sf_dir.rstrip("/")))
    q = (late_invoice_risk(invoice_view(src)).writeStream.format("parquet")
         .option("path", f"{out}/data").option("checkpointLocation", f"{out}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{out}/data")


@register("stream_restart", FLAGSHIP_SQL)
def q_stream_restart(spark, sf_dir):
    """Exactly-once across restarts and retries: two waves with a restart in
    between, one more restart with nothing new, and the last batch written a
    second time as a failed-and-retried batch would. Every risk event once."""
    run = run_scenario(spark, sf_dir, reuse=False)
    run.drain(spark)
    name = active_run(spark, run.sinks)
    last = tables.read_index(spark, run.sinks.raw, RAW_SCHEMA).agg(F.max("batch_id")).first()[0]
    second = scenario.raw_records(scenario.waves(read_table(spark, sf_dir, "lineitem", spread=True))[1], RunSettings())
    second = materialise(second, "again", **WIDE)  # a batch is read more than once
    process_batch(second, int(last), run.sinks, RunSettings(), run.events, name)
    return read_anomaly(spark, run.sinks)


@register("stream_replay_restart", _SINKS_SQL)
def q_stream_replay_restart(spark, sf_dir):
    """A replay from the first record with other batch bounds, then records that
    come in later and a plain start: every row of every sink once, whatever the
    runs before it left. Rows of all sinks, as hashes of their columns."""
    run = scenario.new_run(spark, "replay_restart")
    first, second = scenario.waves(read_table(spark, sf_dir, "lineitem", spread=True))
    scenario.append(scenario.raw_records(first, RunSettings()), run)
    run.drain(spark)
    run.drain(spark, max_files=3, replay=True)
    scenario.append(scenario.raw_records(second, RunSettings()), run)
    run.drain(spark, max_files=5)
    return _sink_rows(spark, run)


@register("stream_retry_empty", O.with_inv(f"""
SELECT 'anomaly_index' AS sink, 0 AS total UNION ALL SELECT 'risk_topic', 0 UNION ALL SELECT 'raw_index', (SELECT count(*) FROM lineitem)
UNION ALL SELECT 'quarantine', (SELECT count(*) FROM inv WHERE {O.VALID_SQL} AND Pay_Type = 'Late')"""))
def q_stream_retry_empty(spark, sf_dir):
    """A batch that runs again and grades nothing the second time (the model
    answers with empty predictions) leaves nothing of its first attempt: all late
    invoices are in quarantine, none in the anomaly index or the risk events."""
    run = scenario.new_run(spark, "retry_empty")
    records = scenario.raw_records(read_table(spark, sf_dir, "lineitem", spread=True), RunSettings())
    for scorer in (LinearScorer(), EmptyScorer()):
        process_batch(records, 0, run.sinks, RunSettings(), run.events, "run-0", scorer)
    counts = _sink_rows(spark, run).groupBy("sink").agg(F.count(F.lit(1)).alias("n"))
    names = spark.createDataFrame([("raw_index",), ("anomaly_index",), ("risk_topic",), ("quarantine",)], "sink STRING")
    return names.join(counts, "sink", "left").select("sink", F.coalesce("n", F.lit(0)).alias("total"))


@register("stream_redelivered", _SINKS_SQL)
def q_stream_redelivered(spark, sf_dir):
    """Records that come more than once: a third of all line items is delivered again, in the same
    batch, in later ones and after a restart. Every sink has each once, also line items that are equal
    in all columns, because a record is known by its place in the topic. Rows of all sinks, as hashes."""
    from payguard.operators.replay import dense_index
    run = scenario.new_run(spark, "redelivered")
    settings = RunSettings(dedupe_within="30 days")
    lines = dense_index(read_table(spark, sf_dir, "lineitem", spread=True), None, index_col="_seq", total_col=None)
    records = [scenario.raw_records(wave, settings, offset=F.col("_seq")) for wave in scenario.waves(lines)]
    again = [r.where(F.pmod("offset", F.lit(3)) == 0) for r in records]
    scenario.append(records[0].unionByName(again[0]), run)
    scenario.append(again[0], run)
    run.drain(spark, max_files=5, settings=settings)
    scenario.append(records[1].unionByName(again[0]), run)
    scenario.append(again[1], run)
    run.drain(spark, max_files=7, settings=settings)
    run.drain(spark, settings=settings)
    return _sink_rows(spark, run)


_UNDATED, _FUTURE = "l_orderkey % 50 = 9", "l_orderkey % 50 = 7"


@register("stream_upkeep", f"""
WITH lineitem AS (SELECT * FROM main.lineitem WHERE l_linenumber >= 3 OR {_UNDATED} OR {_FUTURE})
SELECT * FROM ({_SINKS_SQL}) every""")
def q_stream_upkeep(spark, sf_dir):
    """Upkeep between batches that also write to older days: a compaction that is cut after its copy is
    made, a batch that Spark runs again, compaction up to the committed batches, and seven days'
    retention on the clock of 11 January. Records with a time in the year 2100 drop nothing, records without
    a time stay. Rows of all sinks, as hashes: every line of the days that are kept, once."""
    import datetime as dt

    from payguard.schemas import INVOICE_SCHEMA as INV
    from payguard.streaming.fanout import EVENT_SCHEMA
    settings = RunSettings()
    run = scenario.new_run(spark, "upkeep")
    time = F.when(F.expr(_UNDATED), F.lit(None)).when(F.expr(_FUTURE), F.lit("2100-01-01").cast("date")).otherwise(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("l_linenumber").cast("int")))
    waves = [scenario.raw_records(w, settings, time=time) for w in scenario.waves(read_table(spark, sf_dir, "lineitem", spread=True))]
    stored = ((run.sinks.raw, RAW_SCHEMA), (run.sinks.anomaly, INV), (run.events.path, EVENT_SCHEMA))
    scenario.append(waves[0], run)
    run.drain(spark, max_files=3)
    name = active_run(spark, run.sinks)
    done = tables.committed(spark, run.sinks.checkpoint(name))
    for path, schema in stored:
        for day in (dt.date(2024, 1, 4), dt.date(2024, 1, 5)):
            tables.stage_day(spark, path, schema, day, name, upto=done)  # cut here
        tables.compact_day(spark, path, schema, dt.date(2024, 1, 6), name, upto=done)
    scenario.append(waves[1], run)
    run.drain(spark, max_files=1000)
    process_batch(waves[1], done + 1, run.sinks, settings, run.events, name)  # Spark runs it again
    for path, schema in stored:
        for day in sorted(tables.days_of(spark, path)):
            tables.compact_day(spark, path, schema, day, name, upto=done)
        tables.drop_old_days(spark, path, 7, dt.date(2024, 1, 11))
    return _sink_rows(spark, run)


_MARK = "TIMESTAMP '2024-01-15 00:00:00'"
_PART_SQL = "user_id % 4"


@register("forward_new", f"""
WITH marks AS (SELECT {_PART_SQL} AS partition, max(event_id) + 1 AS next_offset FROM events WHERE ts < {_MARK} GROUP BY 1)
SELECT 'partition:' || ({_PART_SQL}) || '/offset:' || event_id AS ce_id, 'partition:' || ({_PART_SQL}) || '#' || event_id AS ce_subject,
       '/apis/v1/sources/subscriber#procure-risk' AS ce_source, 'dev.knative.kafka.event' AS ce_type, '1.0' AS ce_specversion,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ce_time, event_type || ' ' || event_id AS data
FROM events LEFT JOIN marks ON marks.partition = {_PART_SQL} WHERE event_id >= coalesce(next_offset, 0)""")
def q_forward_new(spark, sf_dir):
    """A subscriber sees only records past the offsets at which it subscribed, each
    with delivery attributes. The topic is the ``events`` table: a user's events
    are in one partition, the event id is the offset, and the subscription
    started on 15 January."""
    from payguard.config import RunSettings as S
    ev = read_table(spark, sf_dir, "events")
    body = ev.withColumn("key", F.lit(None)).withColumn("value", F.concat_ws(" ", "event_type", F.col("event_id").cast("string")))
    topic = as_records(body, S.risk_topic, F.pmod("user_id", F.lit(4)), F.col("event_id"), F.col("ts"))
    marks = next_offsets(topic.where(F.col("timestamp") < F.lit("2024-01-15 00:00:00").cast("timestamp")))
    got = delivery_attributes(new_records(topic, marks))
    return got.select("ce_id", "ce_subject", "ce_source", "ce_type", "ce_specversion",
                      F.date_format("ce_time", "yyyy-MM-dd HH:mm:ss").alias("ce_time"), "data")


@register("forward_resume", """
SELECT 'partition:' || (l_orderkey % 4) || '/offset:' || (1000000000000 + l_orderkey * 10 + l_linenumber) AS ce_id,
       '/apis/v1/sources/subscriber#procure-raw' AS ce_source, count(*) AS delivered
FROM lineitem WHERE l_linestatus <> 'F' GROUP BY ALL""")
def q_forward_resume(spark, sf_dir):
    """A named subscription that is stopped and taken up again: it begins after the closed lines, sees
    nothing of them, and gets what came while it was down when it starts again, each record once."""
    from payguard.streaming.forward import Subscription, forward_stream
    run = scenario.new_run(spark, "forward_resume")
    closed, open_ = scenario.waves(read_table(spark, sf_dir, "lineitem", spread=True))
    out = f"{scratch_dir(spark, 'forwarded')}/events"
    place = scratch_dir(spark, "subscriptions")

    def start():
        subscription = Subscription(f"{place}/group-a")
        marks = subscription.marks(spark.read.parquet(run.topic))
        forward_stream(stream_records(spark, run.topic), lambda batch, n: tables.write_batch(
            batch.withColumn("day", F.to_date("ce_time")), out, "forwarded", n), subscription.checkpoint, marks).awaitTermination()

    scenario.append(scenario.raw_records(closed, RunSettings()), run)
    start()
    for half in (0, 1):  # what comes while the subscription is down, twice
        later = F.lit(10 ** 12) + F.col("l_orderkey") * 10 + F.col("l_linenumber")
        scenario.append(scenario.raw_records(open_.where(F.floor(F.pmod("l_orderkey", F.lit(8)) / 4) == half), RunSettings(), offset=later), run)
        start()
    return spark.read.parquet(out).groupBy("ce_id", "ce_source").agg(F.count(F.lit(1)).alias("delivered"))


_BULK = {"rows": 300, "size": 40_000, "lane_offsets": 100_000}
_BULK_OFFSET = "l_orderkey * 10 + l_linenumber"
_BULK_DOC = ("concat('{\"order\":', l_orderkey, ',\"line\":', l_linenumber, ',\"flag\":\"', coalesce(l_returnflag, ''), "
             "'\",\"note\":\"', CASE WHEN l_orderkey % 4 = 0 THEN repeat('n', CAST(l_linenumber * 20 AS INTEGER)) ELSE '' END, '\"}')")


@register("bulk_requests", f"""
WITH RECURSIVE docs AS (SELECT l_orderkey % 4 AS p, {_BULK_OFFSET} AS place, {_BULK_DOC} AS doc FROM lineitem),
parts AS (SELECT 'procure-raw-' || p || '-' || CAST(place // {_BULK["lane_offsets"]} AS BIGINT) AS lane, place,
                 'procure-raw-' || p || '-' || place AS id, doc FROM docs),
sized AS (SELECT *, octet_length(encode('{{"index": {{"_index": "procure_raw", "_id": "' || id || '"}}}}' || doc)) + 2 AS size FROM parts),
lined AS MATERIALIZED (SELECT lane, id, size, row_number() OVER w AS i, sum(size) OVER (w ROWS UNBOUNDED PRECEDING) AS upto
          FROM sized WINDOW w AS (PARTITION BY lane ORDER BY place, id, doc)),
nexts AS MATERIALIZED (SELECT a.lane, a.i, least(a.i + {_BULK["rows"]}, coalesce(b.i, a.i + {_BULK["rows"]})) AS next_i
          FROM lined a ASOF LEFT JOIN lined b ON a.lane = b.lane AND a.upto - a.size + {_BULK["size"]} < b.upto),
counts AS MATERIALIZED (SELECT lane, count(*) AS n FROM lined GROUP BY lane),
starts AS (SELECT lane, CAST(1 AS BIGINT) AS i, CAST(0 AS BIGINT) AS request FROM counts
           UNION ALL SELECT s.lane, n.next_i, s.request + 1 FROM starts s JOIN nexts n ON n.lane = s.lane AND n.i = s.i
                     JOIN counts c ON c.lane = s.lane WHERE n.next_i <= c.n)
SELECT l.id, l.lane, s.request, count(*) OVER g AS rows, CAST(sum(l.size) OVER g AS BIGINT) AS bytes, 'sent' AS outcome, CAST(1 AS BIGINT) AS stored
FROM lined l ASOF JOIN starts s ON l.lane = s.lane AND l.i >= s.i WINDOW g AS (PARTITION BY l.lane, s.request)""")
def q_bulk_requests(spark, sf_dir):
    """Index writes in bounded bulk requests: for each line item its request's number in its lane, the request's documents and
    bytes, and how often the index got that request. The index goes down after two requests of a lane; the batch fails, runs
    again when the index is back, and sends only what isn't there yet. A third run of the done batch sends nothing."""
    from payguard.session import free
    from payguard.sources.bulk import BulkIndex, FolderIndex, Limits
    place, got = scratch_dir(spark, "bulk_receipts"), scratch_dir(spark, "bulk_index")
    down = f"{got}/_down"
    tables.write_text(spark, down, "")
    index = BulkIndex("http://index/_bulk", place, Limits(_BULK["rows"], _BULK["size"], None), lambda *_: FolderIndex(got, 2), 0.0, _BULK["lane_offsets"])
    lines = read_table(spark, sf_dir, "lineitem", spread=True)
    docs = lines.select(F.lit("procure-raw").alias("topic"), F.expr("CAST(l_orderkey % 4 AS INT) AS partition"),
                        F.expr(f"{_BULK_OFFSET} AS offset"), F.expr(f"{_BULK_DOC} AS doc"))
    for turn in range(3):
        try:
            index.write(docs, "procure_raw", "run-0", 0, F.col("doc"))
        except Exception as e:  # the failed task's error reaches the driver in Spark's own classes
            if turn or "ModelError" not in str(e):
                raise
            free(spark, down)
    seen = (spark.read.format("binaryFile").option("pathGlobFilter", "*.ndjson").load(got).select(
        F.regexp_extract("path", r"([^/]+)~[0-9a-f]+\.ndjson$", 1).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("stored")))
    out = index.outcomes(spark, "run-0", "procure_raw").withColumn("name", F.concat_ws("~", "lane", "request"))
    return out.join(seen, "name", "left").select("id", "lane", "request", "rows", "bytes", "outcome", F.coalesce("stored", F.lit(0)).cast("bigint").alias("stored"))


@register("retention_prune", """
SELECT * FROM events WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) FROM events) - INTERVAL 7 DAY""")
def q_retention_prune(spark, sf_dir):
    """Retention on a dated table: the events are stored by day, whole days more
    than seven days before the newest are dropped, and the rest is read back."""
    ev = read_table(spark, sf_dir, "events")
    path = f"{scratch_dir(spark, 'retention')}/events"
    tables.write_batch(ev.withColumn("day", F.to_date("ts")), path, "run-0", 0)
    tables.drop_old_days(spark, path, keep_days=7)
    return tables.read_index(spark, path, ev.schema).select(*ev.columns)


@register("retention_window", "SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def q_retention_window(spark, sf_dir):
    """Retention to the millisecond: events no older than 7 days before the newest."""
    return retention_window(read_table(spark, sf_dir, "events"), "ts")


@register("retention_exact", "SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def q_retention_exact(spark, sf_dir):
    """Retention to the millisecond on a stored table: the events are stored by day in three batches, the day that the
    limit cuts is compacted in part, then whole days go by name and that one day is rewritten; a second call and one that
    was cut after its copy was made change nothing more."""
    import datetime as dt
    ev = read_table(spark, sf_dir, "events")
    path = f"{scratch_dir(spark, 'retention_exact')}/events"
    for n in range(3):
        tables.write_batch(ev.where(F.pmod("event_id", F.lit(3)) == n).withColumn("day", F.to_date("ts")).repartition("day"), path, "run-0", n)
    newest = ev.select(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    if newest is None:
        return ev
    limit = dt.datetime.fromisoformat(newest) - dt.timedelta(days=7)
    tables.compact_day(spark, path, ev.schema, limit.date(), "run-0", upto=1)
    tables.drop_older(spark, path, ev.schema, limit - dt.timedelta(hours=1), "run-0", "ts")
    since = F.lit(limit.isoformat(sep=" ")).cast(ev.schema["ts"].dataType)
    tables.stage_day(spark, path, ev.schema, limit.date(), "run-0", where=F.col("ts") >= since)  # cut here
    for _ in range(2):
        tables.drop_older(spark, path, ev.schema, limit, "run-0", "ts")
    return tables.read_index(spark, path, ev.schema).select(*ev.columns)


@register("replay_repeat", O.with_inv(f"SELECT {INV_COLS}, CAST(r.rep AS INTEGER) AS rep FROM inv CROSS JOIN range(3) AS r(rep)"))
def q_replay_repeat(spark, sf_dir):
    """The sample sent three times, each row tagged with its repetition."""
    return repeat(invoice_adapter(spark, sf_dir), 3)


@register("replay_pacing", """
WITH s AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS seq, count(*) OVER () AS n FROM events)
SELECT event_id, CAST(r.rep AS INTEGER) AS rep, seq,
       CAST(1 * (r.rep * (n // 10) + seq // 10) AS BIGINT) AS send_offset_s
FROM s CROSS JOIN range(2) AS r(rep)""")
def q_replay_pacing(spark, sf_dir):
    """Send schedule of the events sample: groups of 10, 1 s pause, 2 passes."""
    ev = read_table(spark, sf_dir, "events").select("event_id")
    return pace(ev, ["event_id"], Pacing.from_text("10", "1", "2"))


@register("replay_steps", """
WITH s AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS seq, count(*) OVER () AS n FROM events)
SELECT event_id, r.rep AS rep, seq, CAST(r.rep * (n // 7) + seq // 7 AS BIGINT) AS step FROM s CROSS JOIN range(2) AS r(rep)""")
def q_replay_steps(spark, sf_dir):
    """The producer's stream, step by step: the events in groups of 7 over 2 passes, on ticks that come in ten
    batches. Each batch reads only its own steps' ranges of the stored sample."""
    from payguard.operators.replay import PacedSample, last_step
    ev = read_table(spark, sf_dir, "events").select("event_id")
    pacing = Pacing.from_text("7", "1", "2")
    paced = PacedSample(ev, ["event_id"], pacing)
    place = scratch_dir(spark, "replay_steps")
    last = last_step(ev.count(), pacing)
    (spark.range(0, last + 1, 1, 10).select(F.col("id").alias("step")).write.parquet(f"{place}/ticks"))
    (spark.readStream.schema("step BIGINT").option("maxFilesPerTrigger", 1).parquet(f"{place}/ticks").writeStream
     .foreachBatch(lambda ticks, n: paced.due(ticks).write.mode("overwrite").parquet(f"{place}/sent/batch_id={n}"))
     .option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema("event_id BIGINT, seq BIGINT, step BIGINT, rep BIGINT").parquet(f"{place}/sent").select("event_id", "rep", "seq", "step")


_CSV_TEXT_SQL = "concat('say \"', Role, '\", ', Activity, chr(10), Plant, chr(92))"


_CSV_SQL = O.with_raw(f"SELECT * REPLACE ({_CSV_TEXT_SQL} AS Activity, '' AS UserType) FROM raw")


def _sample_file(spark, sf_dir) -> str:
    from payguard.functions.timefmt import sample_time_text
    raw = raw_text_adapter(spark, sf_dir)
    raw = raw.withColumn("DateTime", sample_time_text(F.to_timestamp(F.col("DateTime"), "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    raw = raw.withColumn("Activity", F.concat(F.lit('say "'), "Role", F.lit('", '), "Activity", F.lit("\n"), "Plant", F.lit("\\")))
    path = f"{scratch_dir(spark, 'sample_csv')}/sample"
    write_sample_csv(raw.select(*[c for c in reversed(RAW_FIELDS) if c != "UserType"]), path)
    return path


@register("csv_source", _CSV_SQL)
def q_csv_source(spark, sf_dir):
    """Sample CSV with its columns in another order and one missing, bound by
    header name; quotes, commas, line breaks and a trailing backslash in a field;
    event time text normalised to RFC3339."""
    return normalise_datetime(read_sample_csv(spark, _sample_file(spark, sf_dir))).select(*RAW_FIELDS)


@register("csv_large", _CSV_SQL)
def q_csv_large(spark, sf_dir):
    """The same files read in splits: every record holds a line break, and is put together from its
    lines by the parity of the quotes before them, also where a split cuts it."""
    return normalise_datetime(read_large_csv(spark, _sample_file(spark, sf_dir))).select(*RAW_FIELDS)


@register("event_publish", O.with_raw("""
SELECT ce_type, ce_source, ce_specversion, ce_time, content_type, Invoice_ID, true AS id_ok,
       (SELECT count(*) FROM lineitem) AS different_ids
FROM (SELECT 'procure.events.sample' AS ce_type, 'urn:payguard:producer' AS ce_source, '1.0' AS ce_specversion,
       DateTime AS ce_time, 'application/json' AS content_type, Invoice_ID FROM raw) q"""))
def q_event_publish(spark, sf_dir):
    """Producer: each row as a binary-mode event with a random UUID id (written
    once, so retries resend the same id), key = id, time from the row; all ids
    differ."""
    path = f"{scratch_dir(spark, 'publish')}/events"
    binary_events(raw_text_adapter(spark, sf_dir)).write.parquet(path)
    attrs = binary_attributes(spark.read.parquet(path))
    inv = decode_invoice(attrs, keep=("key", "ce_id", "ce_source", "ce_specversion", "ce_type", "ce_time",
                                      "content_type"))
    uuid_re = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    id_ok = (F.col("key") == F.col("ce_id")) & F.col("ce_id").rlike(uuid_re)
    different = attrs.select(F.countDistinct("ce_id")).scalar()
    return inv.select("ce_type", "ce_source", "ce_specversion", "ce_time", "content_type", "Invoice_ID",
                      id_ok.alias("id_ok"), different.alias("different_ids"))


@register("index_count", f"""
SELECT 'procure_raw' AS index_name, (SELECT count(*) FROM lineitem) AS total
UNION ALL SELECT 'procure_risk', {_FLAG_COUNT}""")
def q_index_count(spark, sf_dir):
    """Total documents per index after the stream job."""
    sinks = run_scenario(spark, sf_dir).sinks
    return index_total(read_raw(spark, sinks), sinks.raw_table).unionByName(
        index_total(read_anomaly(spark, sinks), sinks.risk_table))


_SEARCH_ORDER = ["Invoice_ID", "Invoice_Amount", "Pay_Delay", "Invoice_Due_Date", "Risk"]


@register("index_search", f"""
WITH f AS ({FLAGSHIP_SQL.replace("WITH inv AS", "WITH inv2 AS").replace("FROM inv WHERE", "FROM inv2 WHERE")})
SELECT *, (SELECT count(*) FROM f) AS total FROM f ORDER BY {", ".join(_SEARCH_ORDER)} LIMIT 10""")
def q_index_search(spark, sf_dir):
    """Search without a predicate: the index total and its first 10 documents."""
    return search(read_anomaly(spark, run_scenario(spark, sf_dir).sinks), _SEARCH_ORDER, 10)


@register("index_clear", f"SELECT 'procure_risk' AS index_name, {_FLAG_COUNT} AS total")
def q_index_clear(spark, sf_dir):
    """Clear before a new run: load, clear, load again; the index holds one run."""
    path = f"{scratch_dir(spark, 'index_clear')}/procure_risk"
    risk = late_invoice_risk(invoice_adapter(spark, sf_dir))
    risk.write.parquet(path)
    clear_table(spark, path, INVOICE_SCHEMA)
    risk.write.mode("append").parquet(path)
    return index_total(spark.read.parquet(path), "procure_risk")


@register("init_tables", FLAGSHIP_SQL)
def q_init_tables(spark, sf_dir):
    """Index initialisation: the typed, dated tables created if absent under the
    names of the settings (a second init changes nothing), the stream job run
    into them, and the risk rows read back through the catalog by name."""
    import uuid

    from payguard.streaming.fanout import Sinks, create_index_tables, refresh_index_tables
    tag = uuid.uuid4().hex[:10]
    run = scenario.new_run(spark, "init_tables")
    run = scenario.Run(Sinks(run.sinks.root, f"procure_raw_{tag}", f"procure_risk_{tag}", f"quarantine_{tag}"), run.events, run.topic)
    made = create_index_tables(spark, run.sinks)
    again = create_index_tables(spark, run.sinks)
    assert len(made) == 3 and not again
    scenario.append(scenario.raw_records(read_table(spark, sf_dir, "lineitem", spread=True), RunSettings()), run)
    run.drain(spark)
    refresh_index_tables(spark, run.sinks)
    return anomaly_documents(spark.table(run.sinks.risk_table))


@register("stream_quarantine", f"""
SELECT topic, partition, "offset", reason, length(payload) AS payload_size, right(payload, 60) AS payload_end
FROM (SELECT 'procure-raw' AS topic, CAST(l_orderkey % 4 AS INTEGER) AS partition, l_orderkey * 10 + l_linenumber AS "offset",
        CASE WHEN l_tax = 0 THEN 'malformed json' ELSE 'bad int Pay_Delay' END AS reason, {O.DEFECTIVE_PAYLOAD_SQL} AS payload
      FROM ({O.DEFECTIVE_SQL}) r WHERE l_tax = 0 OR l_discount > 0.08) q""")
def q_stream_quarantine(spark, sf_dir):
    """The stream job sets malformed events aside: every line item is published
    with the planted defects, and the quarantine table holds exactly the
    defective records: where they came from, their payload (its size and its
    last 60 characters) and the reason."""
    run = scenario.new_run(spark, "stream_quarantine")
    scenario.append(scenario.raw_records(read_table(spark, sf_dir, "lineitem", spread=True), RunSettings(), defective=True), run)
    run.drain(spark)
    return read_quarantine(spark, run.sinks).select(
        "topic", "partition", "offset", "reason", F.length("payload").cast("bigint").alias("payload_size"), F.right("payload", F.lit(60)).alias("payload_end"))

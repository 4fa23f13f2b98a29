"""Index documents and event envelopes.

* Raw documents: all 35 fields, unfiltered. Anomaly documents: 7 invoice fields.
* Binary-mode events (what the producer publishes): attributes in Kafka
  headers (``ce_*``, ``content-type``), event id as the message key, the JSON
  object as the value.
* Structured-mode events (the risk topic): one JSON object holding the
  attributes and ``data``; null fields are written as ``null`` and a FLOAT
  prints as ``1625.0``, like a bean serialiser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from payguard import config as C
from payguard.functions.envelope import header, make_headers
from payguard.schemas import INVOICE_FIELDS, INVOICE_SCHEMA, RAW_FIELDS


def raw_documents(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*RAW_FIELDS, *keep)


def anomaly_documents(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*INVOICE_FIELDS, *keep)


def json_document(fields: tuple[str, ...]) -> Column:
    """The JSON object of ``fields``, nulls written, as an index takes it."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def name_based_id(*cols: str) -> Column:
    """Deterministic event id from natural-key columns (md5 hex). Use it, or
    materialise random ids once, so a retried write re-sends the same ids."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def binary_events(df: DataFrame, fields: tuple[str, ...] = RAW_FIELDS, id_col: Column | None = None,
                  time_col: str = "DateTime", settings: C.RunSettings | None = None,
                  keep: tuple[str, ...] = (), value_col: str | None = None) -> DataFrame:
    """Text columns -> Kafka-shaped binary-mode events (key, value, headers).

    The value is the JSON object of ``fields``, or the ready-made text in
    ``value_col``. ``id_col`` defaults to a random UUID per row; random ids
    differ on every recomputation, so write the result once before
    publishing it.
    """
    s = settings or C.RunSettings()
    eid = id_col if id_col is not None else F.expr("uuid()")
    body = F.col(value_col) if value_col else F.to_json(F.struct(*fields))
    staged = df.select(*keep, *fields, eid.alias("_id"), body.alias("_body"))
    heads = make_headers({
        "ce_id": F.col("_id"),
        "ce_source": F.lit(s.event_source),
        "ce_specversion": F.lit(C.SPEC_VERSION),
        "ce_type": F.lit(s.raw_event_type),
        "content-type": F.lit(C.JSON_CONTENT_TYPE),
        "ce_time": F.col(time_col),
    })
    return staged.select(*keep, F.col("_id").cast("binary").alias("key"),
                         F.col("_body").cast("binary").alias("value"),
                         heads.alias("headers"))


def binary_attributes(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Kafka record with headers -> attribute columns + payload text."""
    h = F.col("headers")
    return df.select(
        *keep,
        F.col("key").cast("string").alias("key"),
        header(h, "ce_id").alias("ce_id"),
        header(h, "ce_source").alias("ce_source"),
        header(h, "ce_specversion").alias("ce_specversion"),
        header(h, "ce_type").alias("ce_type"),
        header(h, "ce_time").alias("ce_time"),
        header(h, "content-type").alias("content_type"),
        F.col("value").cast("string").alias("value"),
    )


def structured_risk_events(df: DataFrame, settings: C.RunSettings | None = None,
                           keep: tuple[str, ...] = ()) -> DataFrame:
    """Risk invoices -> structured-mode event JSON in ``value`` (key NULL).

    The event id is ``Invoice_ID`` (blank ids are kept; NULL ids belong in
    quarantine before this step).
    """
    s = settings or C.RunSettings()
    event = F.struct(
        F.lit(C.SPEC_VERSION).alias("specversion"),
        F.col("Invoice_ID").alias("id"),
        F.lit(s.event_source).alias("source"),
        F.lit(s.risk_event_type).alias("type"),
        F.lit(C.JSON_CONTENT_TYPE).alias("datacontenttype"),
        F.struct(*[F.col(f) for f in INVOICE_FIELDS]).alias("data"),
    )
    return df.select(*keep, F.lit(None).cast("binary").alias("key"),
                     F.to_json(event, {"ignoreNullFields": "false"}).cast("binary").alias("value"))


STRUCTURED_EVENT_SCHEMA = T.StructType([
    T.StructField("specversion", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("datacontenttype", T.StringType()),
    T.StructField("data", INVOICE_SCHEMA),
])


def parse_structured_events(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Risk-topic value -> attributes + 7 invoice columns (the risk topic's own decoder)."""
    e = F.from_json(F.col("value").cast("string"), STRUCTURED_EVENT_SCHEMA).alias("e")
    return df.select(*keep, e).select(*keep, "e.specversion", "e.id", "e.source", "e.type",
                                      "e.datacontenttype", *[F.col(f"e.data.{f}").alias(f) for f in INVOICE_FIELDS])

"""Event envelopes: structured risk events and binary-mode attributes."""

import json

from pyspark.sql import functions as F

from payguard.config import RunSettings
from payguard.operators.encode import (binary_attributes, binary_events, name_based_id,
                                       parse_structured_events, structured_risk_events)
from payguard.schemas import INVOICE_SCHEMA


def test_structured_event_text(spark):
    df = spark.createDataFrame([("INV-7", 820.5, "6/1/22", "Late", 41, "Low", None)], INVOICE_SCHEMA)
    text = bytes(structured_risk_events(df, RunSettings(event_source="urn:s")).first().value).decode()
    assert text == ('{"specversion":"1.0","id":"INV-7","source":"urn:s","type":"procure.risk",'
                    '"datacontenttype":"application/json","data":{"Invoice_ID":"INV-7",'
                    '"Invoice_Amount":820.5,"Invoice_Due_Date":"6/1/22","Pay_Type":"Late","Pay_Delay":41,'
                    '"Risk":"Low","Model_Name":null}}')
    back = parse_structured_events(structured_risk_events(df)).first()
    assert (back.id, back.Invoice_Amount, back.Risk, back.Model_Name) == ("INV-7", 820.5, "Low", None)


def test_binary_events_attributes(spark):
    df = spark.createDataFrame([("A1", "2019-03-18T12:45:00Z")], "Invoice_ID STRING, DateTime STRING")
    ev = binary_events(df, fields=("Invoice_ID", "DateTime"))
    a = binary_attributes(ev).first()
    assert a.key == a.ce_id and len(a.ce_id) == 36
    assert (a.ce_specversion, a.ce_type, a.ce_time, a.content_type) == \
        ("1.0", "procure.events.sample", "2019-03-18T12:45:00Z", "application/json")
    assert json.loads(a.value) == {"Invoice_ID": "A1", "DateTime": "2019-03-18T12:45:00Z"}


def test_name_based_id_is_stable(spark):
    df = spark.createDataFrame([("A", "t")], "Invoice_ID STRING, DateTime STRING")
    ids = {df.select(name_based_id("Invoice_ID", "DateTime").alias("i")).first().i for _ in range(2)}
    assert len(ids) == 1


def test_missing_header_is_null(spark):
    from payguard.functions.envelope import header
    df = spark.createDataFrame([([],)], "h ARRAY<STRUCT<key:STRING,value:BINARY>>")
    assert df.select(header(F.col("h"), "ce_id").alias("x")).first().x is None

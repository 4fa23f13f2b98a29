"""Schemas of the event data model.

Raw events carry 35 text fields on the wire. After decoding, every field
stays STRING except ``Invoice_Amount`` (FLOAT, 32-bit) and ``Pay_Delay``
(INT). The invoice view keeps five payload fields and adds ``Risk`` and
``Model_Name``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The raw event field names, in wire / CSV header order.
RAW_FIELDS: tuple[str, ...] = (
    "Req_Line_ID", "Order_Line_ID", "Goods_ID", "Invoice_ID", "Activity",
    "DateTime", "Resource", "Role", "Requisition_Vendor", "Order_Vendor",
    "Invoice_Vendor", "Pay_Vendor", "Requisition_Type", "Order_Type",
    "Purchasing_Group", "Purchasing_Organization", "Material_Group",
    "Material_Number", "Plant", "Good_ReferenceNumber", "Requisition_Header",
    "Order_Header", "Invoice_Header", "ClearDoc_Header", "Good_Year",
    "Invoice_Year", "Order_Line_Amount", "Invoice_Amount", "Paid_Amount",
    "Invoice_Document_Date", "Invoice_Due_Date", "Pay_Type", "Pay_Delay",
    "UserType", "Invoice_Is_Overdue",
)

# The invoice field names, in serialisation order.
INVOICE_FIELDS: tuple[str, ...] = (
    "Invoice_ID", "Invoice_Amount", "Invoice_Due_Date", "Pay_Type",
    "Pay_Delay", "Risk", "Model_Name",
)

# Typed (non-text) fields after decoding.
FLOAT_FIELDS = frozenset({"Invoice_Amount"})
INT_FIELDS = frozenset({"Pay_Delay"})

CORRUPT_COL = "_corrupt_record"


def _typed(name: str) -> T.DataType:
    if name in FLOAT_FIELDS:
        return T.FloatType()
    if name in INT_FIELDS:
        return T.IntegerType()
    return T.StringType()


def text_schema(fields: tuple[str, ...], corrupt: bool = False) -> T.StructType:
    """All-STRING parse schema. Numbers on the wire are quoted text, which a
    typed FLOAT/INT parse would turn into NULL; parse as text, cast later."""
    cols = [T.StructField(f, T.StringType(), True) for f in fields]
    if corrupt:
        cols.append(T.StructField(CORRUPT_COL, T.StringType(), True))
    return T.StructType(cols)


RAW_TEXT_SCHEMA = text_schema(RAW_FIELDS)
RAW_SCHEMA = T.StructType([T.StructField(f, _typed(f), True) for f in RAW_FIELDS])
INVOICE_SCHEMA = T.StructType([T.StructField(f, _typed(f), True) for f in INVOICE_FIELDS])

# Kafka-shaped record, as produced by the Kafka source with includeHeaders.
HEADER_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.BinaryType(), True),
]))
TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
    T.StructField("headers", HEADER_SCHEMA, True),
])

# Index (table) column types: keyword -> STRING, float -> FLOAT, integer -> INT.
def table_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)

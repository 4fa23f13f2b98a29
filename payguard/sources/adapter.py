"""Adapter views: procure-to-pay events derived from the ``lineitem`` table.

One line item stands for one invoice line. The mapping is ours (the sample
file the event model comes from is not available) and is mirrored in the
DuckDB oracle (``payguard.plans.oracle``):

* ``Invoice_ID``  = ``<orderkey>_<linenumber>_L1`` (not unique, like the source)
* ``Invoice_Amount`` = extended price, or 0 for open non-returned lines
* ``Pay_Type``    = ``Late`` for returned lines, ``On Time`` for accepted, else blank
* ``Pay_Delay``   = quantity x 4 days
* ``Invoice_Due_Date`` = ship date + 30 days as ``M/d/yy``

The raw view renders all 35 fields as text, as the producer puts them on the
wire; :func:`raw_payloads` wraps them into JSON payloads. Every column is a
projection of the scan, so Catalyst prunes the parquet read to the lineitem
columns used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from payguard.functions.timefmt import RFC3339_FORMAT
from payguard.schemas import RAW_FIELDS
from payguard.sources.tables import read_table

S = "string"


def _s(c: Column) -> Column:
    return c.cast(S)


def _invoice_cols() -> dict[str, Column]:
    ok, ln, rf, ls = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    return {
        "Invoice_ID": F.concat(_s(ok), F.lit("_"), _s(ln), F.lit("_L1")),
        "Invoice_Amount": F.when((ls == "O") & (rf == "N"), F.lit(0.0))
                           .otherwise(F.col("l_extendedprice")).cast("float"),
        "Invoice_Due_Date": F.date_format(F.date_add(F.col("l_shipdate"), 30), "M/d/yy"),
        # Nested null-safe branches: Catalyst folds ``Pay_Type = 'Late'`` into
        # ``l_returnflag <=> 'R'`` and pushes it to the parquet scan.
        "Pay_Type": F.when(rf.eqNullSafe("R"), "Late").otherwise(
            F.when(rf.eqNullSafe("A"), "On Time").otherwise("")),
        "Pay_Delay": F.col("l_quantity").cast("int") * 4,
    }


def invoice_view(lineitem: DataFrame) -> DataFrame:
    """Typed invoice columns (Invoice_ID, Invoice_Amount FLOAT, Invoice_Due_Date,
    Pay_Type, Pay_Delay INT) over a lineitem frame."""
    return lineitem.select(*[c.alias(n) for n, c in _invoice_cols().items()])


def invoice_adapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoice_view(read_table(spark, sf_dir, "lineitem"))


def raw_text_columns() -> dict[str, Column]:
    ok, ln, pk, sk = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    rf, ls, ship = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_shipdate")
    inv = _invoice_cols()
    billed = ls == "F"
    vendor = F.concat(F.lit("SUP"), F.lpad(_s(sk), 5, "0"))
    amount_text = F.when((ls == "O") & (rf == "N"), F.lit("0")).otherwise(
        _s(F.col("l_extendedprice").cast("decimal(15,2)")))
    year = _s(F.year(ship))
    cols = {
        "Req_Line_ID": F.concat(_s(ok), F.lit("_"), _s(ln * 10)),
        "Order_Line_ID": F.concat(F.lit("PO"), _s(ok), F.lit("_"), _s(ln * 10)),
        "Goods_ID": F.concat(_s(pk), F.lit("_"), _s(ln), F.lit("_"), year),
        "Invoice_ID": inv["Invoice_ID"],
        "Activity": F.when(billed, "Settled").otherwise("Ordered"),
        "DateTime": F.date_format(ship, RFC3339_FORMAT),
        "Resource": F.concat(F.lit("DESK"), F.lpad(_s(sk % 100), 2, "0")),
        "Role": F.when(billed, "Ledger").otherwise("Buyer"),
        "Requisition_Vendor": F.lit(""),
        "Order_Vendor": vendor,
        "Invoice_Vendor": F.when(billed, vendor).otherwise(""),
        "Pay_Vendor": F.when(billed, vendor).otherwise(""),
        "Requisition_Type": F.lit("Plain"),
        "Order_Type": F.lit("Usual"),
        "Purchasing_Group": F.concat(F.lit("PG"), _s(sk % 10)),
        "Purchasing_Organization": F.lit("ORG1"),
        "Material_Group": F.concat(F.lit("MAT"), F.lpad(_s(pk % 1000), 3, "0")),
        "Material_Number": _s(pk),
        "Plant": F.lit("SITE1"),
        "Good_ReferenceNumber": F.lit(""),
        "Requisition_Header": _s(ok),
        "Order_Header": F.concat(F.lit("PO"), _s(ok)),
        "Invoice_Header": F.when(billed, _s(ok)).otherwise(""),
        "ClearDoc_Header": F.lit(""),
        "Good_Year": year,
        "Invoice_Year": F.when(billed, year).otherwise(""),
        "Order_Line_Amount": _s(F.col("l_extendedprice").cast("decimal(15,2)")),
        "Invoice_Amount": amount_text,
        "Paid_Amount": F.when(rf == "R", F.lit("0")).otherwise(amount_text),
        "Invoice_Document_Date": F.lit(""),
        "Invoice_Due_Date": inv["Invoice_Due_Date"],
        "Pay_Type": inv["Pay_Type"],
        "Pay_Delay": _s(inv["Pay_Delay"]),
        "UserType": F.lit("PERSON"),
        "Invoice_Is_Overdue": F.when(rf == "R", "yes").otherwise(""),
    }
    assert tuple(cols) == RAW_FIELDS
    return cols


def raw_text_view(lineitem: DataFrame) -> DataFrame:
    """All 35 raw fields as text, in wire order."""
    return lineitem.select(*[c.alias(n) for n, c in raw_text_columns().items()])


def raw_text_adapter(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    return raw_text_view(read_table(spark, sf_dir, "lineitem", spread=spread))


def to_payload(df: DataFrame, fields: tuple[str, ...] = RAW_FIELDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Wrap text columns into a JSON object payload ``value`` (STRING)."""
    return df.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def raw_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_payload(raw_text_adapter(spark, sf_dir))


def defective_payloads(lineitem: DataFrame, keep: tuple = ()) -> DataFrame:
    """Raw payloads with two defects planted from the data, for quarantine
    checks: zero-tax lines carry broken JSON syntax (a stray opening brace;
    the whole payload is kept), lines with a discount above 8% carry their
    quantity text ('17.0') as the delay. Returns ``keep`` + the 35 text
    fields + ``value``."""
    cols = raw_text_columns()
    cols["Pay_Delay"] = (F.when(F.col("l_discount") > 0.08, F.col("l_quantity").cast(S))
                         .otherwise(cols["Pay_Delay"]))
    staged = lineitem.select(*keep, "l_tax", *[c.alias(n) for n, c in cols.items()])
    payload = F.to_json(F.struct(*RAW_FIELDS))
    return staged.select(*keep, *RAW_FIELDS, F.when(F.col("l_tax") == 0, F.concat(F.lit("{"), payload))
                         .otherwise(payload).alias("value"))


def token_payloads(lineitem: DataFrame, keep: tuple = ()) -> DataFrame:
    """Raw payloads whose tokens differ in type from line to line, for checks of the
    decoder's rules: by line number the delay is a bare fraction (2), the same in
    quotes (3), bare with an exponent (4), an array (5), and the activity an object
    (6) or text that looks like one (7). Line 1 has bare amount and delay, and its
    delay is beyond the range of an INT where the tax is zero."""
    ln, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int").cast(S)
    cols = raw_text_columns()
    staged = lineitem.select(*keep, ln.alias("_line"), quantity.alias("_quantity"), F.col("l_tax").alias("_tax"),
                             *[c.alias(n) for n, c in cols.items()])
    # Of its own step: written once, and the branches make a small method, which the JVM compiles.
    staged = staged.select("*", F.to_json(F.struct(*RAW_FIELDS)).alias("_text"))
    text = F.col("_text")
    quoted = lambda field: F.concat(F.lit(f'"{field}":"'), F.col(field), F.lit('"'))
    put = lambda body, field, token: F.replace(body, quoted(field), F.concat(F.lit(f'"{field}":'), token))
    line = F.col("_line")
    bare = put(put(text, "Invoice_Amount", F.col("Invoice_Amount")), "Pay_Delay",
               F.when(F.col("_tax") == 0, F.lit("3000000000")).otherwise(F.col("Pay_Delay")))
    half = F.concat(F.col("_quantity"), F.lit(".5"))
    value = (F.when(line == 1, bare).when(line == 2, put(text, "Pay_Delay", F.concat(F.lit("-"), half)))
             .when(line == 3, put(text, "Pay_Delay", F.concat(F.lit('"'), half, F.lit('"'))))
             .when(line == 4, put(text, "Pay_Delay", F.concat(half, F.lit("e1"))))
             .when(line == 5, put(text, "Pay_Delay", F.concat(F.lit("["), F.col("_quantity"), F.lit("]"))))
             .when(line == 6, put(text, "Activity", F.concat(F.lit('{"name":"'), F.col("Activity"), F.lit('"}'))))
             .otherwise(put(text, "Activity", F.concat(F.lit('"{'), F.col("Activity"), F.lit('}"')))))
    return staged.select(*keep, value.alias("value"))

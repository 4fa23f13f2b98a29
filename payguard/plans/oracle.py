"""DuckDB SQL twins of the adapter views, used by the correctness oracle.

Written independently of the Spark code paths in ``payguard.sources`` and
``payguard.operators``: same meaning, other engine.
"""

from __future__ import annotations

from payguard.schemas import RAW_FIELDS

INVOICE_SQL = """
SELECT concat(cast(l_orderkey AS VARCHAR), '_', cast(l_linenumber AS VARCHAR), '_L1') AS Invoice_ID,
       cast(CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 0 ELSE l_extendedprice END AS FLOAT) AS Invoice_Amount,
       strftime(l_shipdate + INTERVAL 30 DAY, '%-m/%-d/%y') AS Invoice_Due_Date,
       CASE l_returnflag WHEN 'R' THEN 'Late' WHEN 'A' THEN 'On Time' ELSE '' END AS Pay_Type,
       cast(l_quantity AS INT) * 4 AS Pay_Delay
FROM lineitem
"""

_AMOUNT_TEXT = ("CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN '0' "
                "ELSE cast(cast(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) END")
_VENDOR = "concat('SUP', lpad(cast(l_suppkey AS VARCHAR), 5, '0'))"

RAW_TEXT_SQL = f"""
SELECT concat(cast(l_orderkey AS VARCHAR), '_', cast(l_linenumber * 10 AS VARCHAR)) AS Req_Line_ID,
       concat('PO', cast(l_orderkey AS VARCHAR), '_', cast(l_linenumber * 10 AS VARCHAR)) AS Order_Line_ID,
       concat(cast(l_partkey AS VARCHAR), '_', cast(l_linenumber AS VARCHAR), '_', cast(year(l_shipdate) AS VARCHAR)) AS Goods_ID,
       concat(cast(l_orderkey AS VARCHAR), '_', cast(l_linenumber AS VARCHAR), '_L1') AS Invoice_ID,
       CASE WHEN l_linestatus = 'F' THEN 'Settled' ELSE 'Ordered' END AS Activity,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS DateTime,
       concat('DESK', lpad(cast(l_suppkey % 100 AS VARCHAR), 2, '0')) AS Resource,
       CASE WHEN l_linestatus = 'F' THEN 'Ledger' ELSE 'Buyer' END AS Role,
       '' AS Requisition_Vendor,
       {_VENDOR} AS Order_Vendor,
       CASE WHEN l_linestatus = 'F' THEN {_VENDOR} ELSE '' END AS Invoice_Vendor,
       CASE WHEN l_linestatus = 'F' THEN {_VENDOR} ELSE '' END AS Pay_Vendor,
       'Plain' AS Requisition_Type,
       'Usual' AS Order_Type,
       concat('PG', cast(l_suppkey % 10 AS VARCHAR)) AS Purchasing_Group,
       'ORG1' AS Purchasing_Organization,
       concat('MAT', lpad(cast(l_partkey % 1000 AS VARCHAR), 3, '0')) AS Material_Group,
       cast(l_partkey AS VARCHAR) AS Material_Number,
       'SITE1' AS Plant,
       '' AS Good_ReferenceNumber,
       cast(l_orderkey AS VARCHAR) AS Requisition_Header,
       concat('PO', cast(l_orderkey AS VARCHAR)) AS Order_Header,
       CASE WHEN l_linestatus = 'F' THEN cast(l_orderkey AS VARCHAR) ELSE '' END AS Invoice_Header,
       '' AS ClearDoc_Header,
       cast(year(l_shipdate) AS VARCHAR) AS Good_Year,
       CASE WHEN l_linestatus = 'F' THEN cast(year(l_shipdate) AS VARCHAR) ELSE '' END AS Invoice_Year,
       cast(cast(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS Order_Line_Amount,
       {_AMOUNT_TEXT} AS Invoice_Amount,
       CASE WHEN l_returnflag = 'R' THEN '0' ELSE {_AMOUNT_TEXT} END AS Paid_Amount,
       '' AS Invoice_Document_Date,
       strftime(l_shipdate + INTERVAL 30 DAY, '%-m/%-d/%y') AS Invoice_Due_Date,
       CASE l_returnflag WHEN 'R' THEN 'Late' WHEN 'A' THEN 'On Time' ELSE '' END AS Pay_Type,
       cast(cast(l_quantity AS INT) * 4 AS VARCHAR) AS Pay_Delay,
       'PERSON' AS UserType,
       CASE WHEN l_returnflag = 'R' THEN 'yes' ELSE '' END AS Invoice_Is_Overdue
FROM lineitem
"""

# The raw payload of every line item with the planted defects, beside the columns they come from.
DEFECTIVE_SQL = "SELECT l_orderkey, l_linenumber, l_tax, l_discount, l_quantity, " + RAW_TEXT_SQL.strip()[len("SELECT "):]
DEFECTIVE_PAYLOAD_SQL = ("concat(CASE WHEN l_tax = 0 THEN '{' ELSE '' END, '{', " + ", ',', ".join(
    f"""'"{f}":"', """ + ("CASE WHEN l_discount > 0.08 THEN cast(l_quantity AS VARCHAR) ELSE Pay_Delay END" if f == "Pay_Delay" else f) + """, '"'"""
    for f in RAW_FIELDS) + ", '}')")

# Raw text -> typed: only the two numeric fields change type.
RAW_TYPED_COLS = ", ".join(
    "cast(Invoice_Amount AS FLOAT) AS Invoice_Amount" if f == "Invoice_Amount"
    else "cast(Pay_Delay AS INT) AS Pay_Delay" if f == "Pay_Delay"
    else f
    for f in RAW_FIELDS
)

RULE_RISK_SQL = ("CASE WHEN Invoice_Amount <= CAST(5000 AS FLOAT) THEN 'Low' "
                 "WHEN Pay_Delay <= 90 THEN 'Medium' ELSE 'High' END")
MODEL_RISK_SQL = "CASE WHEN {o} > 100 THEN 'High' WHEN {o} > 50 THEN 'Medium' ELSE 'Low' END"
ROUND_UP_SQL = "CAST(CASE WHEN {x} < 0 THEN -ceil(-({x})) ELSE ceil({x}) END AS INTEGER)"
LINEAR_SCORE_SQL = ("CAST(CAST({d} AS DECIMAL(18,2)) * CAST(0.75 AS DECIMAL(18,2)) "
                    "+ CAST(0.1 AS DECIMAL(18,2)) AS DECIMAL(38,18))")
VALID_SQL = "Invoice_Amount > 0 AND NOT isnan(Invoice_Amount)"


def with_inv(body: str) -> str:
    return f"WITH inv AS ({INVOICE_SQL})\n{body}"


def with_raw(body: str) -> str:
    return f"WITH raw AS ({RAW_TEXT_SQL})\n{body}"

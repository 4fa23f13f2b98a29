"""Invoice filters and risk grading (valid, late, rule, model).

All narrow transforms: no shuffle, one codegen stage with the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from payguard import config as C
from payguard.functions.scoring import model_risk, round_up, rule_risk


def valid_invoices(df: DataFrame, amount: str = "Invoice_Amount") -> DataFrame:
    """Keep invoices with a positive amount. NaN is dropped (Spark orders NaN above all)."""
    return df.where(is_valid(F.col(amount)))


def is_valid(amount: Column) -> Column:
    return (amount > 0) & ~F.isnan(amount)


def late_invoices(df: DataFrame, pay_type: str = "Pay_Type") -> DataFrame:
    """Keep invoices whose payment type is exactly ``Late`` (case-sensitive, NULL drops)."""
    return df.where(is_late(F.col(pay_type)))


def is_late(pay_type: Column) -> Column:
    return pay_type == F.lit(C.PAY_TYPE_LATE)


def grade_by_rule(df: DataFrame) -> DataFrame:
    """Set ``Risk`` from amount and delay. ``Model_Name`` passes through untouched."""
    out = df.withColumn("Risk", rule_risk(F.col("Invoice_Amount").cast("float"), F.col("Pay_Delay")))
    if "Model_Name" not in out.columns:
        out = out.withColumn("Model_Name", F.lit(None).cast("string"))
    return out


def grade_by_output(df: DataFrame, output: str = "output", model_name: str | None = None,
                    default_name: str = C.DEFAULT_MODEL_NAME) -> DataFrame:
    """Set ``Risk`` from an integer model output and ``Model_Name`` from the
    response's name, or the default name when the response carries none."""
    name = F.col(model_name) if model_name else F.lit(None).cast("string")
    return (df.withColumn("Risk", model_risk(F.col(output)))
              .withColumn("Model_Name", F.coalesce(name, F.lit(default_name))))


def grade_by_score(df: DataFrame, score: str = "score", **kw) -> DataFrame:
    """Round a DECIMAL score away from zero to ``output``, then grade it."""
    return grade_by_output(df.withColumn("output", round_up(F.col(score))), **kw)


def invoice_columns(df: DataFrame) -> DataFrame:
    """The seven invoice fields in serialisation order."""
    from payguard.schemas import INVOICE_FIELDS
    return df.select(*INVOICE_FIELDS)

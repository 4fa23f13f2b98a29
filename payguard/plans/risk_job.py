"""The flagship job: valid, late invoices graded Low / Medium / High.

decode -> valid -> late -> grade. Rule or model is chosen once, when the
plan is built: a blank predictor URL in the settings means the rule. The
filters come before grading, so only valid late invoices reach a model,
and with the rule the whole chain is one scan-filter-project stage with no
Exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from payguard.config import RunSettings
from payguard.operators.decode import ERROR_COL
from payguard.operators.risk import grade_by_rule, invoice_columns, late_invoices, valid_invoices


def grade_late_invoices(invoices: DataFrame, settings: RunSettings | None = None,
                        scorer=None) -> DataFrame:
    """Valid late invoices with ``Risk``/``Model_Name`` and an ``_error``
    column (set when the model returned no prediction; always NULL on the
    rule path)."""
    settings = settings or RunSettings()
    candidates = late_invoices(valid_invoices(invoices))
    for c in ("Invoice_Due_Date", "Model_Name"):
        if c not in candidates.columns:
            candidates = candidates.withColumn(c, F.lit(None).cast("string"))
    if settings.uses_model or scorer is not None:
        from payguard.operators.score import HttpScorer, score_invoices
        scorer = scorer or HttpScorer(settings.model_predictor_url, ca_data=settings.ca_data())
        return score_invoices(candidates.drop("Model_Name"), scorer, model_name=settings.model_name)
    return grade_by_rule(candidates).withColumn(ERROR_COL, F.lit(None).cast("string"))


def late_invoice_risk(invoices: DataFrame, settings: RunSettings | None = None,
                      scorer=None) -> DataFrame:
    """Typed invoice frame -> the seven-column risk frame.

    A model answer without a prediction fails the job, as a missing result
    did in the original; the stream job instead sets such rows aside
    (:func:`grade_late_invoices` keeps the error column).
    """
    graded = grade_late_invoices(invoices, settings, scorer)
    if scorer is None and (settings is None or not settings.uses_model):
        return invoice_columns(graded)
    guarded = F.when(F.col(ERROR_COL).isNotNull(),
                     F.raise_error(F.concat(F.lit("model scoring failed: "), F.col(ERROR_COL)))
                     .cast("string")).otherwise(F.col("Risk"))
    return invoice_columns(graded.withColumn("Risk", guarded))

"""Decode event payloads into typed rows, with malformed events set aside.

Payloads are JSON objects whose fields are text. Parsing uses an all-STRING
schema (quoted numbers would be NULL under a typed schema), then the two
numeric fields are coerced leniently. A payload is malformed when it is not
a JSON object, a numeric field holds text that is not a number of its type,
or a text field holds an object or an array. Where the parsed text can't tell
(``12.5`` and ``"12.5"``, ``{..}`` and ``"{..}"``) the token's type is asked of
the payload as a Variant; other rows don't pay for it. Three modes:

* ``quarantine`` (default): keep every row, ``_error`` names the problem;
  split with :func:`split_errors`.
* ``strict``: fail the job on the first malformed payload.
* ``lenient``: no check; bad numbers become 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from payguard.functions.coerce import bad_float, bad_token_int, bind, lenient_float, nested_token, open_token, token_int, token_type
from payguard.functions.timefmt import parse_sample_time, rfc3339
from payguard.schemas import (CORRUPT_COL, FLOAT_FIELDS, INT_FIELDS, INVOICE_FIELDS,
                              RAW_FIELDS, text_schema)

ERROR_COL = "_error"
_PARSED = "_parsed"


def _token(f: str) -> Column:
    """The token type of an INT field, asked once a row (:func:`decode`)."""
    return F.col(f"_token_{f}")


def _error_expr(parsed: Column, payload: Column, fields: tuple[str, ...], checked: tuple[str, ...]) -> Column:
    # The plain comparison spares nearly every payload the pattern and the trimming.
    begins = payload.startswith("{")
    checks = [
        (payload.isNull() | (~begins & (F.trim(payload) == "")), "empty payload"),
        (~(begins | payload.rlike(r"^\s*\{")) | parsed[CORRUPT_COL].isNotNull(), "malformed json"),
    ]
    for f in fields:
        if f in FLOAT_FIELDS:
            checks.append((bad_float(parsed[f]), f"bad float {f}"))
        elif f in INT_FIELDS:
            checks.append((bad_token_int(parsed[f], _token(f)), f"bad int {f}"))
    # Nothing is nested in a payload with no opening brace after the first and no bracket.
    inner = payload.contains("[") | F.ltrim(payload, F.lit("{")).contains("{")
    if checked == fields:
        texts = F.struct(*[parsed[f].alias(f) for f in fields if f not in FLOAT_FIELDS and f not in INT_FIELDS])
        whole = F.struct(texts.alias("parsed"), payload.alias("payload"))
    else:  # only here the fields that aren't returned are read
        whole = bind(payload, lambda p: F.struct(F.from_json(p, text_schema(checked)).alias("parsed"), p.alias("payload")))
    nested = bind(whole, lambda x: _nested_expr(x["parsed"], x["payload"], checked))
    expr = F.when(inner, nested)
    for cond, msg in reversed(checks):
        expr = F.when(cond, F.lit(msg)).otherwise(expr)
    return expr


def _nested_expr(parsed: Column, payload: Column, fields: tuple[str, ...]) -> Column:
    """The first text field that holds an object or an array: a branch for each field, out of the stage's own code."""
    expr = F.lit(None).cast("string")
    for f in reversed(fields):
        if f not in FLOAT_FIELDS and f not in INT_FIELDS:
            expr = F.when(nested_token(parsed[f], token_type(payload, f)), F.lit(f"nested value {f}")).otherwise(expr)
    return expr


def _typed(parsed: Column, f: str) -> Column:
    if f in FLOAT_FIELDS:
        return lenient_float(parsed[f]).alias(f)
    if f in INT_FIELDS:
        return token_int(parsed[f], _token(f)).alias(f)
    return parsed[f].alias(f)


def decode(df: DataFrame, fields: tuple[str, ...], value_col: str = "value",
           mode: str = "quarantine", keep: tuple[str, ...] = (), checked: tuple[str, ...] | None = None) -> DataFrame:
    """Decode ``value_col`` (STRING or BINARY JSON) into ``fields``.

    ``keep`` names input columns carried along (e.g. topic, partition, offset). ``checked``
    names all fields whose tokens are checked, in their order, where ``fields`` is only a
    part of them: a payload is then malformed exactly when decoding all of them says so.
    """
    checked = checked or fields
    if [f for f in checked if f in FLOAT_FIELDS | INT_FIELDS] != [f for f in fields if f in FLOAT_FIELDS | INT_FIELDS]:
        raise ValueError("the numeric fields that are checked must be decoded")
    payload = F.col(value_col).cast("string")
    # Carried once through the row, where the caller wants the payload as well.
    text = value_col if value_col in keep and dict(df.dtypes)[value_col] == "string" else "_payload"
    held = [] if text == value_col else [payload.alias(text)]
    parsed = F.from_json(payload, text_schema(fields, corrupt=True),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
    if mode == "strict":
        staged = df.select(*keep, *held, parsed.alias(_PARSED))
        p = F.col(_PARSED)
    else:
        # The optimizer moves a filter on the decoded columns below a projection, with a parse of its own for
        # every field it reads; not below a generator. Here it makes one row of each.
        names = text_schema(fields, corrupt=True).fieldNames()
        staged = df.select(*keep, *held, F.inline(F.array(parsed)).alias(*[f"_in_{f}" for f in names]))
        p = {f: F.col(f"_in_{f}") for f in names}
    tokens = [open_token(p[f], F.col(text), f).alias(f"_token_{f}") for f in fields if f in INT_FIELDS]
    staged = staged.select("*", *tokens)
    cols = [F.col(k) for k in keep] + [_typed(p, f) for f in fields]
    if mode == "lenient":
        return staged.select(*cols)
    err = _error_expr(p, F.col(text), fields, checked)
    if mode == "strict":
        # The guard wraps the parsed struct, so whatever field a later step
        # reads (a filter, a sink column) forces the check; a separate guard
        # column would be pruned away by the optimizer.
        schema = text_schema(fields, corrupt=True)
        guarded = F.when(err.isNotNull(),
                         F.raise_error(F.concat(F.lit("malformed event: "), err)).cast(schema)).otherwise(p)
        g = F.col("_guarded")
        return staged.select(*keep, *[_token(f) for f in fields if f in INT_FIELDS], guarded.alias("_guarded")).select(
            *[F.col(k) for k in keep], *[_typed(g, f) for f in fields])
    if mode != "quarantine":
        raise ValueError(f"unknown mode {mode!r}")
    return staged.select(*cols, err.alias(ERROR_COL))


def decode_raw(df: DataFrame, value_col: str = "value", mode: str = "quarantine",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw event payload -> 35 typed columns (33 STRING, FLOAT amount, INT delay)."""
    return decode(df, RAW_FIELDS, value_col, mode, keep)


def decode_invoice(df: DataFrame, value_col: str = "value", mode: str = "quarantine",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Same payload -> 7 invoice columns; unknown fields are ignored.

    ``Risk`` and ``Model_Name`` are read when present: grading overwrites
    Risk, and the rule path keeps an incoming Model_Name.
    """
    return decode(df, INVOICE_FIELDS, value_col, mode, keep)


def split_errors(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the error column, malformed rows with it)."""
    good = decoded.where(F.col(ERROR_COL).isNull()).drop(ERROR_COL)
    bad = decoded.where(F.col(ERROR_COL).isNotNull())
    return good, bad


def normalise_datetime(df: DataFrame, col: str = "DateTime", strict: bool = False) -> DataFrame:
    """Sample time text -> RFC3339 text in ``col`` plus ``event_time`` TIMESTAMP_NTZ.

    Unparsable text gives NULLs and ``_time_error``; ``strict`` fails the job.
    """
    ts = parse_sample_time(F.col(col))
    bad = F.col(col).isNotNull() & ts.isNull()
    out = df.withColumn("event_time", ts)
    if strict:
        guard = F.when(bad, F.raise_error(F.concat(F.lit("bad event time: "), F.col(col))))
        out = out.withColumn("event_time", F.coalesce(F.col("event_time"), guard.cast("timestamp_ntz")))
    else:
        out = out.withColumn("_time_error", bad)
    return out.withColumn(col, rfc3339(F.col("event_time")))

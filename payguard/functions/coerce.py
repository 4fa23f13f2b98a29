"""Lenient text -> number coercion (the decoder's number rules).

On the wire every field is JSON text, e.g. ``"Invoice_Amount":"1625"``. The
decoder accepts quoted or bare numbers; blank, null or missing becomes 0;
text that is not a number of the field's type is a decode error. A bare JSON
number with a fraction or exponent is a number token, which an INT field
truncates; the same digits in quotes are text and an error. The token's type is
asked of the payload as a Variant, and only where the text leaves it open.
All of it is plain Spark SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Integer text: optional sign and digits only. "12.0" is not an int.
INT_TEXT = r"^[+-]?[0-9]+$"


# White space that may surround a number.
PADDING = " \t\n\r\f"


def _clean(c: Column) -> Column:
    text = F.btrim(c, F.lit(PADDING))
    return F.when(text != "", text)  # nullif would put a step of its own, with all the row's columns, into the plan


def lenient_float(c: Column) -> Column:
    """FLOAT (32-bit) value; blank/null -> 0, unparsable -> 0 (flag with ``bad_float``)."""
    return F.coalesce(_clean(c).try_cast("float"), F.lit(0.0).cast("float"))


def lenient_int(c: Column) -> Column:
    """INT value; blank/null -> 0, non-integer text -> 0 (flag with ``bad_int``)."""
    v = _clean(c)
    return F.coalesce(F.when(v.rlike(INT_TEXT), v.try_cast("int")), F.lit(0))


def bind(value: Column, f) -> Column:
    """``f`` of a value that is worked out once. What ``f`` makes stays out of the stage's generated method:
    the JVM compiles none of more than 8,000 bytes, so seldom used branches go here."""
    return F.element_at(F.transform(F.array(value), f), 1)


def token_type(payload: Column, field: str) -> Column:
    """The JSON type of a field's token (``STRING``, ``BIGINT``, ``DECIMAL(3,1)``, ``DOUBLE``, ``BOOLEAN``,
    ``OBJECT<...>``, ``ARRAY<...>``); NULL where there is no such field or no JSON object."""
    return bind(payload, lambda p: F.schema_of_variant(F.try_variant_get(F.try_parse_json(p), f"$.{field}", "variant")))


def open_token(c: Column, payload: Column, field: str) -> Column:
    """:func:`token_type` where the field's text is present and not an integer, else NULL: only there it matters."""
    v = _clean(c)
    return F.when(v.isNotNull() & ~v.rlike(INT_TEXT), token_type(payload, field))


def _truncated(v: Column, token: Column) -> Column:
    """A bare fractional number cut towards zero; NULL for other tokens and out of range."""
    d = v.try_cast("double")
    return F.when(token.rlike("^(DECIMAL|DOUBLE|FLOAT)") & (d >= -2147483648.0) & (d <= 2147483647.0), d.cast("int"))


def token_int(c: Column, token: Column) -> Column:
    """INT value by token type; blank/null -> 0, anything that is no number of the field -> 0 (flag with ``bad_token_int``).
    ``token`` is used only for text that is present and not an integer."""
    v = _clean(c)
    return F.when(v.isNull(), F.lit(0)).when(v.rlike(INT_TEXT), F.coalesce(v.try_cast("int"), F.lit(0))).otherwise(
        F.coalesce(_truncated(v, token), F.lit(0)))


def bad_token_int(c: Column, token: Column) -> Column:
    """True when the field holds something that is no in-range integer and no bare number either."""
    v = _clean(c)
    return F.when(v.isNull(), F.lit(False)).when(v.rlike(INT_TEXT), v.try_cast("int").isNull()).otherwise(_truncated(v, token).isNull())


def nested_token(c: Column, token: Column) -> Column:
    """True when a text field holds an object or an array instead of text. ``token`` is evaluated only
    for text that begins like one."""
    return F.when(c.startswith("{") | c.startswith("["), F.coalesce(token.rlike("^(OBJECT|ARRAY)"), F.lit(False))).otherwise(F.lit(False))


def bad_float(c: Column) -> Column:
    """True when the text is present but is not a float."""
    v = _clean(c)
    return v.isNotNull() & v.try_cast("float").isNull()


def bad_int(c: Column) -> Column:
    """True when the text is present but is not an in-range integer."""
    v = _clean(c)
    return v.isNotNull() & (~v.rlike(INT_TEXT) | v.try_cast("int").isNull())

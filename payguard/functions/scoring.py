"""Column functions for risk grading and model outputs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from payguard import config as C
from payguard.functions.coerce import bind


def rule_risk(amount: Column, delay: Column) -> Column:
    """amount <= 5000 -> Low; else delay <= 90 -> Medium; else High.

    ``amount`` must already be FLOAT: 5000.0001 is 5000.0 in 32 bits, so Low.
    NaN is above every number in Spark, as ``NaN <= x`` is false in Java.
    """
    # Missing values count as 0, like primitive fields.
    amount = F.coalesce(amount, F.lit(0.0).cast("float"))
    delay = F.coalesce(delay, F.lit(0))
    return (
        F.when(amount <= F.lit(C.RULE_AMOUNT_LIMIT).cast("float"), F.lit(C.RISK_LOW))
        .when(delay <= F.lit(C.RULE_DELAY_LIMIT), F.lit(C.RISK_MEDIUM))
        .otherwise(F.lit(C.RISK_HIGH))
    )


def model_risk(output: Column) -> Column:
    """Low; output > 50 -> Medium; output > 100 -> High. NULL stays NULL."""
    return (
        F.when(output.isNull(), F.lit(None).cast("string"))
        .when(output > C.MODEL_HIGH_ABOVE, F.lit(C.RISK_HIGH))
        .when(output > C.MODEL_MEDIUM_ABOVE, F.lit(C.RISK_MEDIUM))
        .otherwise(F.lit(C.RISK_LOW))
    )


def round_up(x: Column) -> Column:
    """Round away from zero to an INT (50.0001 -> 51, -0.2 -> -1).

    Exact on DECIMAL input: no detour through DOUBLE. Beyond the INT range
    the value wraps to its low 32 bits, as a big decimal's int conversion
    does, instead of failing.
    """
    whole = F.when(x < 0, -F.ceil(-x)).otherwise(F.ceil(x))
    low = F.pmod(whole, F.lit(2**32))
    return F.when(low >= F.lit(2**31), low - F.lit(2**32)).otherwise(low).cast("int")


def signed_first_byte(b: Column) -> Column:
    """First byte of a BINARY value as a signed 8-bit INT (0xFF -> -1)."""
    u = F.conv(F.hex(F.substring(b, 1, 1)), 16, 10).cast("int")
    return F.when(u > 127, u - 256).otherwise(u)


def int64_le_bytes(v: Column) -> Column:
    """8-byte little-endian two's-complement encoding of a BIGINT (an INT64 tensor)."""
    h = F.lpad(F.hex(v.cast("bigint")), 16, "0")
    return F.unhex(F.concat(*[F.substring(h, 15 - 2 * i, 2) for i in range(8)]))


PREDICTION = r'"predictions"\s*:\s*\[\s*\[\s*([-+0-9.eE]+)'


def decode_predictions(resp: Column) -> Column:
    """``predictions[0][0]`` of a model response as the text of the number, NULL if
    it is absent or null. The text is taken as it stands: JSON parsing would put
    the number through a DOUBLE and lose digits that rounding up needs."""
    return F.nullif(F.regexp_extract(resp, PREDICTION, 1), F.lit(""))


NUMBER_TEXT = r"^\s*([+-]?)([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]{1,9}))?\s*$"


def round_up_text(s: Column) -> Column:
    """:func:`round_up` of a number given as text, with all its digits and any
    exponent; NULL if it is no number.

    The decimal point is moved through the digits. Of the whole part the last
    32 digits are enough for the low 32 bits, as 10**32 is a multiple of 2**32.
    """
    def moved(x):
        digits, point = x["digits"], x["point"]
        more = F.least(point - F.length(digits), F.lit(32))
        whole = F.when(point <= 0, F.lit("0")).when(more >= 0, F.concat(F.right(digits, F.lit(32)), F.repeat(F.lit("0"), more))) \
            .otherwise(F.substring(digits, F.lit(1), point))
        rest = F.when(point <= 0, digits).when(more >= 0, F.lit("")).otherwise(F.substring(digits, point + 1, F.length(digits)))
        return F.struct(whole.alias("whole"), rest.alias("rest"), x["sign"].alias("sign"))

    def low(x):
        size = F.right(x["whole"], F.lit(32)).cast("decimal(38,0)") + F.when(x["rest"].rlike("[1-9]"), 1).otherwise(0)
        return F.pmod(F.when(x["sign"] == "-", -size).otherwise(size), F.lit(2**32).cast("decimal(38,0)"))

    part = lambda n: F.regexp_extract(s, NUMBER_TEXT, n)
    point = F.length(part(2)) + F.coalesce(F.nullif(part(4), F.lit("")).cast("int"), F.lit(0))
    start = F.struct(F.concat(part(2), part(3)).alias("digits"), point.alias("point"), part(1).alias("sign"))
    wrap = lambda v: F.when(v >= F.lit(2**31), v - F.lit(2**32)).otherwise(v).cast("int")
    out = bind(bind(bind(start, moved), low), wrap)
    return F.when(s.rlike(NUMBER_TEXT) & s.rlike("[0-9]"), out)


def linear_score(delay: Column, slope: str = "0.75", intercept: str = "0.1") -> Column:
    """Surrogate model score ``delay * slope + intercept`` in exact DECIMAL.

    It stands in for the missing trained model; it proves nothing about it.
    """
    return (delay.cast("decimal(18,2)") * F.lit(slope).cast("decimal(18,2)")
            + F.lit(intercept).cast("decimal(18,2)")).cast("decimal(38,18)")

"""Column functions: rounding, tensor bytes, predictions, event time."""


import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from payguard.functions.scoring import (decode_predictions, int64_le_bytes, model_risk, round_up,
                                        round_up_text, signed_first_byte)
from payguard.operators.decode import normalise_datetime


@pytest.mark.parametrize("score,output,risk", [
    ("50", 50, "Low"), ("50.0001", 51, "Medium"), ("100", 100, "Medium"),
    ("100.5", 101, "High"), ("-0.2", -1, "Low"), ("0", 0, "Low"),
])
def test_round_up_and_model_risk(spark, score, output, risk):
    resp = f'{{"predictions":[[{score}]]}}'
    df = spark.createDataFrame([(resp,)], "r STRING")
    s = decode_predictions(F.col("r"))
    number = F.lit(score).cast("decimal(38,18)")
    r = df.select(s.alias("s"), round_up_text(s).alias("o"), model_risk(round_up_text(s)).alias("k"), round_up(number).alias("d")).first()
    assert r.s == score and (r.o, r.k) == (output, risk) and r.d == output


def test_empty_predictions_is_null(spark):
    df = spark.createDataFrame([('{"predictions":[]}',), ('{"predictions":[[]]}',)], "r STRING")
    assert [r.s for r in df.select(decode_predictions(F.col("r")).alias("s")).collect()] == [None, None]


@pytest.mark.parametrize("b,out,risk", [(b"\x33", 51, "Medium"), (b"\x7f", 127, "High"), (b"\xff", -1, "Low"),
                                        (b"\x80\x01", -128, "Low")])
def test_signed_first_byte(spark, b, out, risk):
    df = spark.createDataFrame([(bytearray(b),)], "b BINARY")
    r = df.select(signed_first_byte(F.col("b")).alias("o")).first()
    assert r.o == out
    assert df.select(model_risk(signed_first_byte(F.col("b"))).alias("k")).first().k == risk


@pytest.mark.parametrize("v", [0, 1, 51, 127, 128, 255, 256, 376, -1, -129, 2**40 + 3])
def test_int64_le_bytes(spark, v):
    r = spark.range(1).select(int64_le_bytes(F.lit(v)).alias("b")).first()
    assert bytes(r.b) == v.to_bytes(8, "little", signed=True)


@pytest.mark.parametrize("text,expected", [
    ("3/18/19 12:45", "2019-03-18T12:45:00Z"),
    ("12/7/18 6:39", "2018-12-07T06:39:00Z"),
    ("12/7/70 6:39", "1970-12-07T06:39:00Z"),
    ("1/2/68 0:00", "2068-01-02T00:00:00Z"),
    ("1/2/69 0:00", "1969-01-02T00:00:00Z"),
    ("2019-03-18 12:45:00", None),
])
def test_normalise_datetime(spark, text, expected):
    df = spark.createDataFrame([(text,)], "DateTime STRING")
    r = normalise_datetime(df).first()
    assert r.DateTime == expected
    assert r._time_error == (expected is None)


def test_normalise_datetime_strict(spark):
    df = spark.createDataFrame([("2019-03-18 12:45:00",)], "DateTime STRING")
    with pytest.raises(PySparkException):
        normalise_datetime(df, strict=True).collect()


@pytest.mark.parametrize("x,expected", [("4294967297.5", 2), ("2147483648", -2147483648), ("-2147483649", 2147483647),
                                        ("2147483647", 2147483647), ("-0.0001", -1)])
def test_round_up_wraps_like_int_conversion(spark, x, expected):
    df = spark.range(1).select(F.lit(x).cast("decimal(38,18)").alias("x"))
    assert df.select(round_up(F.col("x")).alias("o")).first().o == expected


def test_rule_treats_missing_as_zero(spark):
    from payguard.functions.scoring import rule_risk
    df = spark.createDataFrame([(9000.0, None), (None, 200)], "a FLOAT, d INT")
    assert [r.k for r in df.select(rule_risk(F.col("a"), F.col("d")).alias("k")).collect()] == ["Medium", "Low"]

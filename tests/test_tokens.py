import pytest

from payguard.operators.decode import decode_invoice, decode_raw
from payguard.sources.adapter import token_payloads

# (token of Pay_Delay, value, reason)
DELAYS = [("12", 12, None), ('"12"', 12, None), ('" 12 "', 12, None), ('""', 0, None), ("null", 0, None), ("12.5", 12, None), ("-12.5", -12, None), ("-0.9", 0, None),
          ("1e3", 1000, None), ("2147483647", 2147483647, None), ("2147483647.0", 2147483647, None), ('"12.5"', 0, "bad int Pay_Delay"), ('"1e3"', 0, "bad int Pay_Delay"),
          ("2147483648", 0, "bad int Pay_Delay"), ("2147483647.5", 0, "bad int Pay_Delay"), ("3e10", 0, "bad int Pay_Delay"), ("true", 0, "bad int Pay_Delay"),
          ("[12]", 0, "bad int Pay_Delay"), ('{"a": 12}', 0, "bad int Pay_Delay"), ('"{12}"', 0, "bad int Pay_Delay")]
# (token of Invoice_ID, value, reason)
TEXTS = [('"x"', "x", None), ("12", "12", None), ("true", "true", None), ("null", None, None), ('"{\\"a\\":1}"', '{"a":1}', None), ('"[1"', "[1", None),
         ('{"a":1}', '{"a":1}', "nested value Invoice_ID"), ("[1, 2]", "[1,2]", "nested value Invoice_ID"), ("[]", "[]", "nested value Invoice_ID")]


@pytest.mark.parametrize("mode", ["quarantine", "lenient"])
def test_delay_by_token(spark, mode):
    rows = [(i, f'{{"Invoice_ID":"a","Pay_Delay":{t}}}') for i, (t, *_) in enumerate(DELAYS)]
    got = decode_invoice(spark.createDataFrame(rows, "i int, value string"), mode=mode, keep=("i",)).orderBy("i").collect()
    assert [r["Pay_Delay"] for r in got] == [v for _, v, _ in DELAYS]
    if mode == "quarantine":
        assert [r["_error"] for r in got] == [e for *_, e in DELAYS]


def test_text_by_token(spark):
    rows = [(i, f'{{"Invoice_ID":{t},"Pay_Delay":1}}') for i, (t, *_) in enumerate(TEXTS)]
    got = decode_invoice(spark.createDataFrame(rows, "i int, value string"), keep=("i",)).orderBy("i").collect()
    assert [(r["Invoice_ID"], r["_error"]) for r in got] == [(v, e) for _, v, e in TEXTS]


def test_strict_mode_fails_on_a_nested_value(spark):
    df = spark.createDataFrame([('{"Invoice_ID":{"a":1}}',)], "value string")
    with pytest.raises(Exception, match="nested value Invoice_ID"):
        decode_invoice(df, mode="strict").select("Pay_Type").collect()


def test_plan_has_no_python_and_one_parse(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = decode_raw(token_payloads(li))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan

"""Invoice path edge rows: decode -> valid -> late -> rule grade."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from payguard.operators.decode import decode, decode_invoice, decode_raw, split_errors
from payguard.plans.risk_job import late_invoice_risk

MISSING = object()


def payload(amount, pay_type, delay, bare=False):
    d = {"Invoice_ID": "INV-1", "Invoice_Due_Date": "2/28/19"}
    if amount is not MISSING:
        d["Invoice_Amount"] = amount
    if pay_type is not MISSING:
        d["Pay_Type"] = pay_type
    if delay is not MISSING:
        d["Pay_Delay"] = delay
    return json.dumps(d)


# (payload, expected): Low/Medium/High, "drop" or "quarantine"
CASES = [
    (payload("5000", "Late", "91"), "Low"),          # boundary, amount wins
    (payload("5000.0001", "Late", "91"), "Low"),     # float32 rounds to 5000
    (payload("5000.01", "Late", "90"), "Medium"),    # delay boundary
    (payload("9000", "Late", "91"), "High"),
    (payload("Infinity", "Late", "1"), "Medium"),    # not <= 5000
    (payload(9000, "Late", 91), "High"),             # bare numbers accepted
    (payload("0", "Late", "99"), "drop"),
    (payload("-5", "Late", "99"), "drop"),
    (payload("", "Late", "1"), "drop"),              # blank -> 0
    (payload(None, "Late", "1"), "drop"),            # null -> 0
    (payload(MISSING, "Late", "1"), "drop"),         # missing -> 0
    (payload("NaN", "Late", "1"), "drop"),           # NaN is not > 0
    (payload("9000", "late", "91"), "drop"),         # case-sensitive
    (payload("9000", None, "91"), "drop"),           # null-safe
    (payload("9000", "Late", ""), "Medium"),         # delay becomes 0
    (payload(" 9000 ", "Late", " 95 "), "High"),     # padded text trimmed
    (payload("abc", "Late", "1"), "quarantine"),
    (payload("9000", "Late", "12.0"), "quarantine"),  # not an int
    (payload("9000", "Late", "99999999999"), "quarantine"),  # int overflow
    ("{bad", "quarantine"),
    ("[1, 2]", "quarantine"),                        # not an object
    ("", "quarantine"),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_invoice_edge_rows(spark, text, expected):
    df = spark.createDataFrame([(text,)], "value STRING")
    good, bad = split_errors(decode_invoice(df))
    if expected == "quarantine":
        assert bad.count() == 1 and good.count() == 0
        return
    assert bad.count() == 0
    out = late_invoice_risk(good).collect()
    if expected == "drop":
        assert out == []
    else:
        assert [r.Risk for r in out] == [expected]


def test_strict_mode_raises(spark):
    df = spark.createDataFrame([(payload("abc", "Late", "1"),)], "value STRING")
    with pytest.raises(PySparkException):
        decode_invoice(df, mode="strict").collect()


def test_lenient_mode_zeroes(spark):
    df = spark.createDataFrame([(payload("abc", "Late", "x"),)], "value STRING")
    r = decode_invoice(df, mode="lenient").first()
    assert r.Invoice_Amount == 0.0 and r.Pay_Delay == 0


def test_incoming_risk_overwritten_model_name_kept(spark):
    text = json.dumps({"Invoice_ID": "A", "Invoice_Amount": "9000", "Pay_Type": "Late", "Pay_Delay": "95",
                       "Risk": "Low", "Model_Name": "m1"})
    good, _ = split_errors(decode_invoice(spark.createDataFrame([(text,)], "value STRING")))
    r = late_invoice_risk(good).first()
    assert (r.Risk, r.Model_Name) == ("High", "m1")


def test_binary_payload_and_unknown_fields(spark):
    text = json.dumps({"Invoice_Amount": "10", "Pay_Type": "Late", "Pay_Delay": "1", "Extra": {"x": 1}})
    df = spark.createDataFrame([(bytearray(text.encode()),)], "value BINARY")
    r = decode_invoice(df).first()
    assert r.Invoice_Amount == 10.0 and r._error is None and r.Invoice_ID is None


def test_raw_types(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([('{"Invoice_Amount":"731","Pay_Delay":"22","Plant":"SITE9"}',)], "value STRING")
    out = decode_raw(df)
    types = {f.name: f.dataType for f in out.schema.fields}
    assert types["Invoice_Amount"] == T.FloatType() and types["Pay_Delay"] == T.IntegerType()
    assert sum(isinstance(t, T.StringType) for n, t in types.items() if n != "_error") == 33
    r = out.first()
    assert (r.Invoice_Amount, r.Pay_Delay, r.Plant, r.Goods_ID) == (731.0, 22, "SITE9", None)


def test_three_lines_of_one_purchase(spark):
    """An open line, a goods line and a small late invoice: three raw documents, one anomaly, graded Low."""
    from payguard.operators.encode import raw_documents
    blank = {"Invoice_ID": "", "Invoice_Amount": "0", "Invoice_Due_Date": "", "Pay_Type": "", "Pay_Delay": "0", "Invoice_Is_Overdue": ""}
    rows = [{**blank, "Activity": "Ordered", "Order_Line_Amount": "71200.50"},
            {**blank, "Activity": "Delivered", "Order_Line_Amount": "88"},
            {**blank, "Activity": "Settled", "Invoice_ID": "INV-7", "Invoice_Amount": "4999.99", "Invoice_Due_Date": "6/1/22", "Pay_Type": "Late",
             "Pay_Delay": "41", "Invoice_Is_Overdue": "yes"}]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "value STRING")
    good, bad = split_errors(decode_raw(df))
    assert raw_documents(good).count() == 3 and bad.count() == 0
    (risk,) = late_invoice_risk(split_errors(decode_invoice(df))[0]).collect()
    assert (risk.Invoice_ID, risk.Risk, risk.Pay_Delay) == ("INV-7", "Low", 41)


def test_numbers_may_be_padded(spark):
    df = spark.createDataFrame([('{"Invoice_Amount":"\\t7.5 ","Pay_Delay":"\\n5\\t"}',)], "value STRING")
    r = decode_invoice(df).first()
    assert (r.Invoice_Amount, r.Pay_Delay, r._error) == (7.5, 5, None)


def test_part_of_the_fields(spark):
    """Decoding some fields with all of them checked finds the same errors as decoding all, and the same values of good payloads."""
    from payguard.schemas import INVOICE_FIELDS, RAW_FIELDS
    every = RAW_FIELDS + ("Risk", "Model_Name")
    texts = [text for text, _ in CASES] + ['{"Plant":%s,"Invoice_ID":"a"}' % v for v in (
        '"x"', '{"a":1}', "[]", "{", "[1,]", '"{x}"', "NaN", "01", '"\\q"', "tru", "null", '{"a":{"b":[NaN]}}')]
    texts += ['{"Zzz":{"x":1}}', '{"Zzz":[1,}', '{"Plant":"a","Plant":[1]}', ' \n{"Plant":{}}', '{{"Plant":"a"}', '{"Role":{"a":1},"Plant":[2],"Invoice_ID":[1]}',
              '{"Pay_Delay":"1.5","Plant":[1]}', '{"Plant":"a"} x', "  ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, value STRING")

    def seen(decoded):
        return {r.i: (r._error, None if r._error else str([r[f] for f in INVOICE_FIELDS])) for r in decoded.collect()}

    want = seen(decode(df, every, keep=("i",)))
    assert seen(decode(df, INVOICE_FIELDS, keep=("i",), checked=every)) == want
    assert {"nested value Plant", "nested value Invoice_ID", "malformed json", "bad int Pay_Delay", "empty payload", None} <= {e for e, _ in want.values()}
    with pytest.raises(ValueError, match="numeric"):
        decode(df, ("Invoice_ID",), checked=every)


def test_sample_files(spark, tmp_path):
    """Quoting, a missing column, and the order of several files."""
    import pytest
    from payguard.sources.files import POSITION, read_sample_csv
    (tmp_path / "a.csv").write_text('Role,Invoice_ID\n"say ""hi"", x",1\n"two\nlines",2\nback\\,3\n')
    (tmp_path / "b.csv").write_text("Role,Invoice_ID\n" + "".join(f"long enough to be the larger file,{i}\n" for i in range(4, 400)))
    df = read_sample_csv(spark, str(tmp_path), ("Invoice_ID", "Role", "Plant"), position=True).orderBy(*POSITION)
    rows = df.collect()
    assert [int(r.Invoice_ID) for r in rows] == list(range(1, 400))
    assert [r.Role for r in rows[:3]] == ['say "hi", x', "two\nlines", "back\\"] and {r.Plant for r in rows} == {""}
    with pytest.raises(ValueError):
        read_sample_csv(spark, str(tmp_path), ("Invoice_ID", "Plant"), strict=True)


def test_large_sample_files(spark, tmp_path):
    """Splits of a few lines: fields that reach over several splits, CRLF, empty lines in and between records, and the rows' order."""
    import csv

    import pytest
    from payguard.sources.files import POSITION, read_large_csv
    fields = ("Invoice_ID", "Role", "Plant")
    body = "".join(f'"say ""{i}"", x\n\n{"long, line\n" * (i % 40)}",{i}\n' + ("\n" if i % 7 == 0 else "") + f'plain,{i + 1000}\n"",{i + 2000}\n' for i in range(300))
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "a.csv").write_text('Role,"Invoice_ID"\n' + body)
    (tmp_path / "a" / "b.csv").write_text('\nRole,"Invoice_ID"\r\n"two\r\nlines",1\r\nback\\,2\r\n\r\nlast,3', newline="")
    (tmp_path / "a" / "c.csv").write_text('Role,"Invoice_ID"\n')
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "400")
        got = read_large_csv(spark, str(tmp_path / "a"), fields, position=True)
        rows = got.orderBy(*POSITION).collect()
        assert len({(r._file, r._block) for r in rows}) > 50  # many splits
        assert read_large_csv(spark, str(tmp_path / "a" / "c.csv"), fields).count() == 0
        (tmp_path / "empty.csv").write_text("")
        none = read_large_csv(spark, str(tmp_path / "empty.csv"), fields, position=True)
        assert none.columns == [*fields, *POSITION] and none.count() == 0
        (tmp_path / "bad.csv").write_text('Role,Invoice_ID\nx,1\n"never closed,2\n')
        with pytest.raises(ValueError, match="inside a quoted field"):
            read_large_csv(spark, str(tmp_path / "bad.csv"), fields)
        with pytest.raises(ValueError, match="lacks columns"):
            read_large_csv(spark, str(tmp_path / "a"), fields, strict=True)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = []
    for name in ("a", "b", "c"):
        with open(tmp_path / "a" / f"{name}.csv", newline="") as f:
            want += [(r[1], r[0], "") for r in csv.reader(f) if r and r != ["Role", "Invoice_ID"]]
    assert [tuple(r[:3]) for r in rows] == want and len(rows) == 903
    assert rows[-3].Role == "two\r\nlines" and rows[-2].Role == "back\\"


def test_large_sample_files_without_stored_lines(spark, tmp_path):
    """What a split holds whole isn't shuffled or stored, also where the splits' states come by a shuffle the rows are the same."""
    from payguard.sources.files import read_large_csv
    body = "".join(f'"two\nlines {i}",{i}\n' + ("\n" if i % 50 == 0 else "") for i in range(400)) + '"' + "long\n" * 500 + '",400\n'
    (tmp_path / "a.csv").write_text('\n"Ro\nle",Invoice_ID\n' + body)
    (tmp_path / "b.csv").write_text("\n" * 900 + '"Ro\nle",Invoice_ID\n' + body)  # the header is in a later split
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    want = sorted([(str(i), f"two\nlines {i}") for i in range(400)] * 2 + [("400", "long\n" * 500)] * 2)
    try:
        for k in keys[:2]:
            spark.conf.set(k, "700")
        for limit in (before[keys[2]], "0"):
            spark.conf.set(keys[2], limit)
            got = read_large_csv(spark, str(tmp_path), ("Invoice_ID", "Ro\nle"))
            assert sorted(map(tuple, got.collect())) == want
            if limit != "0":
                plan = got._jdf.queryExecution().optimizedPlan().toString()
                assert "MapInArrow" in plan and "csv-lines" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_plain_reader_splits_a_large_file(spark, tmp_path, monkeypatch):
    """One file over the bound is read by many tasks, with the rows that one task gives."""
    from payguard.sources import files
    (tmp_path / "a.csv").write_text("Role,Invoice_ID\n" + "".join(f'"two\nlines {i}",{i}\n' for i in range(400)))
    read = lambda: files.read_sample_csv(spark, str(tmp_path), ("Invoice_ID", "Role"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        one = read()
        assert one.rdd.getNumPartitions() == 1
        monkeypatch.setattr(files, "LARGE_FILE", 5000)
        many = read()
        assert many.rdd.getNumPartitions() > 8 and sorted(many.collect()) == sorted(one.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

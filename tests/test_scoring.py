"""Batch model scoring with pluggable scorers (no server needed)."""

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

import pytest

from payguard.operators.score import (EmptyScorer, HttpClient, HttpScorer, LinearScorer, ModelError, outputs, random_sweep_values,
                                      read_predictions, request_body, score_invoices)


class CountingScorer(LinearScorer):
    """Surrogate that records every request it gets (per Python worker)."""
    calls: list = []

    def predict(self, delays):
        CountingScorer.calls.append(list(delays))
        return super().predict(delays)


# Python workers cannot import this test module: ship its classes by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_request_and_response_format():
    assert json.loads(request_body([18])) == {"instances": [{"Pay_Delay": 18}]}
    assert read_predictions('{"predictions":[[50.2],[7]]}', 2) == [51, 7]
    assert read_predictions('{"predictions":[]}', 1) == [None]
    assert read_predictions('{"predictions":[[null],[],[3]]}', 3) == [None, None, 3]


@pytest.mark.parametrize("text,output", [
    ("1.2345678e-12", 1), ("-1e-300", -1), ("50.0000000000000000000000000001", 51), ("-50.5", -51), ("1e25", (10**25 + 2**31) % 2**32 - 2**31),
    ("2147483648", -2147483648), ("4294967297.5", 2), ("0.0", 0), ("-0.0", 0), ("1e300", 0), ("5E+1", 50), ("123456789012345678901234567890.1", None)])
def test_scores_round_up_with_all_digits(spark, text, output):
    from payguard.functions.scoring import decode_predictions, round_up_text
    if output is None:
        low = (123456789012345678901234567890 + 1) % 2**32
        output = low - 2**32 if low >= 2**31 else low
    answer = '{"predictions":[[%s]]}' % text
    assert read_predictions(answer, 1) == [output]
    got = spark.createDataFrame([(answer,)], "r STRING").select(round_up_text(decode_predictions(F.col("r")))).first()[0]
    assert got == output


@pytest.mark.parametrize("answer", ['{"error":"x"}', "<html>", '{"predictions":[[1]]}', '{"predictions":[["a"],[1]]}', '{"predictions":{"a":1}}', "[]"])
def test_unusable_answers_are_errors(answer):
    with pytest.raises(ModelError):
        read_predictions(answer, 2)


def test_score_invoices_grades_and_names(spark):
    df = spark.createDataFrame([("a", 66), ("b", 67), ("c", 140), ("d", 66)], "Invoice_ID STRING, Pay_Delay INT")
    out = {r.Invoice_ID: r for r in score_invoices(df, LinearScorer()).collect()}
    # 66*0.75+0.1 = 49.6 -> 50 Low; 67 -> 50.35 -> 51 Medium; 140 -> 105.1 -> 106 High
    assert (out["a"].output, out["a"].Risk) == (50, "Low")
    assert (out["b"].output, out["b"].Risk) == (51, "Medium")
    assert (out["c"].output, out["c"].Risk) == (106, "High")
    assert {r.Model_Name for r in out.values()} == {"anomaly-classifier-predictor"}
    assert all(r._error is None for r in out.values())


def test_empty_predictions_flagged(spark):
    df = spark.createDataFrame([("a", 1)], "Invoice_ID STRING, Pay_Delay INT")
    r = score_invoices(df, EmptyScorer()).first()
    assert r.output is None and r.Risk is None and r._error == "empty predictions"


def test_each_delay_is_asked_for_once_in_a_task():
    import pandas as pd
    CountingScorer.calls = []
    batches = [pd.Series([5, 5, 7, 9] * 100), pd.Series([9, 5, None, 11])]
    out = [x.tolist() for x in outputs(CountingScorer(), 2)(iter(batches))]
    assert CountingScorer.calls == [[5, 7], [9], [0, 11]]
    assert out[0][:4] == [4, 4, 6, 7] and out[1] == [7, 4, 1, 9]


class Answers:
    """A connection that gives prepared answers: a status and a body, or an error."""

    def __init__(self, *answers):
        self.answers, self.sent, self.opened = list(answers), [], 0

    def __call__(self, netloc, timeout):
        self.opened += 1
        return self

    def request(self, method, path, body, headers):
        self.sent.append((method, path, body.decode(), headers["Content-Type"]))

    def getresponse(self):
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        self.status, self.body = answer
        return self

    def read(self):
        return self.body.encode()

    def close(self):
        pass


def test_http_scorer():
    server = Answers((200, '{"predictions":[[6],[8.5]]}'), (200, '{"predictions":[[1]]}'))
    s = HttpScorer("http://model:8080/v1/models/m:predict", connect=server)
    s.open()
    assert read_predictions(s.predict([3, 4]), 2) == [6, 9] and read_predictions(s.predict([1]), 1) == [1]
    s.close()
    assert server.opened == 1
    assert server.sent[0] == ("POST", "/v1/models/m:predict", request_body([3, 4]), "application/json")


def test_transient_failures_are_tried_again():
    import http.client
    server = Answers((503, ""), (429, ""), http.client.IncompleteRead(b""), OSError("gone"), (200, "ok"))
    assert HttpClient("http://m/p", retries=5, connect=server, pause_s=0).post("x", {"Content-Type": "t"}) == "ok"
    assert len(server.sent) == 5
    with pytest.raises(ModelError):
        HttpClient("http://m/p", retries=2, connect=Answers((500, ""), (500, "")), pause_s=0).post("x", {"Content-Type": "t"})


@pytest.mark.parametrize("status", [301, 400, 401, 403, 404])
def test_refusals_are_errors_at_once(status):
    server = Answers((status, "{}"), (200, "ok"))
    with pytest.raises(ModelError):
        HttpClient("http://m/p", connect=server, pause_s=0).post("x", {"Content-Type": "t"})
    assert len(server.sent) == 1


def test_random_sweep_distinct_in_range(spark):
    vals = [r.Value for r in random_sweep_values(spark, 500, 1, 500, seed=7).collect()]
    assert len(vals) == len(set(vals)) and all(1 <= v <= 500 for v in vals) and len(vals) > 250


def test_model_path_filters_before_scoring(spark):
    """Only valid late invoices reach the model, and only their delays leave the JVM."""
    from payguard.plans.risk_job import late_invoice_risk
    df = spark.createDataFrame([("a", 10.0, "Late", 5)], "Invoice_ID STRING, Invoice_Amount FLOAT, "
                                                         "Pay_Type STRING, Pay_Delay INT")
    plan = late_invoice_risk(df, scorer=LinearScorer())._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Filter")  # printed top-down: filter is below
    assert "Pay_Delay" in plan.split("ArrowEvalPython")[1].split("]")[0]


def test_flagship_model_path_fails_on_missing_prediction(spark):
    import pytest
    from pyspark.errors import PySparkException
    from payguard.plans.risk_job import late_invoice_risk
    df = spark.createDataFrame([("a", 10.0, "Late", 5)], "Invoice_ID STRING, Invoice_Amount FLOAT, "
                                                         "Pay_Type STRING, Pay_Delay INT")
    with pytest.raises(PySparkException):
        late_invoice_risk(df, scorer=EmptyScorer()).collect()


def test_payload_with_leading_newline_is_an_object(spark):
    from payguard.operators.decode import decode_invoice
    df = spark.createDataFrame([('\n\t {"Invoice_Amount":"5"}',)], "value STRING")
    assert decode_invoice(df).first()._error is None


def test_null_delay_scores_as_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 0)], "Invoice_ID STRING, Pay_Delay INT")
    out = {r.Invoice_ID: r.output for r in score_invoices(df, LinearScorer()).collect()}
    assert out == {"a": 1, "b": 1}


@pytest.mark.parametrize("url", ["", "model:8443/v1"])
def test_http_scorer_needs_a_url(url):
    with pytest.raises(ValueError):
        HttpScorer(url)

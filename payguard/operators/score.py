"""Model scoring: batched, distributed, with a pluggable scorer.

The model takes ``{"instances":[{"Pay_Delay":n}, ...]}`` and answers
``{"predictions":[[s], ...]}``. ``s`` is read with all its digits, rounded
away from zero, and cut to an INT's 32 bits as a big decimal's int conversion
does; only that number leaves the scorer.

:func:`score_invoices` runs the scorer in an iterator ``pandas_udf`` over the
delay column alone: one scorer session per task, which asks for each delay
once however many Arrow batches hold it. No shuffle, no join: the plan stays a
narrow projection after the filters, so only valid late invoices reach the
model.
"""

from __future__ import annotations

import json
import time
from decimal import ROUND_CEILING, ROUND_FLOOR, Context, Decimal, Inexact
from typing import Iterable, Iterator, Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from payguard import config as C
from payguard.operators.risk import grade_by_output


class Scorer(Protocol):
    def open(self) -> None: ...
    def predict(self, delays: list[int]) -> str: ...
    def close(self) -> None: ...


def request_body(delays: Iterable[int]) -> str:
    return json.dumps({"instances": [{"Pay_Delay": int(d)} for d in delays]})


class ModelError(RuntimeError):
    """The model server's answer can't be used."""


def whole_output(score: Decimal) -> int:
    """The score rounded away from zero, as the low 32 bits of an INT."""
    if not score.is_finite():
        raise ModelError(f"prediction {score} is not a number")
    if score.adjusted() > 4000:
        raise ModelError("prediction is out of any range")
    rounding = ROUND_CEILING if score > 0 else ROUND_FLOOR
    whole = int(score.to_integral_value(rounding=rounding, context=Context(prec=max(len(score.as_tuple().digits), score.adjusted() + 1, 1) + 1)))
    low = whole % 2**32
    return low - 2**32 if low >= 2**31 else low


def read_predictions(text: str, n: int) -> list[int | None]:
    """The output for each of ``n`` instances; None where a prediction is empty or
    null. An answer with another number of predictions is an error."""
    try:
        body = json.loads(text, parse_float=Decimal, parse_int=Decimal)
        rows = body["predictions"]
    except (ValueError, KeyError, TypeError) as e:
        raise ModelError("the model's answer has no predictions") from e
    if not isinstance(rows, list) or len(rows) not in (0, n):
        raise ModelError(f"the model answered {len(rows) if isinstance(rows, list) else rows!r} predictions for {n} instances")
    out: list[int | None] = []
    for row in rows or [None] * n:
        first = row[0] if isinstance(row, list) and row else row
        if isinstance(first, bool) or not (first is None or first == [] or isinstance(first, Decimal)):
            raise ModelError(f"prediction {first!r} is not a number")
        out.append(whole_output(first) if isinstance(first, Decimal) else None)
    return out


class LinearScorer:
    """Surrogate model ``score = delay * slope + intercept`` (exact decimals).

    Stands in for the missing trained model so the scoring path can be run
    and checked; it says nothing about the real model's scores.
    """

    def __init__(self, slope: str = "0.75", intercept: str = "0.1"):
        self.slope, self.intercept = Decimal(slope), Decimal(intercept)
        self.requests = 0

    def open(self) -> None:
        pass

    def predict(self, delays: list[int]) -> str:
        self.requests += 1
        rows = ",".join(f"[{Decimal(int(d)) * self.slope + self.intercept}]" for d in delays)
        return '{"predictions":[' + rows + ']}'

    def close(self) -> None:
        pass


class EmptyScorer(LinearScorer):
    """A model that has no prediction for anything."""

    def predict(self, delays: list[int]) -> str:
        return '{"predictions":[]}'


class HttpClient:
    """One keep-alive connection that tries transient failures again.

    Connection errors, 429 and 5xx are tried ``retries`` times in all, with a
    pause that doubles; any other answer than 2xx is an error at once.
    ``connect(netloc, timeout)`` makes the connection (tests pass their own).
    """

    def __init__(self, url: str, timeout_s: float = 30.0, retries: int = 3, ca_data: str | None = None, connect=None,
                 pause_s: float = 0.5):
        self.url, self.timeout_s, self.retries, self.ca_data = url, timeout_s, max(retries, 1), ca_data
        self.connect, self.pause_s, self._conn = connect, pause_s, None

    def _open(self):
        import http.client
        from urllib.parse import urlsplit
        u = urlsplit(self.url)
        if self.connect is not None:
            conn = self.connect(u.netloc, self.timeout_s)
        elif u.scheme.lower() == "https":
            import ssl
            conn = http.client.HTTPSConnection(u.netloc, timeout=self.timeout_s, context=ssl.create_default_context(cadata=self.ca_data))
        else:
            conn = http.client.HTTPConnection(u.netloc, timeout=self.timeout_s)
        return conn, (u.path or "/") + (f"?{u.query}" if u.query else "")

    def post(self, body: str, headers: dict[str, str]) -> str:
        import http.client
        last: Exception | None = None
        for turn in range(self.retries):
            if turn:
                time.sleep(self.pause_s * 2 ** (turn - 1))
            try:
                if self._conn is None:
                    self._conn, self._path = self._open()
                self._conn.request("POST", self._path, body=body.encode(), headers=headers)
                answer = self._conn.getresponse()
                text = answer.read().decode("utf-8", "replace")
            except (OSError, http.client.HTTPException) as e:
                last = e
                self.close()
                continue
            if 200 <= answer.status < 300:
                return text
            last = ModelError(f"{self.url} answered {answer.status}")
            if answer.status != 429 and answer.status < 500:
                raise last
        raise ModelError(f"no answer after {self.retries} tries") from last

    def close(self) -> None:
        if self._conn is not None:
            self._conn.close()
            self._conn = None


class HttpScorer:
    """REST model server client; one connection per task. Over https the server is
    checked against ``ca_data`` (PEM text) or, without it, the system's authorities."""

    def __init__(self, url: str, timeout_s: float = 30.0, retries: int = 3, ca_data: str | None = None, connect=None, pause_s: float = 0.5):
        if not url or not url.lower().startswith(("http://", "https://")):
            raise ValueError("a model predictor URL (http or https) is required")
        self.args = (url, timeout_s, retries, ca_data, connect, pause_s)
        self.client: HttpClient | None = None

    def open(self) -> None:
        self.client = HttpClient(*self.args)

    def predict(self, delays: list[int]) -> str:
        return self.client.post(request_body(delays), {"Content-Type": C.JSON_CONTENT_TYPE, "Accept": C.JSON_CONTENT_TYPE})

    def close(self) -> None:
        if self.client is not None:
            self.client.close()


def outputs(scorer: Scorer, batch_size: int):
    """The model's output for each delay of a task's Arrow batches, each delay asked for once."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[int, int | None] = {}
        scorer.open()
        try:
            for delays in batches:
                delays = delays.fillna(0).astype("int64")
                fresh = [int(d) for d in delays.unique() if int(d) not in known]
                for i in range(0, len(fresh), batch_size):
                    chunk = fresh[i:i + batch_size]
                    known.update(zip(chunk, read_predictions(scorer.predict(chunk), len(chunk))))
                yield pd.Series([known[d] for d in delays.tolist()], dtype="Int32")
        finally:
            scorer.close()
    return run


def score_invoices(df: DataFrame, scorer: Scorer, delay_col: str = "Pay_Delay", batch_size: int = 256, model_name: str | None = None) -> DataFrame:
    """Add ``output`` (INT), ``Risk`` and ``Model_Name``. A missing delay scores as
    0. An empty prediction leaves output and Risk NULL and sets ``_error``."""
    model = F.pandas_udf(outputs(scorer, batch_size), "int", F.PandasUDFType.SCALAR_ITER)
    graded = grade_by_output(df.withColumn("output", model(F.col(delay_col).cast("int"))),
                             default_name=model_name or C.DEFAULT_MODEL_NAME)
    return graded.withColumn("_error", F.when(F.col("output").isNull(), F.lit("empty predictions")))


def random_sweep_values(spark: SparkSession, draws: int = 500, low: int = 1, high: int = 500,
                        seed: int | None = None) -> DataFrame:
    """Distinct random integers in [low, high] from ``draws`` draws (model audit input)."""
    v = F.floor(F.rand(seed) * (high - low + 1)).cast("int") + F.lit(low)
    return spark.range(draws).select(v.alias("Value")).distinct()

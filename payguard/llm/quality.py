"""Quality by compression: zstandard dictionaries trained on good and on bad
labelled text. A text is compressed block by block with either dictionary; the
normalised difference of the compressed sizes, with the sizes themselves
(repetition compresses well under any dictionary), is calibrated to a score by
a logistic fit on labelled texts that the dictionaries haven't seen; few texts
shrink the fit towards the share of good ones.

Blocks are compressed on their own, so a dictionary counts in every part of a
long text alike. The model is fitted on at most ``TRAIN_DOCS`` labelled texts
(those with the smallest hash); scoring covers whole texts.

Defined cases: a null text is empty; an empty text is scored like any other (it
has one empty block); contradictory labels of one id count as separate rows;
without labels of both kinds every score is the share of good labels (0.5 if
there are none); repeated rows repeat.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from payguard.llm.common import crc_mod_col, map_text

BLOCK = 512
DICT_BYTES = 112_640
LEVEL = 3
#: Bound of the training sample, in labelled texts of each kind, and of what is read of each.
TRAIN_DOCS = 1500
TRAIN_CHARS = 20_000
#: Training texts that may hold a line of which dictionaries learn.
SHARED = 2
THRESHOLD = 0.7
FOLDS, HELD = 4, 2
#: Parts of the training texts, each calibrated with dictionaries of the others, and how strongly the fit is shrunk.
PARTS, RIDGE = 6, 3.0
SCHEMA = T.StructType([T.StructField("score", T.DoubleType())])


def blocks(data: bytes) -> list[bytes]:
    """Pieces of BLOCK bytes; a rest below half a block goes to the piece before it."""
    stops = list(range(BLOCK, len(data) - BLOCK // 2, BLOCK)) + [len(data)]
    return [data[a:b] for a, b in zip([0, *stops], stops)]


class Compressors:
    """Both dictionaries, ready to compress."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard
        self.tools = []
        for data in (good, bad):
            d = zstandard.ZstdCompressionDict(data)
            d.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))

    def features(self, text: str | None) -> list[float]:
        """Difference and sizes over the whole text, and how its blocks lean and repeat."""
        parts = blocks((text or "").encode())
        good, bad = (np.array([len(t.compress(p)) for p in parts], dtype=float) for t in self.tools)
        size = np.array([max(len(p), 1) for p in parts], dtype=float)
        g, b, n = good.sum(), bad.sum(), size.sum()
        diff = (b - g) / max(g, b)
        dense = np.log((g + 8) / (n + 8))
        lean = float((np.tanh(8 * (bad - good) / np.maximum(good, bad)) * size).sum() / n)
        return [1.0, diff, diff * abs(diff), dense, max(0.0, -1.2 - dense), lean, float((size * (good / size < 0.25)).sum() / n)]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 100) -> tuple:
    """Weights, means and deviations of a ridge logistic regression: Newton steps,
    halved until the loss falls, so separable classes don't send it astray. The
    first column is the constant, which is not shrunk."""
    mean, dev = x.mean(0), x.std(0)
    mean[0], dev[0] = 0.0, 1.0
    dev[dev < 1e-9] = 1.0
    z, w = (x - mean) / dev, np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-6

    def loss(w):
        m = z @ w
        return (weight * (np.logaddexp(0, m) - y * m)).sum() + 0.5 * (shrink * w * w).sum()

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        grad = z.T @ (weight * (p - y)) + shrink * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(shrink)
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        new = loss(w - size * step)
        if not now - new > 1e-9 * max(1.0, abs(now)):
            break
        w, now = w - size * step, new
    return w, mean, dev


def train_dictionary(texts: list[str], shared: set) -> bytes:
    """A dictionary of the texts without the ``shared`` lines."""
    import zstandard
    own = ("\n".join(x for x in (t or "").split("\n") if x not in shared) for t in texts)
    samples = [p for t in own for p in blocks(t.encode()) if len(p) >= 16]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples for a trained dictionary: they are the dictionary themselves
        return b"\n".join(samples)[:DICT_BYTES]


def fit(labelled: list[tuple[str, int]], share: float | None = None) -> dict:
    """The model from (text, label) rows: each part is calibrated with dictionaries
    trained on the others, nearly as rich as the scoring ones, which use all.
    ``share`` is the share of label 1 before sampling, to which the score is calibrated."""
    y = np.array([v for _, v in labelled], dtype=float)
    if len(set(y.tolist())) < 2 or min(y.sum(), (1 - y).sum()) < 4:
        return {"share": float(y.mean()) if len(y) else 0.5}
    # Lines of several texts (notices, boilerplate, copies) say nothing about quality, but would fill a dictionary.
    held = Counter(line for t, _ in labelled for line in set((t or "").split("\n")))
    shared = {line for line, n in held.items() if n > SHARED}
    rows, target = [], []
    part = np.zeros(len(y), dtype=int)
    for v in (0, 1):
        at = np.flatnonzero(y == v)
        part[at] = np.arange(len(at)) % PARTS
    for h in range(PARTS):
        seen = [labelled[i] for i in np.flatnonzero(part != h)]
        c = Compressors(*(train_dictionary([t for t, v in seen if v == k], shared) for k in (1, 0)))
        for i in np.flatnonzero(part == h):
            rows.append(c.features(labelled[i][0]))
            target.append(y[i])
    target, share = np.array(target), float(y.mean()) if share is None else share
    weight = np.where(target > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    w, mean, dev = logistic(np.array(rows), target, weight, RIDGE)
    return {"good": train_dictionary([t for t, v in labelled if v == 1], shared),
            "bad": train_dictionary([t for t, v in labelled if v == 0], shared),
            "w": w, "mean": mean, "dev": dev}


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, per_class: int,
                  chars: int) -> tuple[list[tuple[str, int]], float | None]:
    """A bounded sample of labelled training texts: per class the ``per_class``
    with the smallest hash, at most ``chars`` characters of each. And the share of
    label 1 among all training rows."""
    seen = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod_col("doc_id", folds) != held))
    out = []
    for v in (1, 0):
        some = seen.filter(F.col("y") == v).dropDuplicates(["doc_id"]).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(per_class)
        got = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id", "y").agg(
            F.min(F.substring(F.coalesce(F.col("text"), F.lit("")), 1, chars)).alias("text"))
        out += [(r["text"], r["y"]) for r in sorted(got.collect(), key=lambda r: r["doc_id"])]
    return out, seen.agg(F.avg("y")).first()[0]


def score(df: DataFrame, model: dict, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the column ``score``."""
    if "share" in model:
        return df.select(*keep, F.lit(model["share"]).alias("score"))
    shared = df.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICT_BYTES at most and a few weights

    def make():
        m = shared.value
        tools = Compressors(m["good"], m["bad"])

        def run(texts):
            x = (np.array([tools.features(t) for t in texts]) - m["mean"]) / m["dev"]
            return {"score": 1 / (1 + np.exp(-np.clip(x @ m["w"], -30, 30)))}
        return run

    return map_text(df, text, keep, SCHEMA, make)


def train(docs: DataFrame, labels: DataFrame) -> dict:
    return fit(*training_rows(docs, labels, "quality", FOLDS, HELD, TRAIN_DOCS, TRAIN_CHARS))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    out = score(docs.select("doc_id", "text"), train(docs, labels), ["doc_id"])
    return out.select("doc_id", (crc_mod_col("doc_id", FOLDS) == HELD).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def filtered(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those the classifier rejects, in the columns of ``docs``."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(c).alias(n) for c, n in names.items()])
    model = train(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), labels)
    kept = score(plain, model, plain.columns, names[text]).filter(F.col("score") >= THRESHOLD)
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])

"""Language identification in two levels: the language family first, then
one-versus-one linear support vector machines between the languages of it.

Features are hashed letter n-grams (1 to 3 letters, words padded by a space),
as square roots of their shares. All machines are trained here, for every
language there is, on at most ``TRAIN_DOCS`` texts of each, ``TRAIN_CHARS``
characters each; prediction reads whole texts. Where languages are so many that
these would be over ``TRAIN_ROWS``, the languages that are families of their own
give fewer texts each, ``LEAST_DOCS`` at least.

Defined cases: a text that is null or has no letter is ``und`` with score 0; a
language without a family in ``FAMILIES`` is a family of its own; with a single
learned language that one is predicted with score 1, with none ``und``; rows
whose ``lang`` is null teach nothing; repeated rows repeat.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from payguard.llm.common import crc_mod_col, map_text

#: Fixed public facts: families of common languages.
FAMILIES = {
    **dict.fromkeys(("en", "de", "nl", "sv", "da", "no", "is"), "germanic"),
    **dict.fromkeys(("fr", "es", "it", "pt", "ca", "ro", "gl"), "romance"),
    **dict.fromkeys(("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr"), "slavic"),
}
BUCKETS = 1 << 12
TRAIN_DOCS = 250
TRAIN_CHARS = 6000
TRAIN_ROWS, LEAST_DOCS = 16_000, 20
FOLDS, HELD = 5, 0
LETTER = re.compile(r"[^\W\d_]")
SCHEMA = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
#: Whether a code point below 128 is a letter; all others count as letters.
ASCII_LETTER = np.array([97 <= c <= 122 for c in range(128)])


def features(text: str) -> np.ndarray:
    """Square roots of the shares of the hashed n-grams."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    cp = np.where((cp >= 128) | ASCII_LETTER[np.minimum(cp, 127).astype(np.int64)], cp, 0)
    cp = np.concatenate(([0], cp, [0])).astype(np.uint64)
    cp = cp[np.concatenate(([True], (cp[1:] != 0) | (cp[:-1] != 0)))]
    out = np.zeros(BUCKETS)
    for n in (1, 2, 3):
        if len(cp) < n:
            continue
        h = np.full(len(cp) - n + 1, n * 7919, dtype=np.uint64)
        for k in range(n):
            h = (h ^ cp[k:len(cp) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out += np.bincount((h >> np.uint64(7)).astype(np.int64) & (BUCKETS - 1), minlength=BUCKETS) / len(h)
    return np.sqrt(out / 3)


def svm(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 120) -> np.ndarray:
    """Linear support vector machine (squared hinge, accelerated gradient); y is -1 or 1.
    Classes weigh the same whatever their sizes. Returns weights and, last, the bias."""
    x = np.hstack([x, np.full((len(x), 1), 0.3)]).astype(np.float32)
    c = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    y = y.astype(np.float32)
    w = np.zeros(x.shape[1], dtype=np.float32)
    v, t = w.copy(), 1.0
    rate = 1.0 / (2 * float((c[:, None] * x * x).sum()) + ridge)
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v + rate * (2 * x.T @ (c * y * slack) - ridge * v)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w


def fit(rows: list[tuple[str, str]]) -> dict:
    """The machines from (text, language) rows."""
    rows = [(t, v) for t, v in rows if t and LETTER.search(t)]
    langs = sorted({v for _, v in rows})
    family = {v: FAMILIES.get(v, v) for v in langs}
    model = {"langs": langs, "family": family, "families": sorted(set(family.values())), "w": np.zeros((BUCKETS + 1, 0), dtype=np.float32)}
    if len(langs) < 2:
        return model
    x = np.array([features(t) for t, _ in rows], dtype=np.float32)
    at = np.array([v for _, v in rows])
    fam = np.array([family[v] for v in at])
    pairs, cols = [], []
    for f in model["families"] if len(model["families"]) > 1 else []:
        pairs.append(("family", f, None))
        cols.append(svm(x, np.where(fam == f, 1, -1)))
    for f in model["families"]:
        own = [v for v in langs if family[v] == f]
        for i, a in enumerate(own):
            for b in own[i + 1:]:
                m = (at == a) | (at == b)
                pairs.append(("pair", a, b))
                cols.append(svm(x[m], np.where(at[m] == a, 1, -1)))
    return model | {"pairs": pairs, "w": np.array(cols).T}


def predict(text: str | None, model: dict) -> tuple[str, float]:
    if not model["langs"] or not text or not LETTER.search(text):
        return "und", 0.0
    if len(model["langs"]) == 1:
        return model["langs"][0], 1.0
    margin = features(text).astype(np.float32) @ model["w"][:-1] + 0.3 * model["w"][-1]
    sure = lambda m: float(1 / (1 + np.exp(-np.clip(4 * m, -30, 30))))
    best, score = model["families"][0], 1.0
    if len(model["families"]) > 1:
        by = sorted(((float(m), f) for (k, f, _), m in zip(model["pairs"], margin) if k == "family"), reverse=True)
        best, score = by[0][1], sure((by[0][0] - by[1][0]) / 2)
    own = [v for v in model["langs"] if model["family"][v] == best]
    votes = dict.fromkeys(own, 0.0)
    weakest = {v: 1.0 for v in own}
    for (k, a, b), m in zip(model["pairs"], margin):
        if k == "pair" and a in votes:
            win, lose = (a, b) if m >= 0 else (b, a)
            votes[win] += 1 + sure(abs(m)) / 1000
            weakest[win] = min(weakest[win], sure(abs(m)))
            weakest[lose] = min(weakest[lose], 1 - sure(abs(m)))
    lang = max(own, key=lambda v: (votes[v], v))
    return lang, score * weakest[lang]


def training_rows(docs: DataFrame) -> list[tuple[str, str]]:
    """The bounded sample: of each language about ``TRAIN_DOCS`` texts by hash of the id."""
    seen = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod_col("doc_id", FOLDS) != HELD))
    sizes = seen.groupBy("lang").count().collect()
    few = min(TRAIN_DOCS, max(TRAIN_ROWS // max(len(sizes), 1), LEAST_DOCS))
    want = [(r["lang"], r["count"], TRAIN_DOCS if r["lang"] in FAMILIES else few) for r in sizes]
    limits = docs.sparkSession.createDataFrame(want, "lang string, count bigint, docs int")  # a row of each language
    u = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    got = seen.select("lang", u.alias("u"), F.substring("text", 1, TRAIN_CHARS).alias("text")).join(F.broadcast(limits), "lang")
    got = got.filter(F.col("u") < 1.5 * F.col("docs") / F.col("count"))  # 1.5 docs rows expected of each language, ties by text
    got = got.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("u", "text"))).filter("n <= docs")
    rows = got.select("lang", "count", "n", "text").collect()
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (-r["count"], r["lang"], r["n"]))]


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``."""
    model = fit(training_rows(docs))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights of each family and of each pair of languages in a family

    def make():
        m = shared.value

        def run(texts):
            got = [predict(t, m) for t in texts]
            return {"lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}
        return run

    out = map_text(docs.select("doc_id", "text"), "text", ["doc_id"], SCHEMA, make)
    return out.select("doc_id", (crc_mod_col("doc_id", FOLDS) == HELD).alias("held_out"), "lang_pred", "score")

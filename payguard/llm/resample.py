"""Importance resampling towards a target distribution over hashed n-grams.

A text's features are its runs of one and two words, counted with repeats and
hashed to buckets. A bucket's gain is the logarithm of its smoothed share in
the target over that in the corpus; a document's weight is the mean gain of its
features. Gumbel noise from a hash of the id is added, and the documents with
the highest scores are drawn: a weighted sample without replacement.

The text work is Arrow kernels over batches: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode``; pairs of
neighbouring dictionary indices are the two-word runs, each distinct pair is
hashed once (the CRC of its first word is carried on), ``take`` spreads the
gains and a segmented sum gives them to the documents. Every task sends one
count for each bucket, whatever it read.

Ranks come from a range shuffle of the scores alone (``dense_index``), never
from one task's sort; the draw has no cap.

Defined cases: a null or empty text has no features, weight 0 and can't be
drawn; a null id hashes as the empty text and loses ties; rows with the same id
and score rank by weight and features, equal rows in any order; an empty target
gives gains that favour rare buckets, an empty table an empty result. Other
columns are ignored, so none can clash.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from payguard.llm.common import cuts, materialise
from payguard.operators.replay import dense_index

#: Anything but ASCII digits, lower-case ASCII letters and non-ASCII characters ends a word.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LEAST_WORDS, DRAWN_PERCENT, SEED = 20, 25, 7
GAIN_SCALE = 1000


def grams(texts, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of an Arrow array of texts: where each text's words start (and the end), the bucket
    of each word, and the bucket of each word with the next one (-1 for a text's last)."""
    import pyarrow as pa
    import pyarrow.compute as pc
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BREAK)
    flat, parent = pc.list_flatten(split), pc.list_parent_indices(split)
    full = pc.greater(pc.binary_length(flat), 0)  # a break at an end leaves an empty piece
    coded, parent = pc.filter(flat, full), pc.filter(parent, full).to_numpy(zero_copy_only=False)
    coded = coded.dictionary_encode()
    words = [w.encode() for w in coded.dictionary.to_pylist()]
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.searchsorted(parent, np.arange(len(texts) + 1))
    crc = np.array([zlib.crc32(w) for w in words], dtype=np.int64)
    one = pc.take(pa.array(crc % buckets), coded.indices).to_numpy(zero_copy_only=False) if len(at) else at
    two = np.full(len(at), -1, dtype=np.int64)
    same = np.flatnonzero(parent[1:] == parent[:-1])
    pairs, back = np.unique(at[same] * len(words) + at[same + 1], return_inverse=True)
    first, second = np.divmod(pairs, max(len(words), 1))
    opened = [zlib.crc32(b" ", int(c)) for c in crc]
    hashed = np.fromiter((zlib.crc32(words[b], opened[a]) for a, b in zip(first.tolist(), second.tolist())), dtype=np.int64, count=len(pairs))
    two[same] = (hashed % buckets)[back]
    return starts, one, two


def bucket_counts(df: DataFrame, text: str, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all texts; empty buckets have no row."""
    def run(batches):
        import pyarrow as pa
        held = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for start, stop in cuts(batch.column(0)):
                _, one, two = grams(batch.column(0).slice(start, stop - start), buckets)
                held += np.bincount(one, minlength=buckets) + np.bincount(two[two >= 0], minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(held[used])], names=["bucket", "n"])

    return df.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, text: str, target: DataFrame, target_text: str, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket (a parameter's number of rows)."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for into, counts in ((s, bucket_counts(docs, text, buckets)), (t, bucket_counts(target, target_text, buckets))):
        for r in counts.collect():
            into[r["bucket"]] = r["n"]
    return np.floor(GAIN_SCALE * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighed(docs: DataFrame, text: str, gain: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``n_words, n_features, weight`` of every row."""
    index = docs.sparkSession.sparkContext.broadcast(gain)
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    schema = T.StructType([T.StructField(f"k_{i}", kinds[c]) for i, c in enumerate(keep)]
                          + [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for start, stop in cuts(batch.column(0)):
                part = batch.slice(start, stop - start)
                starts, one, two = grams(part.column(0), len(index.value))
                each = index.value[one] + np.where(two >= 0, index.value[two], 0)
                total = np.concatenate([[0], np.cumsum(each)])
                words = np.diff(starts)
                features = np.maximum(2 * words - 1, 0)
                weight = np.floor_divide(total[starts[1:]] - total[starts[:-1]], np.maximum(features, 1))
                arrays = [part.column(1 + i) for i in range(len(keep))] + [pa.array(v.astype(np.int64)) for v in (words, features, weight)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    mapped = docs.select(F.col(text).cast("string").alias("_text"), *[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]).mapInArrow(run, schema)
    return mapped.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], "n_words", "n_features", "weight")


def noise(doc_id: str, seed: int):
    """Gumbel noise, scaled and floored, from the hash of ``<seed>:<doc_id>``."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(GAIN_SCALE)) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = BUCKETS,
             least_words: int = LEAST_WORDS, percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` is null for those not drawn."""
    gain = gains(docs, text, target, target_text, buckets)
    rows = weighed(docs, text, gain, [doc_id]).withColumn("score", F.col("weight") + noise(doc_id, seed))
    rows = rows.select("*", (F.col("n_words") < least_words).alias("_short"), (-F.col("score")).alias("_down"), F.col(doc_id).isNull().alias("_none"))
    rows = materialise(rows, "resample-scores")
    able = rows.agg(F.count_if(~F.col("_short"))).first()[0]
    ranked = dense_index(rows, ["_short", "_down", "_none", doc_id, "weight", "n_features"], total_col=None)
    rank = F.when(F.col("_idx") < percent * able // 100, F.col("_idx") + 1).cast("bigint")
    return ranked.select(doc_id, "n_features", "weight", "score", rank.alias("rank"))


#: DuckDB has no CRC: it is folded over a feature's bytes with the table of the reflected polynomial.
SQL = f"""
WITH RECURSIVE poly(b, step, c) AS (
  SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE step < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM poly WHERE step = 8),
texts AS (SELECT 'd' AS side, row_number() OVER () AS rid, doc_id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
words AS MATERIALIZED (SELECT side, rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM texts),
grams AS MATERIALIZED (SELECT side, rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM words),
hashed AS MATERIALIZED (SELECT g, xor(list_reduce(list_concat([4294967295], list_transform(range(0, octet_length(encode(g))),
    lambda i: CAST('0x' || substr(hex(encode(g)), 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT g FROM grams) q, crc),
counts AS (SELECT side, bucket, count(*) AS n FROM grams JOIN hashed USING (g) GROUP BY side, bucket),
totals AS (SELECT coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM counts),
gain AS MATERIALIZED (SELECT bucket, CAST(floor({GAIN_SCALE} * ln(CAST(t1 + 1 AS DOUBLE) * (s + {BUCKETS}) / (CAST(s1 + 1 AS DOUBLE) * (t + {BUCKETS})))) AS BIGINT) AS gain
  FROM (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s1, coalesce(sum(n) FILTER (side = 'b'), 0) AS t1 FROM counts GROUP BY bucket) q, totals),
weights AS (SELECT rid, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM grams JOIN hashed USING (g) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY rid),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
    CAST('0x' || left(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) AS h
  FROM words LEFT JOIN weights USING (rid) WHERE side = 'd'),
noisy AS (SELECT *, weight + CAST(floor(-{GAIN_SCALE} * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
ranked AS (SELECT *, row_number() OVER (ORDER BY n_words < {LEAST_WORDS}, score DESC, doc_id NULLS LAST, weight, n_features) AS r, count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () AS able FROM noisy)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN r <= ({DRAWN_PERCENT} * able) // 100 THEN r END AS rank FROM ranked"""

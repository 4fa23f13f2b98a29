"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

Every source gets a rate: the mean number of copies of each of its documents
that brings its expected size to its target share of the budget. A document's
number of copies is the inverse of the Poisson distribution with that mean at
a number in [0, 1) hashed from the seed and the document id, so the mix is the
same on every run and on every cluster. The copies are dealt out and sorted by
hashed keys, which shuffles them globally.

Defined cases: a null source is a source of its own; a null text has size 0
(each document weighs its characters plus one); rows with equal ids draw the
same number (a null id is the text ``null``); a source without a weight is left
out; input columns named ``copy_no`` or ``shuffle_key`` are replaced; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from payguard.llm.common import attach, materialise

#: A rate over this is the sum of several equal parts, each with its own draw,
#: which keeps exp(-rate) far from underflow.
PART = 64.0
SEED = "mix-1"


def uniform(seed: str, part: Column, doc_id: Column) -> Column:
    """A number in [0, 1): the first 52 bits of an MD5."""
    text = F.concat_ws(":", F.lit(seed), part.cast("string"), doc_id)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(2 ** 52))


def rates(sizes: DataFrame, weights: dict[str, float] | None, temperature: float) -> DataFrame:
    """From (src, n_rows, size): ``rate``. Without weights the target share is
    proportional to ``size ** temperature``. The budget is the size of the corpus."""
    if weights is None:
        target = F.sqrt("size") if temperature == 0.5 else F.pow(F.col("size").cast("double"), F.lit(float(temperature)))
    else:
        target = F.lit(0.0)
        for name, w in weights.items():
            target = F.when(F.col("src") == F.lit("=" + name), F.lit(float(w))).otherwise(target)
    sizes = sizes.withColumn("w", target)
    total = sizes.agg(F.sum("size").cast("double").alias("_total"), F.sum("w").alias("_w"))
    return sizes.crossJoin(F.broadcast(total)).select(  # one row of totals
        "src", "n_rows", (F.col("w") / F.col("_w") * F.col("_total") / F.col("size")).alias("rate"))


def with_cdf(stats: DataFrame) -> DataFrame:
    """Adds ``parts`` and ``cdf``: the distribution of one part up to where what
    is left is below 2**-52, the step of the uniform numbers."""
    stats = stats.withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int"))
    stats = stats.withColumn("_r", F.col("rate") / F.col("parts"))
    last = F.ceil(F.col("_r") + 12 * F.sqrt("_r") + 40).cast("int")
    first = F.exp(-F.col("_r"))
    init = F.struct(first.alias("p"), F.array(first).alias("out"))

    def step(acc, k):
        p = acc["p"] * F.col("_r") / k
        return F.struct(p.alias("p"), F.concat(acc["out"], F.array(F.element_at(acc["out"], -1) + p)).alias("out"))

    return stats.withColumn("cdf", F.aggregate(F.sequence(F.lit(1), last), init, step, lambda a: a["out"])).drop("_r")


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: dict[str, float] | None = None, temperature: float = 0.5, seed: str = SEED) -> DataFrame:
    """The columns of ``df`` plus ``copy_no`` (from 0) and ``shuffle_key``, in shuffled order.

    ``weights`` maps sources to target weights; without it they are the
    tempered sizes. The table of sources is joined by :func:`attach`, so a
    source with a third of all rows is no hot task.
    """
    src = F.when(F.col(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    size = F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint") + 1
    sizes = df.select(src.alias("src"), size.alias("size")).groupBy("src").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("size"))
    stats = materialise(with_cdf(rates(sizes, weights, temperature)), "mix-rates")
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    cols = [c for c in df.columns if c not in ("copy_no", "shuffle_key")]
    rows = df.select(F.struct(*[F.col(c) for c in cols]).alias("_row"), src.alias("src"), name.alias("_id"))
    rows = attach(rows, stats, "src", "n_rows", F.xxhash64("_id"))
    count = F.aggregate(F.sequence(F.lit(0), F.col("parts") - 1), F.lit(0), lambda acc, j: acc + F.size(
        F.filter("cdf", lambda c: c <= uniform(seed, j, F.col("_id")))))
    rows = rows.withColumn("_n", count).filter(F.col("_n") > 0)
    rows = rows.select("_row", "_id", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("copy_no"))
    rows = rows.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(seed + "-order"), F.col("copy_no").cast("string"), F.col("_id")).cast("binary")))
    out = rows.repartition(F.col("shuffle_key"), F.xxhash64("_row")).sortWithinPartitions("shuffle_key")
    return out.select(*[F.col("_row")[c].alias(c) for c in cols], "copy_no", "shuffle_key")


#: DuckDB text of :func:`mix` with the default parameters, over ``documents``.
SQL = f"""
WITH RECURSIVE d AS (SELECT *, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS src,
    coalesce(doc_id::VARCHAR, 'null') AS did FROM documents),
s AS (SELECT src, sum(length(coalesce(text, ''))::BIGINT + 1) AS size FROM d GROUP BY src),
t AS (SELECT sum(size)::DOUBLE AS total, sum(sqrt(size::DOUBLE)) AS w FROM s),
r AS (SELECT src, sqrt(size::DOUBLE) / w * total / size AS rate FROM s, t),
q AS (SELECT src, greatest(ceil(rate / {PART}), 1)::INT AS parts, rate / greatest(ceil(rate / {PART}), 1) AS r FROM r),
c AS (SELECT src, parts, r, 0 AS k, exp(-r) AS p, exp(-r) AS cdf FROM q
    UNION ALL SELECT src, parts, r, k + 1, p * r / (k + 1), cdf + p * r / (k + 1) FROM c
    WHERE k < ceil(r + 12 * sqrt(r) + 40)),
u AS (SELECT d.*, j, ('0x' || substr(md5('{SEED}:' || j || ':' || did), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
    FROM d JOIN q USING (src), LATERAL (SELECT unnest(range(parts)) AS j)),
n AS (SELECT did, src, sum(m) AS n FROM (SELECT did, src, j, (SELECT count(*) FROM c WHERE c.src = u.src AND cdf <= u.u) AS m
    FROM (SELECT DISTINCT did, src, j, u FROM u) u) GROUP BY did, src)
SELECT doc_id, text, lang, source, n_chars, copy_no::INT AS copy_no,
    md5('{SEED}-order:' || copy_no || ':' || did) AS shuffle_key
FROM (SELECT d.*, unnest(range(n::BIGINT)) AS copy_no FROM d JOIN n USING (did, src))
"""

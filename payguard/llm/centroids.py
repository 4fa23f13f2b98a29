"""Centroid clustering in whole numbers, nearest centroids found by Orchard search.

Every component x of a vector becomes floor(SCALE * x). The first centroids are
the vectors with the smallest hashes of their ids. A round assigns each vector
to its nearest centroid (squared distance; ties to the smaller number) and
replaces every centroid that has vectors by their componentwise floored mean.

Orchard search: each centroid has a list of the others, nearest first. A vector
walks the list of its best centroid so far; when it meets a closer one it jumps
to that one's list; centroids it has met are marked and not measured again. It
stops at the first entry strictly farther from its centroid than twice its own
distance, or at the list's end: by the triangle inequality nothing behind that
entry is as near. All of it is exact 64-bit arithmetic, so ties are ties.

Vectors are read once, kept as whole numbers in a table, and never leave their
tasks: a round sends one row of sums for each cluster and task. The centroids
(a parameter's number of rows) are all that the driver holds and broadcasts.

Defined cases: a vector that is null, of another length, or holds null or
non-finite numbers takes no part; a null id counts as the empty text in the
hash; rows with the same id all count (equal hashes: smaller components first);
fewer vectors than centroids give fewer centroids; an empty table gives an
empty table. A component beyond +-2**26 after scaling is an error, because its
distances wouldn't fit 64 bits exactly. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from payguard.llm.common import materialise

DIM, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
#: Largest component for which every squared distance fits a signed 64-bit number.
LARGEST = 2 ** 26
#: Vectors measured together.
BLOCK = 8192


def whole(column, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, matrix) of the vectors of an Arrow list column that take part."""
    import pyarrow as pa
    import pyarrow.compute as pc
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False)
    rows = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    flat = pc.cast(column.take(pa.array(rows)).flatten(), pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)  # null becomes NaN
    good = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        x = np.floor(scale * x[good])
    if (np.abs(x) > LARGEST).any():
        raise ValueError(f"a scaled component is beyond +-{LARGEST}: its distances don't fit 64 bits")
    return rows[good], x.astype(np.int64)


def kept(df: DataFrame, vec_id: str, vec: str, dim: int, scale: int) -> DataFrame:
    """``vec_id, c``: the vectors that take part, in whole numbers."""
    kind = df.schema[vec].dataType.elementType
    col = F.col(vec) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(vec).cast("array<double>")
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("c", T.ArrayType(T.IntegerType()))])

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            rows, x = whole(batch.column(1), dim, scale)
            ends = np.arange(0, dim * (len(rows) + 1), dim, dtype=np.int32)
            c = pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), c], names=["vec_id", "c"])

    return df.select(F.col(vec_id).cast("bigint").alias("vec_id"), col.alias("vec")).mapInArrow(run, schema)


def lists(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances between centroids, and each one's list of the others, nearest first."""
    gaps = ((c[:, None] - c[None]) ** 2).sum(axis=2)
    order = np.argsort(gaps, axis=1, kind="stable")
    others = [row[row != k] for k, row in enumerate(order)]
    return gaps, np.array(others, dtype=np.int64).reshape(len(c), len(c) - 1)


def orchard(x: np.ndarray, c: np.ndarray, gaps: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and squared distance of each row of ``x``, and how many distances were measured."""
    n = len(x)
    best, at = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    dist = ((x - c[0]) ** 2).sum(axis=1)
    met = np.zeros((n, len(c)), dtype=bool)
    met[:, 0] = True
    measured = n
    open_ = np.arange(n) if others.shape[1] else np.arange(0)
    while len(open_):
        k = best[open_]
        next_ = others[k, at[open_]]
        near = gaps[k, next_] <= 4 * dist[open_]  # squared: beyond twice the distance ends the walk
        open_, next_ = open_[near], next_[near]
        at[open_] += 1
        fresh = ~met[open_, next_]
        r, k = open_[fresh], next_[fresh]
        met[r, k] = True
        d = ((x[r] - c[k]) ** 2).sum(axis=1)
        measured += len(r)
        closer = (d < dist[r]) | ((d == dist[r]) & (k < best[r]))
        r, k, d = r[closer], k[closer], d[closer]
        best[r], dist[r], at[r] = k, d, 0
        open_ = open_[at[open_] < others.shape[1]]
    return best, dist, measured


def matrix(column, dim: int) -> np.ndarray:
    """The whole-number matrix of an Arrow list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def assigned(vectors: DataFrame, c: np.ndarray, dim: int) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    index = vectors.sparkSession.sparkContext.broadcast((c, *lists(c)))  # len(c) rows
    schema = "vec_id bigint, cluster int, distance bigint"

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                best, dist, _ = orchard(matrix(part.column(1), dim), *index.value)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best.astype(np.int32)), pa.array(dist)], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, schema)


def sums(vectors: DataFrame, c: np.ndarray, dim: int) -> dict[int, tuple[int, list[int]]]:
    """Number and componentwise sum of each cluster's vectors (exact; one row a cluster and task is shuffled)."""
    index = vectors.sparkSession.sparkContext.broadcast((c, *lists(c)))

    def run(batches):
        import pyarrow as pa
        count, total = np.zeros(len(c), dtype=np.int64), np.zeros((len(c), dim), dtype=np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                x = matrix(batch.slice(i, BLOCK).column(1), dim)
                best = orchard(x, *index.value)[0]
                count += np.bincount(best, minlength=len(c))
                np.add.at(total, best, x)
        used = np.flatnonzero(count)
        ends = np.arange(0, dim * (len(used) + 1), dim, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used]), pa.ListArray.from_arrays(ends, pa.array(total[used].ravel()))],
                                         names=["cluster", "n", "total"])

    parts = vectors.mapInArrow(run, "cluster int, n bigint, total array<bigint>").select("cluster", "n", F.posexplode("total").alias("at", "part"))
    rows = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(rows, key=lambda r: (r["cluster"], r["at"])):
        out.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["total"]))
    return out


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of ``<seed>:<vec_id>``, in the order of those hashes."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "c").orderBy("key", "c").limit(clusters).collect()
    return np.array([r["c"] for r in rows], dtype=np.int64)


def fingerprint(centroid) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


FINAL = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def fit(vectors: DataFrame, clusters: int, rounds: int, dim: int, seed: int) -> np.ndarray:
    """The centroids after ``rounds`` rounds over the table of :func:`kept` vectors."""
    c = first_centroids(vectors, clusters, seed)
    for _ in range(rounds if len(c) else 0):
        c = c.copy()
        for k, (n, total) in sums(vectors, c, dim).items():
            c[k] = [t // n for t in total]
    return c


def cluster(df: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM,
            scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """Every vector that takes part with its cluster, squared distance, its cluster's and the
    whole sum of them, and the hash of its centroid's components."""
    spark = df.sparkSession
    vectors = materialise(kept(df, vec_id, vec, dim, scale), "centroid-vectors")
    c = fit(vectors, clusters, rounds, dim, seed)
    if not len(c):
        return spark.createDataFrame([], FINAL)
    found = materialise(assigned(vectors, c, dim), "centroid-assigned")
    inertia = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    rows = [(k, d, sum(inertia.values()), fingerprint(c[k])) for k, d in inertia.items()]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(*[f.split()[0] for f in FINAL.split(", ")])  # at most ``clusters`` rows


def _sql() -> str:
    """The same in DuckDB: the rounds written out."""
    gap = f"list_sum(list_transform(range(1, {DIM + 1}), lambda i: (v.c[i] - m.c[i]) * (v.c[i] - m.c[i])))"
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM})""",
             f"""m0 AS MATERIALIZED (SELECT k, c FROM (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), c) - 1 AS k, c FROM v) q
  WHERE k < {CLUSTERS})"""]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT rid, arg_min(k, (d, k)) AS k, CAST(min(d) AS BIGINT) AS d
  FROM (SELECT v.rid, m.k, {gap} AS d FROM v CROSS JOIN m{r} m) q GROUP BY rid)""")
        if r < ROUNDS:
            parts.append(f"""m{r + 1} AS MATERIALIZED (SELECT m.k, coalesce(n.c, m.c) AS c FROM m{r} m LEFT JOIN (
  SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
  FROM (SELECT a.k, t.i, sum(v.c[t.i]) AS s, count(*) AS n FROM a{r} a JOIN v ON v.rid = a.rid CROSS JOIN range(1, {DIM + 1}) AS t(i) GROUP BY a.k, t.i) q GROUP BY k) n ON n.k = m.k)""")
    return f"""WITH {", ".join(parts)}
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(m.c, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN v ON v.rid = a.rid JOIN m{ROUNDS} m ON m.k = a.k"""


SQL = _sql()

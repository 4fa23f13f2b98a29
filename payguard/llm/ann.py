"""Approximate nearest neighbours with balanced posting lists.

Equal vectors are one point. Balanced bisection of a bounded sample of points
gives leaves of equal size, whose means are the centroids; a neighbour graph
over the centroids, small enough for memory, is searched best first. Every
point goes to the list of its nearest centroid, and points near a boundary to
further lists as well. A query reads the lists whose centroid is within a
ratio of the nearest one's distance. The lists that a query reads are scored
exactly on the original vectors in double precision.

Distances are Euclidean in a space with one more coordinate, in which the
nearest point is the one with the largest inner product.

Lists are cut into blocks (and the queries of a list too), so a list of any
size is several tasks' work; nothing is left out.

Defined cases: a null id or a vector that is null, empty, zero or holds null or
non-finite numbers takes no part, nor does one whose length isn't the most
frequent length (of equally frequent ones the largest); of rows with the same
id the smallest vector counts; ties go to the smaller id; an empty table gives
an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from payguard.llm.common import attach, materialise

NEAREST = 20
EVERY = 20
#: Points of a list on average, and of a block of a list at most (about).
LIST = 256
BLOCK = 1024
QUERY_BLOCK = 1024
#: Bounds of what is on the driver and in the broadcast: sampled points, their bytes, and centroids.
SAMPLE = 16_384
SAMPLE_BYTES = 64_000_000
MAX_LISTS = 4096
#: Graph degree and width of its search.
DEGREE, WIDTH = 24, 64
#: A boundary point is in up to COPIES lists, those within COPY_RATIO of its nearest centroid.
COPIES, COPY_RATIO = 4, 1.06
#: A query reads the lists within READ_RATIO of its nearest centroid, at least READ_LEAST of them.
READ_RATIO, READ_LEAST = 1.35, 16
SEED = 7


def bisect(x: np.ndarray, leaves: int) -> np.ndarray:
    """Means of ``leaves`` (a power of two) groups of equal size: every group is cut at
    the median of its projection on the line between two far centres."""
    rng, groups = np.random.default_rng(SEED), [np.arange(len(x))]
    while len(groups) < leaves:
        new = []
        for g in groups:
            p = x[g]
            a = p[rng.integers(len(p))]
            a = p[np.argmax(((p - a) ** 2).sum(1))]
            b = p[np.argmax(((p - a) ** 2).sum(1))]
            for _ in range(4):
                near = ((p - a) ** 2).sum(1) <= ((p - b) ** 2).sum(1)
                if near.all() or not near.any():
                    break
                a, b = p[near].mean(0), p[~near].mean(0)
            order = np.argsort(p @ (a - b), kind="stable")
            half = len(g) // 2
            new += [g[order[:half]], g[order[half:]]]
        groups = new
    return np.array([x[g].mean(0) for g in groups if len(g)])


def graph(c: np.ndarray) -> np.ndarray:
    """For each centroid its DEGREE nearest ones and a few fixed random ones, which connect the graph."""
    n, rng = len(c), np.random.default_rng(SEED)
    out = []
    for i in range(0, n, 512):
        d = ((c[i:i + 512] ** 2).sum(1)[:, None] + (c ** 2).sum(1)[None] - 2 * c[i:i + 512] @ c.T)
        out.append(np.argsort(d, axis=1, kind="stable")[:, 1:DEGREE + 1])
    near = np.vstack(out) if n > 1 else np.zeros((1, 1), dtype=int)
    return np.hstack([near, (np.arange(n)[:, None] + 1) % n, rng.integers(0, n, (n, 3))])


def search(x: np.ndarray, c: np.ndarray, links: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of the graph for all rows of ``x`` together: ids and squared
    distances of the ``width`` nearest centroids found, nearest first."""
    rows, n = np.arange(len(x)), len(c)
    width = min(width, n)
    cc, xx = (c ** 2).sum(1), (x ** 2).sum(1)
    starts = np.unique(np.linspace(0, n - 1, num=min(n, 16)).astype(int))
    ids = np.tile(starts, (len(x), 1))
    dist = xx[:, None] + cc[starts][None] - 2 * x @ c[starts].T
    seen = np.zeros((len(x), n), dtype=bool)
    seen[:, starts] = True
    done = np.zeros(ids.shape, dtype=bool)
    while True:
        open_ = np.where(done, np.inf, dist)
        at = open_.argmin(1)
        go = np.isfinite(open_[rows, at])
        if not go.any():
            break
        r = rows[go]
        done[r, at[go]] = True
        nb = links[ids[r, at[go]]]
        fresh = ~seen[r[:, None], nb]
        seen[r[:, None], nb] = True
        d = xx[r, None] + cc[nb] - 2 * np.einsum("rd,rkd->rk", x[r], c[nb])
        # A neighbour listed twice in one row counts once.
        order = np.argsort(nb, axis=1, kind="stable")
        twice = np.zeros(nb.shape, dtype=bool)
        srt = np.take_along_axis(nb, order, 1)
        np.put_along_axis(twice, order[:, 1:], srt[:, 1:] == srt[:, :-1], 1)
        add_d = np.full((len(x), nb.shape[1]), np.inf)
        add_i = np.zeros((len(x), nb.shape[1]), dtype=ids.dtype)
        add_d[r], add_i[r] = np.where(fresh & ~twice, d, np.inf), nb
        dist, ids = np.hstack([dist, add_d]), np.hstack([ids, add_i])
        done = np.hstack([done, ~np.isfinite(add_d)])
        keep = np.argsort(dist, axis=1, kind="stable")[:, :width]
        dist, ids, done = (np.take_along_axis(v, keep, 1) for v in (dist, ids, done))
    return ids, np.maximum(dist, 0)


def matrix(column, dim: int) -> np.ndarray:
    """The double-precision matrix of an Arrow list column without nulls."""
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def lifted(x: np.ndarray, limit: float) -> np.ndarray:
    """Points with the coordinate that gives all of them the norm ``limit``."""
    return np.hstack([x, np.sqrt(np.maximum(limit ** 2 - (x ** 2).sum(1), 0))[:, None]])


def aimed(q: np.ndarray, limit: float) -> np.ndarray:
    """Queries scaled to the norm ``limit``, with 0 as the new coordinate."""
    q = q * (limit / np.sqrt((q ** 2).sum(1)))[:, None]
    return np.hstack([q, np.zeros((len(q), 1))])


def chosen(ids: np.ndarray, dist: np.ndarray, ratio: float, least: int, most: int):
    """Row numbers and ids of the lists within the ratio."""
    d = np.sqrt(dist)
    take = (d <= ratio * d[:, :1] + 1e-12) & np.isfinite(d)
    take[:, :least] |= np.isfinite(d[:, :least])
    take[:, most:] = False
    r, k = np.nonzero(take)
    return r, ids[r, k]


def listed(df: DataFrame, index, dim: int, limit: float, query: bool) -> DataFrame:
    """``point, vec, list``: a row for each list that the point is in, or that the query reads."""
    schema = T.StructType([T.StructField("point", T.LongType()), T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("list", T.IntegerType())])

    def run(batches):
        import pyarrow as pa
        c, links = index.value
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                x = matrix(part.column(1), dim)
                ids, dist = search(aimed(x, limit) if query else lifted(x, limit), c, links, WIDTH)
                r, k = chosen(ids, dist, READ_RATIO, READ_LEAST, WIDTH) if query else chosen(ids, dist, COPY_RATIO, 1, COPIES)
                vec = pa.ListArray.from_arrays(np.arange(0, dim * (len(r) + 1), dim, dtype=np.int32), pa.array(x[r].ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(r)), vec, pa.array(k.astype(np.int32))], names=["point", "vec", "list"])

    return df.select("point", F.col("vec").cast("array<double>").alias("vec")).mapInArrow(run, schema)


def scored(lists: DataFrame, reads: DataFrame, dim: int, keep: int) -> DataFrame:
    """Per block of a list and of its queries: the ``keep`` nearest points of each query."""
    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("point", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(points, queries):
        import pyarrow as pa
        out = []
        if points.num_rows and queries.num_rows:
            v, q = matrix(points.column("vec"), dim), matrix(queries.column("vec"), dim)
            pid, qid = (t.column("point").to_numpy() for t in (points, queries))
            for i in range(0, len(q), 256):
                s = q[i:i + 256] @ v.T
                least = np.partition(s, -min(keep, len(v)), axis=1)[:, -min(keep, len(v))]
                r, k = np.nonzero(s >= (least - 1e-9 * np.maximum(np.abs(least), 1e-30))[:, None])
                exact = (q[i + r] * v[k]).sum(1)  # the same sum wherever the pair meets
                order = np.lexsort((pid[k], -exact, r))
                r, k, exact = r[order], k[order], exact[order]
                first = np.searchsorted(r, np.arange(len(s)))
                top = np.arange(len(r)) - first[r] < keep
                out.append((qid[i + r[top]], pid[k[top]], exact[top]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query", "point", "score"), cols)))

    by = ["list", "block", "qblock"]
    return lists.groupBy(*by).cogroup(reads.groupBy(*by)).applyInArrow(run, schema)


def usable(df: DataFrame, vec_id: str, vec: str) -> DataFrame:
    """``vec_id, vec, key`` of the rows that take part, once per id."""
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vec).alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull()
        & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0))
    common = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return rows.withColumn("key", F.lit("")), 0
    rows = rows.filter(F.size("vec") == common["dim"]).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    # +0.0 makes one zero of both; two hashes of 64 bits name the vector.
    rows = rows.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0).cast("float")))
    key = F.concat_ws("-", F.hex(F.xxhash64("vec")), F.hex(F.xxhash64(F.lit(1), "vec")))
    return materialise(rows.withColumn("key", key), "ann-rows"), common["dim"]


def neighbours(df: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", every: int = EVERY, nearest: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row whose id is divisible by
    ``every`` the ``nearest`` other rows with the largest inner product."""
    spark = df.sparkSession
    rows, dim = usable(df, vec_id, vec)
    final = "query_id bigint, rank int, vec_id bigint, score double"
    if not dim:
        return spark.createDataFrame([], final)
    points = materialise(rows.groupBy("key").agg(F.min("vec_id").alias("point"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("n")), "ann-points")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    stats = points.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("limit")).first()
    total, limit = stats["n"], stats["limit"]

    size = int(min(SAMPLE, max(SAMPLE_BYTES // (8 * dim), 1)))
    sample = points.orderBy(F.xxhash64("key"), "key").limit(size).select("vec").collect()
    x = lifted(np.array([r["vec"] for r in sample], dtype=np.float64), limit)
    leaves = 1
    while leaves * LIST < total and leaves * 2 <= min(MAX_LISTS, max(len(x) // 4, 1)):
        leaves *= 2
    c = bisect(x, leaves)
    index = spark.sparkContext.broadcast((c, graph(c)))  # at most MAX_LISTS centroids and their links

    lists = materialise(listed(points, index, dim, limit, False), "ann-lists")
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    asked_points = points.join(asked.select("key").distinct(), "key", "left_semi")
    reads = materialise(listed(asked_points, index, dim, limit, True), "ann-reads")
    # Blocks of each list and of its queries: a table with at most MAX_LISTS rows.
    blocks = lists.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nb"))
    qblocks = reads.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("nq"))
    both = F.broadcast(materialise(blocks.join(qblocks, "list"), "ann-blocks"))
    own = lambda n: F.pmod(F.xxhash64("point"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = lists.join(both, "list").select("point", "vec", "list", own("nb").alias("block"), each("nq").alias("qblock"))
    right = reads.join(both, "list").select("point", "vec", "list", own("nq").alias("qblock"), each("nb").alias("block"))
    keep = nearest + 1  # the query itself is among them
    found = scored(left, right, dim, keep).distinct()
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "point"))).filter(F.col("r") <= keep)
    best = materialise(best.select("query", "point", "score"), "ann-best")

    # The smallest ids of each point's rows, in two steps, so a vector in a third of all rows is dealt out.
    ids = materialise(attach(rows.select("vec_id", "key"), points.select("key", "point", "n"), "key", "n", F.xxhash64("vec_id")).select(
        "vec_id", "point"), "ann-ids")
    salted = ids.withColumn("s", F.pmod(F.xxhash64("vec_id"), F.lit(32)))
    for by in (["point", "s"], ["point"]):
        salted = salted.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))).filter(F.col("r") <= keep)
    members = salted.groupBy("point").agg(F.collect_list("vec_id").alias("ids"))  # at most ``keep`` each
    wide = best.join(members, "point").select("query", "score", F.explode("ids").alias("vec_id"))
    wide = wide.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") <= keep)
    top = wide.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("top"))
    askers = ids.filter(F.pmod("vec_id", F.lit(every)) == 0).withColumnRenamed("vec_id", "query_id").withColumnRenamed("point", "query")
    counted = askers.groupBy("query").agg(F.count(F.lit(1)).alias("rows"))
    top = materialise(top.join(counted, "query"), "ann-top")
    out = attach(askers, top, "query", "rows", F.xxhash64("query_id")).filter(F.col("top").isNotNull())
    out = out.withColumn("top", F.slice(F.filter("top", lambda t: t["vec_id"] != F.col("query_id")), 1, nearest))
    out = out.select("query_id", F.posexplode("top").alias("at", "t"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score"))

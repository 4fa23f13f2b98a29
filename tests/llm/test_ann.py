import numpy as np
import pytest

from llm.helpers import SMOKE, empty
from payguard.llm import ann
from payguard.llm.queries import op7_ann

SCHEMA = "vec_id bigint, embedding array<float>"


def exact(ids, x, every=20, nearest=20):
    x = np.array(x, dtype=np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = (x * x[i]).sum(1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:nearest]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, x = np.array([r[0] for r in rows]), [r[1] for r in rows]
    want, got = exact(ids, x), lists(op7_ann(spark, "/root/testdata/sf0.1"))
    hits = sum(len({v for v, _ in want[q]} & {v for v, _ in got.get(q, [])}) for q in want)
    assert hits / (20 * len(want)) >= 0.9


def test_many_lists_keep_the_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 8)
    rows = spark.read.parquet(f"{SMOKE}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), [r[1] for r in rows]
    want, got = exact(ids, x), lists(op7_ann(spark, SMOKE))
    hits = sum(len({v for v, _ in want[q]} & {v for v, _ in got.get(q, [])}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_copies_and_ties_are_exact(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-2, 3, (300, 4)).astype(float)
    x[:100] = x[0] = [1, 2, 0, -1]  # a third of all rows
    x[~x.any(1)] = 1
    ids = np.arange(300)
    got = lists(ann.neighbours(spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SCHEMA)))
    assert got == exact(ids, x)


def test_awkward_rows(spark):
    bad = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0])]
    good = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (21, [-1.0, 0.0])]
    got = lists(ann.neighbours(spark.createDataFrame(bad + good, SCHEMA)))
    assert got == {0: [(20, 0.5), (21, -1.0)], 20: [(0, 0.5), (21, -0.5)]}
    assert ann.neighbours(spark.createDataFrame(bad[:6], SCHEMA)).count() == 0
    none = ann.neighbours(empty(spark, spark.createDataFrame(good, SCHEMA)))
    assert none.count() == 0 and none.columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("n", [1, 5, 700])
def test_graph_search_finds_the_nearest_centroid(n):
    rng = np.random.default_rng(n)
    c, x = rng.normal(size=(n, 8)), rng.normal(size=(200, 8))
    ids, dist = ann.search(x, c, ann.graph(c), 32)
    true = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (ids[:, 0] == true.argmin(1)).mean() >= 0.97
    assert np.allclose(np.take_along_axis(true, ids, 1), dist)
    assert all(len(set(r.tolist())) == len(r) for r in ids)


def test_leaves_are_balanced():
    x = np.random.default_rng(0).normal(size=(1024, 6))
    assert len(ann.bisect(x, 32)) == 32

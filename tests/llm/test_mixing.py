import math

import duckdb
import pyarrow.parquet as pq

from llm.helpers import SMOKE, awkward_docs, empty, with_clashes
from payguard.llm import mixing
from payguard.llm.queries import op5_poisson_mix


def test_matches_sql(spark):
    got = op5_poisson_mix(spark, SMOKE).select("doc_id", "copy_no", "shuffle_key").orderBy("doc_id", "copy_no").collect()
    con = duckdb.connect()
    con.register("documents", pq.read_table(f"{SMOKE}/documents.parquet"))
    want = con.execute(f"SELECT doc_id, copy_no, shuffle_key FROM ({mixing.SQL}) ORDER BY 1, 2").fetchall()
    assert [tuple(r) for r in got] == want


def test_reaches_target_weights(spark):
    rows = [(i, "x" * 99, "big" if i % 10 else "small") for i in range(20000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r["source"]: r["count"] for r in mixing.mix(docs, weights={"big": 1, "small": 3}).groupBy("source").count().collect()}
    assert abs(got["small"] - 15000) < 5 * math.sqrt(15000) * 3 and abs(got["big"] - 5000) < 5 * math.sqrt(5000)


def test_high_rates_split_into_parts(spark):
    docs = spark.createDataFrame([(i, "x", "rare" if i < 3 else "rest") for i in range(3000)], "doc_id bigint, text string, source string")
    got = mixing.mix(docs, weights={"rare": 1.0}).groupBy("doc_id").count().collect()
    assert len(got) == 3 and all(abs(r["count"] - 1000) < 6 * math.sqrt(1000) for r in got)


def test_inverse_of_the_distribution(spark):
    stats = mixing.with_cdf(spark.createDataFrame([("a", 2.5), ("b", 200.0)], "src string, rate double")).collect()
    for r in stats:
        lam, total = r["rate"] / r["parts"], 0.0
        for k, c in enumerate(r["cdf"]):
            total += math.exp(k * math.log(lam) - lam - math.lgamma(k + 1))
            assert abs(c - total) < 1e-9
        assert 1 - r["cdf"][-1] < 2 ** -50


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    a = mixing.mix(docs).collect()
    assert sorted(map(str, a)) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(empty(spark, docs)).count() == 0
    out = mixing.mix(with_clashes(docs))
    assert out.columns[-2:] == ["copy_no", "shuffle_key"] and out.count() == len(a)

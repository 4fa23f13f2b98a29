import random

import numpy as np
import pytest
import xxhash

from llm.helpers import SMOKE, awkward_docs, empty, with_clashes
from payguard.llm import simhash
from payguard.llm.queries import op4_simhash_near_dedup


def plain_fingerprint(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def classes(ids, prints, bits=3):
    """Component (smallest id) of each row by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    x = np.array(prints, dtype=np.uint64)
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i] ^ x[i + 1:]) <= bits):
            a, b = find(i), find(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    low = {}
    for i, v in enumerate(ids):
        if v is not None:
            low[find(i)] = min(v, low.get(find(i), v))
    return [low.get(find(i)) for i in range(len(x))]


def check(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    want = sorted(zip((str(r["doc_id"]) for r in rows), (f"{p:016x}" for p in prints), map(str, classes([r["doc_id"] for r in rows], prints))))
    got = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in simhash.near_duplicates(docs).collect())
    assert got == want


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    check(spark, docs)
    assert op4_simhash_near_dedup(spark, SMOKE).count() == docs.count()


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F
    r = spark.range(1).select(F.xxhash64(F.lit("a b ç"))).first()[0]
    assert r & (2 ** 64 - 1) == xxhash.xxh64_intdigest("a b ç".encode(), 42)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    check(spark, docs)
    assert simhash.near_duplicates(empty(spark, docs)).count() == 0


@pytest.mark.parametrize("node_max", [4, 100_000])
def test_deep_tries_and_chains(spark, node_max, monkeypatch):
    monkeypatch.setattr(simhash, "NODE_MAX", node_max)
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in prints[:12]:
        for _ in range(10):  # chains that wander off step by step
            p ^= sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 3)))
            p &= 2 ** 64 - 1
            prints.append(p)
    prints += prints[:5]
    signed = [p - 2 ** 64 if p >= 2 ** 63 else p for p in prints]
    rows = simhash.materialise(spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint"), "test-prints")
    got = {r["doc_id"]: r["component_id"] for r in simhash.grouped(rows, "doc_id").collect()}
    assert [got[i] for i in range(len(prints))] == classes(range(len(prints)), prints)


def test_node_links_in_dense_groups():
    rng = np.random.default_rng(2)
    bits = rng.permutation(64)[:10]
    x = np.unique(np.array([int(sum(1 << int(b) for b in bits if rng.random() < 0.5)) for _ in range(2000)], dtype=np.uint64))
    v, c = simhash.node_links(x.view(np.int64), None, 0, 3)
    assert len(v) == len(x) and len(set(c.tolist())) == 1


def test_long_chain_components(spark):
    links = [(i, i - i % 2) for i in range(200)] + [(i, i - (i + 1) % 2) for i in range(1, 200)]
    links += [(c, c) for _, c in links]
    got = simhash.components(spark.createDataFrame(links, "v bigint, c bigint")).collect()
    assert len(got) == len({v for v, _ in links}) and len({r["comp"] for r in got}) == 1


def test_one_row_of_each_component_stays(spark):
    docs = with_clashes(awkward_docs(spark))
    rows = docs.collect()
    comp = classes([r["doc_id"] for r in rows], [plain_fingerprint(r["text"]) for r in rows])
    got = simhash.deduplicated(docs)
    assert got.columns == docs.columns
    kept = got.collect()
    named = [r["doc_id"] for r in kept if r["doc_id"] is not None]
    assert sorted(named) == sorted({c for c in comp if c is not None})
    assert len(kept) - len(named) == 1  # the text of the null id that is like no other
    assert simhash.deduplicated(empty(spark, docs)).count() == 0

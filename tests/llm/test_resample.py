import hashlib
import math
import re
import zlib
from collections import Counter

from payguard.llm import resample

from .helpers import awkward_docs, empty, with_clashes


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(docs, bench):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t = Counter(bucket(f) for x in bench for f in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    rows = []
    for i, text in docs:
        words, fs = features(text)
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    drawn = Counter()
    out = []
    ranks = {}
    for n, r in enumerate(able[:25 * len(able) // 100], 1):
        ranks.setdefault(r, []).append(n)
    for r in rows:
        rank = ranks[r][drawn[r]] if drawn[r] < len(ranks.get(r, [])) else None
        drawn[r] += 1
        out.append((*r[:4], rank))
    return sorted(out, key=str)


def check(spark, docs, bench):
    got = resample.resample(docs, bench)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], [r["text"] for r in bench.select("text").collect()])
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_awkward_documents_as_brute_force(spark):
    bench = spark.createDataFrame([(1, "The of and TOKEN = x"), (2, None), (3, ""), (4, "漢字 ß and the")], "item_id bigint, text string")
    docs = awkward_docs(spark)
    check(spark, with_clashes(docs).repartition(4), bench)
    check(spark, docs, empty(spark, bench))


def test_ties_and_many_copies(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(i % 5 if i % 2 else i, text) for i in range(200)] + [(None, text)] * 5, "doc_id bigint, text string")
    check(spark, docs, docs.limit(3))


def test_empty_table(spark):
    docs = empty(spark, awkward_docs(spark))
    assert resample.resample(docs, docs).count() == 0

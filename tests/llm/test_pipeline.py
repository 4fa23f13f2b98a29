"""Every stage of the pipeline against a plain computation on its own input."""

import re
from collections import defaultdict

import corpus_pipeline
from llm.helpers import SMOKE, awkward_docs, empty, with_clashes
from llm.test_decontaminate import brute
from llm.test_simhash import classes, plain_fingerprint
from payguard.llm import secrets


def test_stages_on_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "decontamination", "secrets", "mixing"]

    def step(name, df):
        out = corpus_pipeline.materialise(stages[name](spark, df, SMOKE), "test-stage")
        return out, out.collect()

    one, rows = step("quality", docs)
    before = docs.count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMOKE}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in rows}
    good = [d for d, v in labels.items() if v == 1]
    bad = [d for d, v in labels.items() if v == 0]
    assert one.columns == columns and sum(d in kept for d in good) >= 0.95 * len(good) and sum(d in kept for d in bad) <= 0.2 * len(bad) < before

    two, after = step("near_dedup", one)
    comp = classes([r["doc_id"] for r in rows], [plain_fingerprint(r["text"]) for r in rows])
    assert two.columns == columns and sorted(r["doc_id"] for r in after) == sorted(set(comp))

    three, clean = step("decontamination", two)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    leaked = {d for d, _ in brute([(r["doc_id"], r["text"]) for r in after], items)}
    assert three.columns == columns and {r["doc_id"] for r in clean} == {r["doc_id"] for r in after} - leaked

    four, masked = step("secrets", three)
    text = {r["doc_id"]: r["text"] for r in clean}
    assert four.columns == columns and {r["doc_id"] for r in masked} == set(text)
    for r in masked:
        found = [m for m in re.finditer(secrets.PATTERNS["assign"], text[r["doc_id"]], re.A) if len(m[2]) >= 6]
        assert (r["text"] == text[r["doc_id"]]) == (not found) and r["n_chars"] == len(r["text"])
        assert not any(len(m[2]) >= 6 for m in re.finditer(secrets.PATTERNS["assign"], r["text"], re.A))

    five, mixed = step("mixing", four)
    copies = defaultdict(list)
    for r in mixed:
        copies[r["doc_id"]].append(r["copy_no"])
    assert set(copies) <= set(text) and all(sorted(c) == list(range(len(c))) for c in copies.values())
    assert 0.7 * len(text) < len(mixed) < 1.4 * len(text)
    assert sorted(map(str, corpus_pipeline.run(spark, SMOKE).collect())) == sorted(map(str, mixed))


def test_stages_on_awkward_tables(spark):
    for docs in (awkward_docs(spark), with_clashes(awkward_docs(spark)), empty(spark, awkward_docs(spark))):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMOKE)
            assert out.columns == docs.columns and out.count() <= docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE).count()

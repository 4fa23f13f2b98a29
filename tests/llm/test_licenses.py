import re

import pytest

from llm.helpers import SMOKE, awkward_docs, empty
from payguard.llm import licenses
from payguard.llm.queries import op3_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_columns_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in op3_license_scan(spark, SMOKE).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))


@pytest.mark.parametrize("text", [
    "MIT License mit license, the mit-license; GNU General\nPublic License", "cc by cc by cc bycc by", "émit license", "mit licenseé", None, "", "9mit license mit",
    "Apache License " * 300])
def test_places(text):
    a = licenses.automaton()
    assert licenses.judge(text, a)[:5] == brute(text)


@pytest.mark.parametrize(("expression", "labels", "grade"), [
    ("mit or gpl-3.0-only", {"mit", "gpl"}, 0), ("mit and gpl-3.0-only", {"mit", "gpl"}, 2),
    ("mit or apache-2.0 and gpl-2.0+", {"mit", "apache", "gpl"}, 0), ("(mit or apache-2.0) and gpl-2.0+", {"mit", "apache", "gpl"}, 2),
    ("gpl-2.0-only with classpath-exception-2.0", {"gpl"}, 1), ("(mit", {"mit"}, 0), ("mit or", {"mit"}, 0), ("x-unknown", {"x-unknown"}, 3)])
def test_expressions(expression, labels, grade):
    assert licenses.evaluate(licenses.TOKEN.findall(expression)) == (frozenset(labels), grade)


def test_tags_and_notices():
    a = licenses.automaton()
    row = dict(zip([f.name for f in licenses.SCHEMA.fields], licenses.judge("// SPDX-License-Identifier: MIT OR (Apache-2.0 AND GPL-3.0-only)\nx", a)))
    assert row["labels"] == "apache,gpl,mit" and row["grade"] == 0 and row["n_base"] == 0 and row["score"] > 0.99
    assert licenses.evaluate([]) is None and licenses.evaluate(["or", ")"]) is None
    assert licenses.judge("MIT License or GNU General Public License", a)[8] == 0


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    texts = docs.select("text").collect()
    got = licenses.scan(docs).collect()
    assert sorted(r["n_words"] for r in got) == sorted(brute(t[0])[0] for t in texts)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert licenses.scan(empty(spark, docs)).count() == 0

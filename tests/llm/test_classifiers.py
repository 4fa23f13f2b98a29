"""Toxicity, language and quality: held-out accuracy on the given labels, and edge cases."""

import pytest

from llm.helpers import awkward_docs, empty
from payguard.llm import langid, quality, toxicity
from payguard.llm.common import crc_mod
from payguard.llm.queries import op6_toxicity, op8_language_id, op9_quality

MID = "/root/testdata/sf0.1"


def held(spark, got, label, truth):
    rows = got.filter("held_out").join(truth, "doc_id").collect()
    return [(r["predicted"], r[label]) for r in rows]


def test_toxicity_held_out(spark):
    got = op6_toxicity(spark, MID)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    pairs = held(spark, got, "toxic", spark.read.parquet(f"{MID}/labels.parquet").select("doc_id", "toxic"))
    caught = [p for p, v in pairs if v == 1]
    alarms = [p for p, v in pairs if v == 0]
    assert sum(caught) / len(caught) >= 0.85 and sum(alarms) / len(alarms) <= 0.04


def test_quality_held_out(spark):
    pairs = held(spark, op9_quality(spark, MID), "quality", spark.read.parquet(f"{MID}/labels.parquet").select("doc_id", "quality"))
    assert sum(p == v for p, v in pairs) / len(pairs) >= 0.98


def test_language_held_out(spark):
    got = op8_language_id(spark, MID).filter("held_out").join(spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) / len(got) >= 0.99


def test_held_out_folds(spark):
    got = langid.identify(awkward_docs(spark)).collect()
    assert all(r["held_out"] == (crc_mod(r["doc_id"], 5) == 0) for r in got)


@pytest.mark.parametrize("near", ["id-iot", "1d1ot", "i d i o t", "i.d.i.o.t", "idiooot"])
def test_gapped_insults(near):
    rows = [(f"du bist ein idiot {i} heute", 1) for i in range(30)] + [(f"du bist ein freund {i} heute", 0) for i in range(60)]
    rows += [("so ein trottel", 1)] * 6 + [("so ein nachbar", 0)] * 6
    model = toxicity.fit(rows)
    reader = toxicity.Reader(toxicity.Kernel(model["marks"]), model["u"])
    worst = [max(v, default=0) for v in reader([f"er ist ein {near}", "er ist ein freund", None])]
    assert worst[0] > 0.2 > worst[1] and worst[2] == 0


GLUED = ["theidiotperson", "youarearealidiot", "theidiotsaidhello", "you,friend,idiot", "a/real-idiot_here", "ixdxixoxt", "heisixdxixoxtok",
         "i x d x i x o x t", "so an id iot he is", "halt mal das maul", "halt,maul"]


@pytest.mark.parametrize("near", GLUED)
def test_glued_gapped_and_many_word_insults(near):
    rows = [(f"du bist ein idiot {i} heute", 1) for i in range(30)] + [(f"du bist ein freund {i} heute", 0) for i in range(60)]
    rows += [(f"halt maul {i}", 1) for i in range(30)] + [(f"halt an {i} wo du willst", 0) for i in range(30)]
    rows += [(f"das maul des pferdes {i}", 0) for i in range(30)]
    model = toxicity.fit(rows)
    assert "^halt$^maul$" in model["marks"] and not {"^halt$", "^maul$"} & set(model["marks"])
    reader = toxicity.Reader(toxicity.Kernel(model["marks"]), model["u"])
    clean = ["er ist ein freund", "halt an und warte", "das maul des pferdes", "halt. das maul"]
    worst = [max(v, default=0) for v in reader([near.replace("halt mal das maul", "nun halt maul du"), *clean])]
    assert worst[0] > 0.2 and worst[0] > max(worst[1:])


def test_sliding_windows_miss_none():
    kernel = toxicity.Kernel(["^idiot$", "^banana$", "^halt$^maul$"])
    text = "^die$^idioten$^xhalt$^maulen$\n^ananas$^bananenidiot$^halt$^mal$"
    for marks in (["^idiot$"], ["^banana$"], ["^halt$^maul$"]):
        own = toxicity.Kernel(marks)
        every = {text[i:i + n] for n, *_ in own.slides for i in range(len(text) - n + 1)}
        near = {w for w, _ in own(sorted(w for w in every if "\n" not in w))}
        assert near and near <= {w for _, w in own.slide(text)} & {w for _, w in kernel.slide(text)}


def test_string_kernel_matches_brute_force():
    def plain(s, t):
        def vec(x):
            out = {}
            for i in range(len(x)):
                for j in range(i + 1, len(x)):
                    for k in range(j + 1, min(len(x), i + toxicity.SPAN + 1)):
                        out[x[i] + x[j] + x[k]] = out.get(x[i] + x[j] + x[k], 0) + toxicity.DECAY ** (k - i - 2)
            return out
        a, b = vec(s), vec(t)
        dot = lambda u, v: sum(w * v.get(k, 0) for k, w in u.items())
        value = dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5
        return value if value >= toxicity.FLOOR else 0

    marks = ["^idiot$", "^banana$", "^loser$"]
    words = ["^idiot$", "^idxiot$", "^bananana$", "^loosers$", "^ident$", "^anan$"]
    got = toxicity.Kernel(marks).matrix(words)
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            assert got[i, j] == pytest.approx(plain(w, m), abs=1e-9)


@pytest.mark.parametrize("classify", [toxicity.classify, quality.classify])
def test_scores_of_awkward_rows(spark, classify):
    docs = awkward_docs(spark)
    label = "toxic" if classify is toxicity.classify else "quality"
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(20)] + [(None, 1), (1, None), (100, 1)], f"doc_id bigint, {label} int")
    got = classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    none = classify(docs, empty(spark, labels)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert classify(empty(spark, docs), labels).count() == 0


def test_languages_of_awkward_rows(spark):
    docs = awkward_docs(spark)
    for r in langid.identify(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert r["lang_pred"] in (("en", "de") if letters else ("und",)) and 0 <= r["score"] <= 1
    assert langid.identify(empty(spark, docs)).count() == 0
    assert langid.predict("abc", langid.fit([])) == ("und", 0.0)
    assert langid.predict("abc", langid.fit([("abc", "en")])) == ("en", 1.0)


def test_quality_filter_keeps_columns(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet").filter("doc_id < 3000")
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    got = quality.filtered(docs, labels)
    good = got.join(labels, "doc_id").groupBy("quality").count().collect()
    assert got.columns == docs.columns
    assert {r["quality"]: r["count"] for r in good}[1] > 0.97 * docs.join(labels.filter("quality = 1"), "doc_id").count()

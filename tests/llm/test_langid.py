import random

from payguard.llm import langid


def test_every_language_is_learned(spark):
    rng = random.Random(1)
    rows = []
    for k in range(80):  # languages of their own words, the last ones the rarest
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 7))) for _ in range(30)]
        rows += [(len(rows) + i, " ".join(rng.choice(words) for _ in range(60)), f"x{k:02d}") for i in range(12 if k < 70 else 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample = langid.training_rows(docs)
    assert {v for _, v in sample} == {f"x{k:02d}" for k in range(80)}
    model = langid.fit(sample)
    assert all(langid.predict(t, model)[0] == v for _, t, v in rows)


def test_sample_is_bounded_by_language(spark, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_DOCS", 5)
    docs = spark.createDataFrame([(i, f"text {i}", "en" if i % 10 else "xx") for i in range(400)], "doc_id bigint, text string, lang string")
    got = [v for _, v in langid.training_rows(docs)]
    assert 3 <= got.count("en") <= 5 and 3 <= got.count("xx") <= 5

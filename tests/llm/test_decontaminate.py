import random
from collections import Counter, defaultdict

from llm.helpers import SMOKE, awkward_docs, empty, sentence, with_clashes
from payguard.llm import decontaminate as dec
from payguard.llm.queries import op10_decontamination


def brute(docs, items):
    """Pairs in which a passage holds the item's shingles and its question's and answer's words."""
    stride = max(dec.STRIDE, max((len(dec.words(t)) for _, t in items), default=0))
    out = set()
    for d, text in docs:
        w = dec.words(text)
        for k in range(max(1, (len(w) - 1) // stride) if w else 0):
            window = w[k * stride:(k + 2) * stride]
            for i, t in items:
                own = dec.words(t)
                if own:
                    n = min(dec.SHINGLE, len(own))
                    have = {tuple(window[j:j + n]) for j in range(len(window) - n + 1)}
                    if len(dec.shingles(own) & have) >= dec.SIMILARITY * len(dec.shingles(own)):
                        q, a = dec.parts(t)
                        share = lambda x: sum(y in window for y in x) / len(x) if x else 1  # noqa: B023, E731
                        if share(q) >= dec.QUESTION and (len(a) < dec.SHINGLE or share(a) >= dec.ANSWER):
                            out.add((d, i))
    return out


def test_given_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    got = op10_decontamination(spark, SMOKE).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute(docs, items) and got


def test_altered_copies(spark):
    rng = random.Random(9)
    items = [(i, " ".join(sentence(rng, rng.randint(3, 14)) for _ in range(rng.randint(1, 5)))) for i in range(120)]
    items += [(200, "The."), (201, "The of and"), (202, None), (203, "..."), (204, items[0][1])]
    docs = []
    for d in range(150):
        body = [sentence(rng) for _ in range(rng.randint(0, 30))]
        if d % 2:
            w = rng.choice(items[:120])[1].split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "changed"
            body.insert(rng.randint(0, len(body)), " ".join(w).upper() if d % 3 else " ".join(w))
        docs.append((d, " ".join(body)))
    got = dec.find(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    want = brute(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)


def test_copies_without_the_last_sentence(spark):
    rng = random.Random(3)
    heads, tails = [sentence(rng, 60) for _ in range(12)], [" ".join(f"only{i}x{k}" for k in range(8)) + "." for i in range(12)]
    docs = spark.createDataFrame([(i, sentence(rng, 30) + " " + h) for i, h in enumerate(heads)], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, f"{h} {t}") for i, (h, t) in enumerate(zip(heads, tails))], "item_id bigint, text string")
    got = dec.find(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(i, i) for i in range(12)]
    assert all(r["answer_overlap"] == 0 and r["question_overlap"] == 1 and 0.8 <= r["overlap"] < 1 for r in got)
    assert dec.clean(docs, items).count() == 0


def test_an_answer_of_its_own_is_asked_for(spark):
    rng = random.Random(3)
    ask, say = sentence(rng, 40), " ".join(f"answer{k}" for k in range(8))
    docs = spark.createDataFrame([(1, ask), (2, f"{ask} {say}")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, ask, say), (2, ask, None)], "item_id bigint, text string, answer string")
    pairs = sorted((r["doc_id"], r["item_id"], r["answer_overlap"]) for r in dec.find(docs, items, item_answer="answer").collect())
    assert pairs == [(1, 2, 1.0), (2, 1, 1.0), (2, 2, 1.0)]
    assert dec.clean(docs, items, item_answer="answer").count() == 0


def test_scores_are_bm25():
    import math
    items = [("1", "alpha beta beta gamma delta eps"), ("2", "alpha zeta eta theta iota kappa lam")]
    (hit,), = dec.Index(items).matches(["x alpha beta beta gamma delta eps y"])
    df = Counter(w for _, t in items for w in set(t.split()))
    avg, tf = 6.5, Counter(items[0][1].split())
    want = sum(math.log(1 + (2 - df[w] + 0.5) / (df[w] + 0.5)) * f * (dec.K1 + 1) / (f + dec.K1 * (1 - dec.B + dec.B * 6 / avg)) for w, f in tf.items())
    assert hit[0] == "1" and abs(hit[1] - want) < 1e-9 and hit[2:] == (1.0, 1.0, 1.0)


def test_several_passes_find_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SMOKE}/benchmark.parquet")
    pairs = lambda: sorted((r["doc_id"], r["item_id"]) for r in dec.find(docs, items).collect())
    one = pairs()
    monkeypatch.setattr(dec, "INDEX_CHARS", 4000)
    assert pairs() == one


def test_block_max_pruning_is_lossless():
    rng = random.Random(4)
    items = [(str(i), sentence(rng, 20)) for i in range(200)]
    index = dec.Index(items)
    texts = [sentence(rng, 40) + " " + items[i][1] for i in range(0, 200, 7)]
    said, passage, term, owner = index.passages(texts)
    got = {(int(p), int(i)) for p, i, _ in zip(*index.search(passage, term, len(owner)))}
    full = defaultdict(float)
    for p, t in zip(passage.tolist(), term.tolist()):
        for k in range(len(index.key)):
            if index.key[k] // index.blocks == t:
                for pos in range(index.start[k], index.start[k + 1]):
                    full[p, int(index.item[pos])] += index.weight[pos]
    assert got == {k for k, v in full.items() if v >= 1 - 1e-9}


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    long = docs.filter("doc_id = 6").first()["text"]
    items = spark.createDataFrame([(1, " ".join(long.split()[9000:9040])), (1, " ".join(long.split()[9000:9040])), (None, None), (2, "")], "item_id bigint, text string")
    assert [(r["doc_id"], r["item_id"]) for r in dec.find(docs, items).collect()] == [(6, 1)]
    clash = with_clashes(docs)
    kept = dec.clean(clash, items)
    assert kept.columns == clash.columns and kept.count() == docs.count() - 1
    assert dec.find(docs, empty(spark, items)).count() == 0 and dec.find(empty(spark, docs), items).count() == 0
    assert dec.clean(docs, empty(spark, items)).count() == docs.count()

"""Benchmark decontamination: an inverted index of the test items, scored by BM25
and searched with block-max WAND; every training passage is a query.

Texts are cut into overlapping passages of two strides, a stride being at least
the longest item, so a copy of an item lies whole in one passage. Each item has
its own threshold: the least score that a passage can have which holds
``SIMILARITY`` of the item's word shingles (all its terms but the dearest few
that so many missing shingles can take away). Weights are divided by it, so
the threshold is 1 for all items and nothing that the check would confirm is
missed.

The search skips as WAND does. An item's terms are sorted by rarity; those
behind the point where the rest can't reach the threshold alone are never
pivots, so only postings of the rare ones nominate blocks of items. A nominated
block is opened if the sum of its block maxima over the passage's terms reaches
the threshold, and its items are kept if their score does. Batches of passages
go through each step together. Last, the item's shingles are checked against
the passage, which confirms an item that has no answer of its own. One that has
(a column of the items) also needs its question's and its answer's words there.
The overlaps of question and answer are reported for all, without an answer
those of the last sentence and of what is before it.

Defined cases: a null or empty text has no matches; items without words match
nothing, items shorter than a shingle are one shingle; repeated items count
once, repeated rows repeat; without items the result is empty.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from payguard.llm.common import map_text

K1, B = 1.2, 0.75
SHINGLE = 5
SIMILARITY = 0.8
#: The least passage stride in words, and the items of a block.
STRIDE = 64
BLOCK = 16
#: Characters of items that are indexed and broadcast at a time; more items take further passes.
INDEX_CHARS = 16_000_000
#: An item with an answer has this share of its question's words in the passage, and of the answer's if it has five words.
QUESTION, ANSWER = 0.8, 0.5
SENTENCE = re.compile(r"(?<=[.!?。？！])\s+")
#: Bytes of lower-cased text to themselves, or to a space where no word goes on.
FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
HIT = T.StructType([T.StructField("item", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("overlap", T.DoubleType()),
                    T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType())])


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(FOLD).split()


def shingles(w: list[bytes]) -> set:
    k = min(SHINGLE, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def parts(text: str | None, answer: str | None = None) -> tuple[list[bytes], list[bytes]]:
    """Question and answer of an item, which confirm it; without an answer column there is none."""
    return words(text), words(answer)


def sentences(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """What comes before the last sentence with words, and that sentence; all and nothing if it is the only one."""
    said = [w for s in SENTENCE.split(text or "") if (w := words(s))]
    return ([x for s in said[:-1] for x in s], said[-1]) if len(said) > 1 else (words(text), [])


class Index:
    """Postings of the items of one pass: (id, text) or (id, text, answer)."""

    def __init__(self, items: list[tuple]):
        kept = [(i, t, w, answer) for i, t, *a in items for answer in [a[0] if a else None] if (w := words(t))]
        kept.sort(key=lambda x: (x[2], str(x[0]), x[3] or ""))  # like items (of one language, say) share blocks
        self.ids = [i for i, *_ in kept]
        self.words = [w for _, _, w, _ in kept]
        self.parts = [(*(parts(t, a) if words(a) else sentences(t)), bool(words(a))) for _, t, _, a in kept]  # and whether the answer is its own
        n, total = len(kept), sum(len(w) for w in self.words)
        df: dict = {}
        for w in self.words:
            for t in set(w):
                df[t] = df.get(t, 0) + 1
        self.vocab = {t: k for k, t in enumerate(sorted(df, key=lambda t: (df[t], t)))}  # rare terms first
        self.stride = max(STRIDE, max(map(len, self.words), default=0))
        self.limit = np.ones(n)
        term, item, weight, pivot = [], [], [], []
        for i, w in enumerate(self.words):
            tf: dict = {}
            for t in w:
                tf[t] = tf.get(t, 0) + 1
            part = {self.vocab[t]: float(np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(w) * n / total)))
                    for t, f in tf.items()}
            lost = int((1 - SIMILARITY) * len(shingles(w)) + 1e-9)
            values = sorted(part.values(), reverse=True)
            spare = sum(values[:lost])
            self.limit[i] = max(sum(values) - spare, 1e-9)
            held = 0.0
            for t in sorted(part):  # pivots: the rarest terms, until the others can't reach the limit
                term.append(t)
                item.append(i)
                weight.append(part[t] / self.limit[i])
                pivot.append(held <= spare + 1e-9)
                held += part[t]
        term, item, weight, pivot = np.array(term, dtype=np.int64), np.array(item, dtype=np.int64), np.array(weight), np.array(pivot, dtype=bool)
        self.blocks = n // BLOCK + 1
        key = term * self.blocks + item // BLOCK
        order = np.lexsort((item, key))
        self.item, self.weight = item[order], weight[order]
        self.key, self.start = np.unique(key[order], return_index=True)
        self.start = np.append(self.start, len(order))
        self.most = np.maximum.reduceat(self.weight, self.start[:-1]) if n else np.zeros(0)
        pk = np.unique(key[pivot])  # (term, block) pairs that nominate
        self.pivot_block = pk % self.blocks
        self.pivot_start = np.searchsorted(pk // self.blocks, np.arange(len(self.vocab) + 1))

    def passages(self, texts: list) -> tuple:
        """Words of each text, and the distinct (passage, term) pairs with the text and the number of each passage."""
        get, size = self.vocab.get, max(len(self.vocab), 1)
        said, keys, owner, first = [], [], [], 0
        for n, t in enumerate(texts):
            w = words(t)
            said.append(w)
            if not w:
                continue
            ids = np.array([get(x, -1) for x in w], dtype=np.int64)
            at = np.flatnonzero(ids >= 0)
            block, count = at // self.stride, max(1, (len(w) - 1) // self.stride)
            low = block < count
            high = block > 0
            keys += [(first + block[low]) * size + ids[at[low]], (first + block[high] - 1) * size + ids[at[high]]]
            owner.append(np.array([[n, k] for k in range(count)], dtype=np.int64).reshape(-1, 2))
            first += count
        key = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        return said, key // size, key % size, np.concatenate(owner) if owner else np.zeros((0, 2), np.int64)

    def search(self, passage: np.ndarray, term: np.ndarray, count: int) -> tuple:
        """(passage, item, score) of all items that reach their threshold."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        n = self.pivot_start[term + 1] - self.pivot_start[term]
        at = np.repeat(np.arange(len(term)), n)
        block = self.pivot_block[self.pivot_start[term[at]] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]
        pairs = np.unique(passage[at] * self.blocks + block)  # nominated (passage, block)
        found = []
        begin = np.searchsorted(passage, np.arange(count + 1))
        for i in range(0, len(pairs), 1 << 15):
            p, b = pairs[i:i + (1 << 15)] // self.blocks, pairs[i:i + (1 << 15)] % self.blocks
            size = begin[p + 1] - begin[p]
            at = np.repeat(np.arange(len(p)), size)
            t = term[begin[p[at]] + np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)]
            want = t * self.blocks + b[at]
            k = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[k] == want
            at, k = at[hit], k[hit]
            open_ = np.bincount(at, weights=self.most[k], minlength=len(p)) >= 1 - 1e-9
            go = open_[at]
            at, k = at[go], k[go]
            size = self.start[k + 1] - self.start[k]
            pos = np.repeat(self.start[k], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            slot = np.repeat(at, size) * BLOCK + self.item[pos] % BLOCK
            slots, where = np.unique(slot, return_inverse=True)
            score = np.bincount(where, weights=self.weight[pos], minlength=len(slots))
            good = score >= 1 - 1e-9
            at, s = slots[good] // BLOCK, slots[good] % BLOCK
            found.append((p[at], b[at] * BLOCK + s, score[good]))
        return tuple(np.concatenate(c) for c in zip(*found)) if found else none

    def check(self, i: int, window: list[bytes], held: set) -> tuple | None:
        """Overlaps of item ``i`` with a passage and its shingles, None if they don't confirm it."""
        own = shingles(self.words[i])
        k = min(SHINGLE, len(self.words[i]))
        have = held if k == SHINGLE else {tuple(window[j:j + k]) for j in range(len(window) - k + 1)}
        overlap = len(own & have) / len(own)
        if overlap < SIMILARITY:
            return None
        there = set(window)
        share = lambda w: sum(x in there for x in w) / len(w) if w else 1.0
        q, a, own_answer = self.parts[i]
        if own_answer and (share(q) < QUESTION or len(a) >= SHINGLE and share(a) < ANSWER):
            return None
        return overlap, share(q), share(a)

    def matches(self, texts: list) -> list:
        """For each text its (item id, score, overlaps), the best passage of each item."""
        said, passage, term, owner = self.passages(texts)
        best: list[dict] = [{} for _ in texts]
        if len(self.key) and len(term):
            memo: tuple = (-1, None, None)
            for p, i, s in zip(*(x.tolist() for x in self.search(passage, term, len(owner)))):
                n, k = owner[p].tolist()
                if memo[0] != p:
                    window = said[n][k * self.stride:(k + 2) * self.stride]
                    memo = (p, window, {tuple(window[j:j + SHINGLE]) for j in range(len(window) - SHINGLE + 1)})
                if got := self.check(i, memo[1], memo[2]):
                    row = (self.ids[i], s * float(self.limit[i]), *got)
                    if i not in best[n] or (row[2], row[1]) > (best[n][i][2], best[n][i][1]):
                        best[n][i] = row
        return [[b[i] for i in sorted(b)] for b in best]


def contaminated(df: DataFrame, items: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 item_answer: str | None = None) -> DataFrame:
    """``keep`` and ``hits``, the confirmed items of each text (empty if none)."""
    spark = df.sparkSession
    bench = items.select(F.col(item_id).cast("string").alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"),
                         (F.col(item_answer).cast("string") if item_answer else F.lit(None).cast("string")).alias("answer")).distinct()
    size = bench.agg(F.sum(F.char_length("text") + F.coalesce(F.char_length("answer"), F.lit(0)))).first()[0] or 0
    passes = int(size // INDEX_CHARS) + 1
    out, hits = df, []
    names = [f"k_{i}" for i in range(len(keep))]
    out = df.select(F.col(text).alias("_t"), *[F.col(c).alias(n) for c, n in zip(keep, names)])
    for p in range(passes):  # an item set within INDEX_CHARS, the usual case, is one pass
        rows = bench.filter(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == p).collect()
        index = spark.sparkContext.broadcast(Index([(r["id"], r["text"], r["answer"]) for r in rows]))

        def make(index=index, p=p):
            return lambda texts: {f"_hits_{p}": [[dict(zip(HIT.names, h)) for h in m] for m in index.value.matches(texts)]}

        out = map_text(out, "_t", ["_t", *names, *hits], T.StructType([T.StructField(f"_hits_{p}", T.ArrayType(HIT))]), make)
        hits.append(f"_hits_{p}")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], F.concat(*hits).alias("hits"))


def find(df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
         item_answer: str | None = None) -> DataFrame:
    """One row per contaminated document and item: ``doc_id, item_id, score, overlap, question_overlap, answer_overlap``."""
    kind = dict(items.dtypes)[item_id]
    out = contaminated(df, items, [doc_id], text, item_id, item_text, item_answer).select(F.col(doc_id).alias("doc_id"), F.explode("hits").alias("h"))
    return out.select("doc_id", F.col("h.item").cast(kind).alias("item_id"), *[f"h.{n}" for n in HIT.names[1:]])


def clean(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          item_answer: str | None = None) -> DataFrame:
    """``df`` without the contaminated documents."""
    cols = df.columns
    names = [f"in_{i}" for i in range(len(cols))]
    plain = df.select(*[F.col(c).alias(n) for c, n in zip(cols, names)])
    found = contaminated(plain, items, names, names[cols.index(text)], item_id, item_text, item_answer)
    return found.filter(F.size("hits") == 0).select(*[F.col(n).alias(c) for c, n in zip(cols, names)])

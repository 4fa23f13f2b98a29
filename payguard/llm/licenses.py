"""Licence scan: an Aho-Corasick automaton finds identifier tags and notice
phrases, a shunting-yard parser evaluates and/or/with licence expressions.

Words are the runs of ASCII letters (lower-cased), digits and non-ASCII
characters. The automaton runs over the words joined by one space, so it finds
phrases whose words stand consecutively.

Defined cases: a null or empty text has no words, no places, empty labels and
score 0; rows are judged one by one, so repeated rows repeat; a broken
expression gives the labels it names and the strictest grade of them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, types as T

from payguard.llm.common import map_text

#: Fixed base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: The method's further notice phrases.
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "boost software license": "bsl",
    "bsd license": "bsd", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "isc license": "isc",
    "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc0": "cc0",
    "creative commons attribution": "cc-by", "creative commons zero": "cc0", "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
#: Identifiers in expressions by their first words; the longest that fits counts.
IDENTIFIERS = {
    "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "apache": "apache", "mit": "mit", "bsd": "bsd", "isc": "isc", "mpl": "mpl",
    "epl": "epl", "bsl": "bsl", "cc0": "cc0", "cc-by": "cc-by", "cc-by-nc": "cc-by-nc", "cc-by-sa": "cc-by-sa",
    "cc-by-nd": "cc-by-nd", "unlicense": "public-domain", "0bsd": "bsd",
}
#: How strict a licence is: 0 permissive, 1 weak copyleft, 2 copyleft, 3 restricted.
GRADES = {"mit": 0, "apache": 0, "bsd": 0, "isc": 0, "bsl": 0, "cc0": 0, "public-domain": 0, "cc-by": 0, "lgpl": 1, "mpl": 1,
          "epl": 1, "gpl": 2, "agpl": 2, "cc-by-sa": 2, "cc-by-nc": 3, "cc-by-nd": 3, "proprietary": 3}
TAG = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)")
TAG_WORDS = "spdx license identifier"
TOKEN = re.compile(r"[()]|[a-z0-9.+-]+")
STRENGTH = {"tag": 0.95, "phrase": 0.7}
#: Words between two notices that may hold the operator which joins them.
JOIN_WORDS = 6
RANK = {"or": 1, "and": 2, "with": 3}
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()),
    ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType()),
    ("expression", T.StringType()), ("grade", T.IntegerType()))])
#: Bytes to their lower-case form, or to a space where no word goes on.
FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def identify(name: str) -> str:
    """The label of an identifier such as ``gpl-3.0-or-later`` (itself if unknown)."""
    parts = name.rstrip("+").split("-")
    for n in range(len(parts), 0, -1):
        if (label := IDENTIFIERS.get("-".join(parts[:n]))) is not None:
            return label
    return name.rstrip("+")


def apply(op: str, a: tuple, b: tuple) -> tuple:
    """One operator on (labels, grade): ``or`` takes the milder side, ``and`` the
    stricter, ``with`` (an exception) one grade off; its right side is no licence."""
    if op == "with":
        return a[0], max(0, a[1] - 1)
    return a[0] | b[0], (min if op == "or" else max)(a[1], b[1])


def evaluate(tokens: list[str]) -> tuple[frozenset, int] | None:
    """Labels and grade of an expression by the shunting-yard method, None if it
    names nothing. Missing operands or brackets are skipped."""
    values: list[tuple] = []
    ops: list[str] = []

    def reduce_top():
        op = ops.pop()
        if op in RANK and len(values) >= 2:
            b, a = values.pop(), values.pop()
            values.append(apply(op, a, b))

    operand = False
    for t in tokens:
        if t in RANK and operand:
            while ops and ops[-1] in RANK and RANK[ops[-1]] >= RANK[t]:
                reduce_top()
            ops.append(t)
            operand = False
        elif t == "(" and not operand:
            ops.append(t)
        elif t == ")" and operand:
            while ops and ops[-1] != "(":
                reduce_top()
            if ops:
                ops.pop()
        elif t not in RANK and t not in "()" and not operand:
            label = identify(t)
            values.append((frozenset([label]), GRADES.get(label, 3)))
            operand = True
    while ops:
        reduce_top()
    if not values:
        return None
    out = values[0]
    for v in values[1:]:
        out = apply("and", out, v)
    return out


def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE}.items():
        a.add_word(f" {phrase} ", (phrase, label))
    a.add_word(f" {TAG_WORDS} ", (TAG_WORDS, None))
    a.make_automaton()
    return a


def judge(text: str | None, a) -> tuple:
    """The columns of SCHEMA for one text."""
    raw = (text or "").encode()
    words = raw.translate(FOLD).split()
    hay = (b" " + b" ".join(words) + b" ").decode("latin-1")
    places, at, index = [], 0, 0
    tagged = False
    hits = sorted((end - len(p) - 1, p, label) for end, (p, label) in a.iter(hay))
    for start, phrase, label in hits:
        index, at = index + hay.count(" ", at, start), start
        if label is None:
            tagged = True
        else:
            places.append((index, phrase, label))
    base = [(i, BASE[p]) for i, p, _ in places if p in BASE]
    # Of phrases that start together the longest counts: "cc by nc" is not also a "cc by" for the expression.
    longest = {}
    for i, p, label in places:
        if i not in longest or len(p) > len(longest[i][0]):
            longest[i] = (p, label)
    tokens, end, by_phrase = [], None, set()
    for i, (p, label) in sorted(longest.items()):
        if end is not None:
            between = words[end:i] if 0 <= i - end <= JOIN_WORDS else []
            tokens.append("or" if b"or" in between else "and")
        tokens.append(label)
        by_phrase.add(label)
        end = max(end or 0, i + p.count(" ") + 1)
    by_tag = set()
    if tagged:
        for m in TAG.finditer(raw.translate(LOWER)):
            got = TOKEN.findall(m[1].decode("utf-8", "replace"))
            if found := evaluate(got):
                by_tag |= found[0]
                tokens += (["and"] if tokens else []) + ["(", *got, ")"]
    value = evaluate(tokens)
    labels = sorted({b for _, b in base} | by_phrase | by_tag)
    miss = 1.0
    for x in labels:
        miss *= 1 - max(STRENGTH["tag"] if x in by_tag else 0, STRENGTH["phrase"] if x in by_phrase or x in {b for _, b in base} else 0)
    return (len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
            ",".join(sorted({b for _, b in base})), ",".join(labels), round(1 - miss, 6),
            " ".join(tokens), value[1] if value else None)


LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def scan(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: the base places and labels, all labels, a score
    (how sure it is that the text carries a licence), and the joined licence
    expression with its grade."""
    names = [f.name for f in SCHEMA.fields]

    def make():
        a = automaton()

        def run(texts):
            rows = [judge(t, a) for t in texts]
            return {n: [r[i] for r in rows] for i, n in enumerate(names)}
        return run

    out = map_text(df, text, [doc_id], SCHEMA, make)
    return out.withColumnRenamed(doc_id, "doc_id")

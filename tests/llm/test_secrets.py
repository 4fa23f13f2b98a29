import hashlib
import re
from collections import defaultdict

import pytest

from llm.helpers import awkward_docs, empty, with_clashes
from payguard.llm import secrets

ACCESS = "AKIA" + "B2C4D6E8F0G2H4J6"
WIDE = "q7-Zx_81mKp0Lw3Rt9Yb5"
COPIED = "zz91_Kd-72hTq4Vn8Ws6Xc3"
TEXTS = [
    (1, f'x password: "abc123" {ACCESS} {WIDE}', "a"), (2, f"token=secret=abcdefgh PASSWD = 12345 {COPIED}", "a"),
    (3, "0123456789abcdef01234567 é😀 api_key='KEY/+=.-_9'", "b"), (4, f"{COPIED} {WIDE}", "b"), (5, f"{COPIED}", "c"),
    (5, f"{COPIED}", "c"), (6, None, "d"), (None, "Secret:zzzzzz", None), (7, "password=short api-key=abcdefgh token =\x20\x20abcdef", "a"),
    (8, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa 12345678901234567890", "z"),
]


def brute(rows, max_owners=2):
    def base(text):
        out = []
        for order, (kind, pattern) in enumerate(secrets.PATTERNS.items()):
            for m in re.finditer(pattern, text, re.A):
                value = m[2] if kind == "assign" else m[0]
                if len(value) >= secrets.MIN_CHARS[kind]:
                    out.append((m.start(), order, m.end(), kind, value))
        return sorted(out)

    owners, found = defaultdict(set), []
    for doc, text, owner in rows:
        b = base(text or "")
        wide = [(m.start(), 3, m.end(), "token", m[0]) for m in re.finditer(secrets.TOKEN, text or "", re.A)
                if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and len(set(m[0])) >= 10]
        wide = [w for w in wide if not any(x[0] < w[2] and w[0] < x[2] for x in b)]
        found.append((doc, b, wide))
        for s in b + wide:
            owners[s[4]].add(owner or "")
    say = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, e, k, _ in sorted(spans))
    count = lambda b, kind: sum(x[3] == kind for x in b)
    return sorted((str(doc), count(b, "assign"), count(b, "access"), count(b, "hex"), hashlib.sha256(say(b).encode()).hexdigest(),
                   say(b + [w for w in wide if len(owners[w[4]]) <= max_owners])) for doc, b, wide in found)


def table(spark):
    return spark.createDataFrame(TEXTS, "doc_id bigint, text string, source string")


def test_matches_brute_force(spark):
    got = sorted((str(r["doc_id"]), *r[1:6]) for r in secrets.scan(table(spark)).collect())
    assert got == brute(TEXTS)
    assert any("token" in r[5] for r in got)  # WIDE has two owners
    assert not any("token" in r[5] for r in got if r[0] == "5")  # COPIED has three


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert sorted((str(r["doc_id"]), *r[1:6]) for r in secrets.scan(docs).collect()) == brute(rows)
    assert secrets.scan(empty(spark, docs)).count() == 0


def test_redact_masks_and_keeps_the_rest(spark):
    docs = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in TEXTS], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = secrets.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    by = defaultdict(list)
    for r in out.collect():
        by[r["doc_id"]].append(r)
    assert by[1][0]["text"] == 'x <secret>" <secret> <secret>' and by[1][0]["n_chars"] == len(by[1][0]["text"])
    assert by[5][0]["text"] == COPIED  # widely copied token strings are no secrets
    assert by[6][0]["text"] is None and by[8][0]["text"] == "<secret> 12345678901234567890"
    copies = spark.createDataFrame([(i, "token=abcdef99", "en", f"s{i}", 14) for i in range(4)], docs.schema)
    assert {r["text"] for r in secrets.redact(copies).collect()} == {"<example-secret>"}


def test_one_owner_and_many_repositories(spark):
    rows = [(i, f"{COPIED} password=copied99", "a") for i in range(12)] + [(20 + i, f"{WIDE} password=few{i}xyz", "a") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    repos = defaultdict(set)
    for d, text, _ in rows:
        for v in (text.split()[0], text.split("=")[1]):
            repos[v].add(d)
    got = {r["doc_id"]: r for r in secrets.scan(docs, max_repos=10).collect()}
    for d, text, _ in rows:
        token, value = text.split()[0], text.split("=")[1]
        live = len(repos[token]) <= 10
        assert ("token" in got[d]["spans"]) == live and (got[d]["n_live"], got[d]["n_example"]) == ((2, 0) if live else (0, 1))
        assert got[d]["n_repos"] == max(len(repos[v]) for v in ((token, value) if live else (value,)))
    masked = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert all(masked[i] == f"{COPIED} <example-secret>" for i in range(12)) and all(masked[20 + i] == "<secret> <secret>" for i in range(10))


def test_redact_with_clashing_columns(spark):
    docs = with_clashes(awkward_docs(spark))
    out = secrets.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


@pytest.mark.parametrize("share", [3])
def test_hot_value(spark, share):
    rows = [(i, "token=samesame1" if i % share == 0 else f"token=value{i:06d}", f"s{i % 7}") for i in range(3000)]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    assert got.filter("n_example = 1").count() == 1000 and got.filter("n_live = 1").count() == 2000


def test_time_grows_with_the_length_of_a_text(spark):
    import time
    took = []
    many, one = f"a café token=abcdef%05d by {WIDE} ", "the bead of a cafe in decade 12ab34 and face "
    for n in (55_000, 110_000):  # about 2.5 and 5 MB, many spans in the first text and one at the end of the second
        texts = [(1, "".join(many % i for i in range(n)), "a", n), (2, one * n + "0123456789abcdef" * 2, "a", n)]
        docs = spark.createDataFrame(texts, "doc_id bigint, text string, source string, n_chars bigint")
        start = time.time()
        got = {r["doc_id"]: r for r in secrets.scan(docs).collect()}
        out = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
        took.append(time.time() - start)
        assert got[1]["n_assign"] == n and got[2]["spans"] == f"hex:{len(one) * n}:{len(one) * n + 32}"
        same = out[1] == "a café <secret> by <secret> " * n, out[2] == one * n + "<secret>"
        assert same == (True, True)
    assert took[1] <= 2.5 * took[0] + 3, took

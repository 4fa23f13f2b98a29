"""Secret scan by corpus-wide ownership frequency. DataFrame functions only.

Candidates are found per row: the three base kinds (``assign``, ``access``,
``hex``), always reported, and ``token``, a wider net of long mixed strings too
noisy to report alone. The hash of every candidate value is counted over the
whole corpus by distinct owners and repositories. A value that more than
``max_owners`` owners or more than ``max_repos`` repositories hold is a widely
copied example; one that is bound to a few of both looks live, and only such
``token`` spans are reported.

Work grows with a text's length, not its square: a match's place is a running
sum over the lengths of matches and gaps, taken by a window over the exploded
matches, and masking cuts a text's bytes at byte positions.

Defined cases: a null text is empty; a null owner is one unknown owner; a null
repository is one repository; repeated rows are reported row by row and count
as one repository; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from payguard.llm.common import attach, materialise

#: Fixed patterns of the base kinds, in the order in which equal starts are listed.
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
#: The same places without the matches that are too short, where that is a matter of the pattern alone.
LONG = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
MIN_CHARS = {"assign": 6, "access": 20, "hex": 24}
#: The method's own kind: long runs that mix letters and digits. The look-behind
#: makes one attempt per run, the look-ahead passes over runs without a digit.
TOKEN = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{20,}"
KINDS = [*PATTERNS, "token"]
#: The most repositories (documents) of a value that looks live.
MAX_REPOS = 10
FOUND = "array<struct<ord:int,i:int,gap:int,gap_bytes:int,len:int,len_bytes:int,value:string>>"
#: What a matching text must hold, as cheap tests before the spans are located.
NEED = {"assign": PATTERNS["assign"], "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}",
        "token": TOKEN}


def located(text: Column, kind: str, pattern: str) -> Column:
    """All leftmost matches, each with the lengths of the gap before it and of itself, in characters and bytes.
    The gaps between the matches (``split``) and the matches alternate."""
    value = {"assign": lambda h: F.regexp_extract(h, pattern, 2)}.get(kind, lambda h: h)
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("h"))
    found = F.transform(pairs, lambda x, i: F.struct(
        F.lit(KINDS.index(kind)).alias("ord"), i.alias("i"), F.char_length(x["g"]).alias("gap"), F.octet_length(x["g"]).alias("gap_bytes"),
        F.char_length(x["h"]).alias("len"), F.octet_length(x["h"]).alias("len_bytes"), value(x["h"]).alias("value")))
    found = F.filter(found, lambda x: x["value"].isNotNull())
    return F.when(text.rlike(NEED[kind]), found.cast(FOUND)).otherwise(F.array().cast(FOUND))


def has_candidate(text: Column) -> Column:
    """Whether the text can hold any candidate at all."""
    test = F.lit(False)
    for need in NEED.values():
        test = test | text.rlike(need)
    return test


def candidates(rows: DataFrame) -> DataFrame:
    """From ``_rid, owner, repo, _found`` one row per span: ``start, end`` (characters), ``from, to`` (bytes),
    ``ord, value``. Too short matches count for the places of the others and then go, and so do wide spans
    that overlap one of a base kind. A window's group is the matches of one text."""
    each = rows.filter(F.size("_found") > 0).select("_rid", "owner", "repo", F.explode("_found").alias("x")).select("_rid", "owner", "repo", "x.*")
    so_far = Window.partitionBy("_rid", "ord").orderBy("i")
    end, to = F.sum(F.col("gap").cast("bigint") + F.col("len")).over(so_far), F.sum(F.col("gap_bytes").cast("bigint") + F.col("len_bytes")).over(so_far)
    each = each.select("_rid", "owner", "repo", "ord", "value", (end - F.col("len")).alias("start"), end.alias("end"),
                       (to - F.col("len_bytes")).alias("from"), to.alias("to"))
    value, base = F.col("value"), F.col("ord") < KINDS.index("token")
    least = F.lit(0)
    for kind, n in MIN_CHARS.items():
        least = F.when(F.col("ord") == KINDS.index(kind), n).otherwise(least)
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 10)
    each = each.filter((base & (F.char_length(value) >= least)) | (~base & mixed))
    here = Window.partitionBy("_rid").orderBy("start", "ord")
    before = F.max(F.when(base, F.col("end"))).over(here.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(here.rowsBetween(1, Window.unboundedFollowing))
    each = each.select("*", before.alias("_b"), after.alias("_a"))
    clear = (F.coalesce("_b", F.lit(0)) <= F.col("start")) & (F.col("_a").isNull() | (F.col("_a") >= F.col("end")))
    return each.filter(base | clear).drop("_a", "_b")


def ownership(cands: DataFrame) -> DataFrame:
    """From (hash, owner, repo): per hash the distinct owners, distinct (owner,
    repo) and rows. Each step combines before its shuffle, so a value in a
    third of all rows is one row per task."""
    per_repo = cands.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    per_owner = per_repo.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("r"), F.sum("n").alias("n"))
    return per_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("r").alias("n_repos"), F.sum("n").alias("n_rows"))


_JUDGED = ("array<struct<start:bigint,ord:int,end:bigint,kind:string,value:string,n_owners:bigint,n_repos:bigint,live:boolean,"
           "from:bigint,to:bigint,before:bigint>>")


def judged(df: DataFrame, text: str, owner: str, repo: str, keep: list[str], max_owners: int = 2, max_repos: int = MAX_REPOS) -> DataFrame:
    """The rows of ``df`` (columns ``keep``) with arrays of judged spans.

    Adds ``n_assign``, ``n_access``, ``n_hex`` (long), ``base`` and ``spans``
    (arrays of ``start, ord, end, kind, value, n_owners, n_repos, live``; ``from, to``
    are bytes and ``before`` the last byte of the spans before), the latter with the
    live-looking token spans as well. The scanned rows are written once, which fixes
    the row numbers they are joined by.
    """
    cols = [F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]
    body = F.coalesce(F.col(text), F.lit(""))
    found = F.concat(*[located(body, kind, LONG.get(kind, PATTERNS.get(kind, TOKEN))) for kind in KINDS])
    rows = df.select(*cols, F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
                     F.coalesce(F.col(repo).cast("string"), F.lit("")).alias("repo"), found.alias("_found"))
    rows = materialise(rows.withColumn("_rid", F.monotonically_increasing_id()), "secret-rows")
    each = materialise(candidates(rows).withColumn("hash", F.sha2(F.col("value").cast("binary"), 256)), "secret-spans")
    freq = materialise(ownership(each.select("hash", "owner", "repo")), "secret-owners")
    spans = attach(each.drop("owner", "repo"), freq, "hash", "n_rows", F.xxhash64("_rid", "start"))
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("ord") + 1)
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    spans = spans.select("*", kind.alias("kind"), live.alias("live")).filter((F.col("kind") != "token") | F.col("live"))
    here = Window.partitionBy("_rid").orderBy("start", "ord").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.max("to").over(here), F.lit(0)))
    struct = F.struct("start", "ord", "end", "kind", "value", "n_owners", "n_repos", "live", "from", "to", "before")
    per_row = spans.groupBy("_rid").agg(F.array_sort(F.collect_list(struct)).alias("_all"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in PATTERNS])
    out = rows.select("_rid", *[f"k_{i}" for i in range(len(keep))]).join(per_row, "_rid", "left")
    out = out.withColumn("_all", F.coalesce("_all", F.array().cast(_JUDGED)))
    return out.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in PATTERNS],
                      F.filter("_all", lambda x: x["kind"] != "token").alias("base"), F.col("_all").alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def scan(df: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: str = "source", max_owners: int = 2,
         max_repos: int = MAX_REPOS) -> DataFrame:
    """One digest row per document. A document is the repository, its source the owner.

    ``spans`` holds the base spans and the live-looking token spans; ``n_live``
    and ``n_example`` count the spans of either verdict, and ``n_repos`` is the
    most repositories that hold a value of ``spans``.
    """
    found = judged(df, text, owner, doc_id, [doc_id], max_owners, max_repos)
    repos = F.coalesce(F.array_max(F.transform("spans", lambda x: x["n_repos"])), F.lit(0)).alias("n_repos")
    return found.select(
        F.col(doc_id).alias("doc_id"), "n_assign", "n_access", "n_hex",
        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: x["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter("spans", lambda x: ~x["live"])).cast("bigint").alias("n_example"), repos)


def masked(body: Column, spans: Column) -> Column:
    """The text (its bytes in ``body``) with every span replaced: ``<secret>`` if live, ``<example-secret>``
    if widely copied. A span that overlaps the one before only extends it."""
    mark = lambda x: F.when(x["live"], F.lit("<secret>")).otherwise(F.lit("<example-secret>"))
    cut = lambda a, n: F.substring(body, (a + 1).cast("int"), n.cast("int")).cast("string")
    firsts = F.filter(spans, lambda x: x["from"] >= x["before"])
    heads = F.transform(firsts, lambda x: F.concat(cut(x["before"], x["from"] - x["before"]), mark(x)))
    end = F.array_max(F.transform(spans, lambda x: x["to"]))
    return F.concat(F.array_join(heads, ""), cut(end, F.octet_length(body)))


def redact(df: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: str = "source", chars: str = "n_chars",
           max_owners: int = 2, max_repos: int = MAX_REPOS) -> DataFrame:
    """``df`` with the secrets in ``text`` masked and ``chars`` (if there is such a
    column) counted again for masked texts. Texts without any candidate, null
    ones included, go through untouched and unshuffled."""
    cols = df.columns
    names = {c: f"in_{i}" for i, c in enumerate(cols)}
    plain = df.select(*[F.col(c).alias(n) for c, n in names.items()])
    body = F.col(names[text])
    test = has_candidate(F.coalesce(body, F.lit("")))
    # The text's bytes are made once for a row, before the rows are joined with their spans.
    asked = plain.filter(test).withColumn("_bytes", F.col(names[text]).cast("binary"))
    found = judged(asked, names[text], names[owner], names[doc_id], [*plain.columns, "_bytes"], max_owners, max_repos)
    found = found.withColumn("_new", F.when(F.size("spans") > 0, masked(F.col("_bytes"), F.col("spans"))).otherwise(body))
    out = {names[text]: F.col("_new")}
    if chars in names:
        held = F.col(names[chars])
        out[names[chars]] = F.when(F.size("spans") > 0, F.char_length("_new")).otherwise(held).cast(plain.schema[names[chars]].dataType)
    found = found.select(*[out.get(n, F.col(n)).alias(n) for n in plain.columns])
    return plain.filter(~test).unionByName(found).toDF(*cols)


def _kind_sql(kind: str) -> str:
    """Places of one kind: (rid, owner, repo, kind, ord, i, hits, gaps)."""
    pattern = PATTERNS.get(kind, "[A-Za-z0-9_-]{20,}").replace("'", "''")
    return (f"SELECT rid, owner, repo, '{kind}' AS kind, {KINDS.index(kind)} AS ord, regexp_extract_all(t, '{pattern}') AS hits, "
            f"string_split_regex(t, '{pattern}') AS gaps FROM d")


#: DuckDB text of :func:`scan` with the default parameters, over ``documents``.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
    coalesce(doc_id::VARCHAR, '') AS repo FROM documents),
m AS ({' UNION ALL '.join(_kind_sql(k) for k in KINDS)}),
p AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
q AS (SELECT rid, owner, repo, kind, ord, hits[i] AS h,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS a FROM p),
v AS (SELECT rid, owner, repo, kind, ord, a::BIGINT AS a, (a + length(h))::BIGINT AS e,
    CASE kind WHEN 'assign' THEN regexp_extract(h, '{PATTERNS['assign'].replace("'", "''")}', 2) ELSE h END AS value FROM q),
b AS (SELECT * FROM v WHERE {' OR '.join(f"kind = '{k}' AND length(value) >= {n}" for k, n in MIN_CHARS.items())}),
w AS (SELECT * FROM v WHERE kind = 'token' AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
    AND len(list_distinct(string_split(value, ''))) >= 10
    AND NOT EXISTS (SELECT 1 FROM b WHERE b.rid = v.rid AND b.a < v.e AND v.a < b.e)),
c AS (SELECT * FROM b UNION ALL SELECT * FROM w),
f AS (SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repo)) AS repos FROM c GROUP BY value),
j AS (SELECT c.*, repos, owners <= 2 AND repos <= {MAX_REPOS} AS live, kind || ':' || a || ':' || e AS span FROM c JOIN f USING (value)),
r AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY a, ord) FILTER (kind <> 'token') AS base,
    string_agg(span, ',' ORDER BY a, ord) FILTER (kind <> 'token' OR live) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live AND kind <> 'token') AS n_example,
    max(repos) FILTER (kind <> 'token' OR live) AS n_repos FROM j GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
    coalesce(n_repos, 0) AS n_repos
FROM d LEFT JOIN r USING (rid)
"""

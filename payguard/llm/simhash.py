"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are the leaves of a binary trie over their bits, highest first.
Pairs of trie nodes are traversed together: a pair carries the number of bits
in which its two prefixes differ, and is dropped as soon as that exceeds the
allowed distance. The upper levels run as Spark joins over the table of nodes
(a node splits until it holds at most ``NODE_MAX`` fingerprints, so a dense
region only makes a deeper trie); the pairs of nodes that are left are
traversed further inside the tasks, over sorted arrays.

A task links only what it needs to know the components: node pairs that are
connected already are dropped too, so a large group of near copies isn't
expanded into all its pairs, yet no link between different groups is lost. The
components of all tasks' links are found by contraction rounds.

Defined cases: a text that is null or has no word has fingerprint zero, linked
like any other; a null id takes part but is nobody's smallest id (a component
of null ids only has component null); rows with equal ids are rows of their
own; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from payguard.llm.common import attach, map_text, materialise

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints of a trie node that isn't split any further.
NODE_MAX = 16_384
#: Bits by which the trie grows from level to level.
STEP = 4
#: Node pairs that a task expands at once, and leaf pairs it compares directly.
CHUNK = 1 << 16
DIRECT = 8
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of the word shingles."""
    import xxhash
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    k = min(shingle, len(words))
    hash_of = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    h = np.fromiter((hash_of(data[a:b], SEED) for a, b in zip(starts[:n].tolist(), (ends[k - 1:] - 1).tolist())), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 14):
        part = np.unpackbits(h[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` and the column ``fp`` (bigint)."""
    def make():
        return lambda texts: {"fp": [fingerprint(t, shingle) for t in texts]}
    return map_text(df, text, keep, T.StructType([T.StructField("fp", T.LongType())]), make)


# --- inside a task ---------------------------------------------------------

class Union:
    """Labels of the fingerprints of one or two nodes, and which ranges have one label."""

    def __init__(self, n: int):
        self.label, self.ends, self.any = np.arange(n), None, False

    def merge(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (up := label[label]) is not None and not np.array_equal(up, label):
                label = up
        self.label, self.any = label, True
        turns = np.append(np.flatnonzero(np.diff(label)) + 1, len(label))
        self.ends = turns[np.searchsorted(turns, np.arange(len(label)), side="right")]

    def one(self, alo, ahi, blo, bhi) -> np.ndarray:
        return (self.ends[alo] >= ahi) & (self.ends[blo] >= bhi) & (self.label[alo] == self.label[blo])


def traverse(x: np.ndarray, start: tuple, depth: int, budget: int, links: Union) -> None:
    """Link what lies within ``budget`` bits under the node pair ``start`` (index
    ranges ``alo, ahi, blo, bhi`` of ``x``, sorted in either range)."""
    zeros = {}

    def split(d, lo, hi):
        if d not in zeros:
            bit = (x >> np.uint64(63 - d)) & np.uint64(1)
            zeros[d] = np.concatenate(([0], np.cumsum(bit == 0)))
        return lo + zeros[d][hi] - zeros[d][lo]

    full = tuple(np.array([v], dtype=np.int64) for v in start)
    first = x[full[0][0]] ^ x[full[2][0]]
    h0 = int(np.bitwise_count(first >> np.uint64(64 - depth))) if depth else 0
    stack = [(depth, *full, np.array([h0], dtype=np.int8))]
    while stack:
        d, alo, ahi, blo, bhi, h = stack.pop()
        if links.any:
            go = ~links.one(alo, ahi, blo, bhi)
            alo, ahi, blo, bhi, h = (v[go] for v in (alo, ahi, blo, bhi, h))
        if not len(alo):
            continue
        size = (ahi - alo) * (bhi - blo)
        leaf = (size <= DIRECT) | (d == 64)
        if leaf.any():
            compare(x, alo[leaf], ahi[leaf], blo[leaf], bhi[leaf], budget, links)
            go = ~leaf
            alo, ahi, blo, bhi, h = (v[go] for v in (alo, ahi, blo, bhi, h))
            if not len(alo):
                continue
        am, bm = split(d, alo, ahi), split(d, blo, bhi)
        parts = []
        for a0, a1, b0, b1, add in ((alo, am, blo, bm, 0), (am, ahi, bm, bhi, 0), (alo, am, bm, bhi, 1), (am, ahi, blo, bm, 1)):
            go = (a1 > a0) & (b1 > b0) & (h + add <= budget) & (a0 <= b0)
            if go.any():
                parts.append((a0[go], a1[go], b0[go], b1[go], (h[go] + add).astype(np.int8)))
        if parts:
            cols = [np.concatenate(c) for c in zip(*parts)]
            for i in range(0, len(cols[0]), CHUNK):
                stack.append((d + 1, *(c[i:i + CHUNK] for c in cols)))


def compare(x, alo, ahi, blo, bhi, budget, links: Union) -> None:
    """Compare the fingerprints of small node pairs directly, in pieces."""
    for s in range(0, len(alo), CHUNK):
        a, b, n = alo[s:s + CHUNK], blo[s:s + CHUNK], (bhi - blo)[s:s + CHUNK]
        size = ((ahi - alo)[s:s + CHUNK]) * n
        at = np.repeat(np.arange(len(a)), size)
        off = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
        i, j = a[at] + off // n[at], b[at] + off % n[at]
        near = (np.bitwise_count(x[i] ^ x[j]) <= budget) & (i != j)
        if near.any():
            links.merge(i[near], j[near])


def node_links(a: np.ndarray, b: np.ndarray | None, depth: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For a node with itself (``b`` None) or two nodes: every fingerprint with
    links, and the smallest one of its component here."""
    a = np.sort(a.view(np.uint64))
    b = None if b is None else np.sort(b.view(np.uint64))
    x = a if b is None else np.concatenate([a, b])
    start = (0, len(a), 0, len(a)) if b is None else (0, len(a), len(a), len(x))
    links = Union(len(x))
    for budget in range(1, max_bits + 1):  # near links first: they connect dense groups, which the wider rounds then skip
        traverse(x, start, depth, budget, links)
    if max_bits < 1 or not links.any:
        return x[:0], x[:0]
    sizes = np.bincount(links.label, minlength=len(x))
    linked = sizes[links.label] > 1
    return x[linked], x[links.label[linked]]


# --- the upper trie in Spark -----------------------------------------------

def mask(depth: int) -> int:
    """A signed 64-bit number with the ``depth`` highest bits set."""
    return 0 if depth == 0 else -(1 << (64 - depth))


def mask_of(depth: Column) -> Column:
    return F.when(depth <= 0, F.lit(0).cast("bigint")).otherwise(
        F.expr("bigint(-1)").bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("bigint"), (64 - depth).cast("int"))))


def self_join(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """From the distinct fingerprints (column ``fp``, a written table): ``v`` and
    ``c``, fingerprints that are linked by a path of links."""
    spark = fps.sparkSession
    n = fps.count()
    depth = 4
    while n > NODE_MAX << depth and depth < 60:
        depth += 2
    levels = list(range(depth % STEP or STEP, depth + 1, STEP))
    pairs = spark.range(1).select(F.lit(0).cast("bigint").alias("p"), F.lit(0).alias("pd"), F.lit(0).cast("bigint").alias("q"), F.lit(0).alias("qd"))
    placed = fps.select("fp", F.lit(0).cast("bigint").alias("node"))
    nodes = spark.range(1).select(F.lit(0).cast("bigint").alias("node"), F.lit(0).alias("depth"), F.lit(n).alias("n"), F.lit(True).alias("split"))
    d = 0
    while True:
        last, d = d, (levels.pop(0) if levels else min(d + STEP, 64))
        # Every node that splits has its children here, every other one itself.
        heavy = placed.select("node", F.col("fp").bitwiseAND(F.lit(mask(d))).alias("child"))
        counts = heavy.groupBy("node", "child").agg(F.count(F.lit(1)).alias("n"))
        if last == 0:
            kids = counts.select(F.col("node").alias("up"), F.col("child").alias("node"), F.lit(d).alias("depth"), "n")
        else:
            whole = nodes.filter(~F.col("split")).select(F.col("node").alias("up"), "node", "depth", "n")
            kids = (counts.join(nodes.filter("split").select("node"), "node", "left_semi")
                    .select(F.col("node").alias("up"), F.col("child").alias("node"), F.lit(d).alias("depth"), "n").unionByName(whole))
        deeper = bool(levels)
        kids = materialise(kids.withColumn("split", (F.col("depth") == d) & ((F.col("n") > NODE_MAX) | F.lit(deeper)) & F.lit(d < 64)), "trie-nodes")
        a = kids.select(F.col("up").alias("p"), F.col("node").alias("a"), F.col("depth").alias("ad"))
        b = kids.select(F.col("up").alias("q"), F.col("node").alias("b"), F.col("depth").alias("bd"))
        pairs = pairs.select("p", "q").join(a, "p").join(b, "q")
        shared = mask_of(F.least("ad", "bd"))
        pairs = pairs.filter((F.bit_count(F.col("a").bitwiseXOR(F.col("b")).bitwiseAND(shared)) <= max_bits)
                             & ((F.col("p") != F.col("q")) | (F.col("a") <= F.col("b"))))
        pairs = materialise(pairs.select(F.col("a").alias("p"), F.col("ad").alias("pd"), F.col("b").alias("q"), F.col("bd").alias("qd")), "trie-pairs")
        if last == 0 or deeper or not levels and d <= depth:
            placed = placed.select("fp", F.col("fp").bitwiseAND(F.lit(mask(d))).alias("node"))
        else:
            was = nodes.filter("split").select("node", "n", F.lit(True).alias("down"))
            placed = attach(placed, was, "node", "n", F.xxhash64("fp")).select(
                "fp", F.when(F.col("down"), F.col("fp").bitwiseAND(F.lit(mask(d)))).otherwise(F.col("node")).alias("node"))
            placed = materialise(placed, "trie-placed")
        nodes = kids.drop("up")
        if not deeper and nodes.filter("split").isEmpty():
            break
    held = materialise(placed.groupBy("node").agg(F.collect_list("fp").alias("fps")), "trie-leaves")
    left = held.select(F.col("node").alias("p"), F.col("fps").alias("pf"))
    right = held.select(F.col("node").alias("q"), F.col("fps").alias("qf"))
    units = pairs.join(left, "p").join(right, "q").select("p", "q", F.least("pd", "qd").alias("depth"), "pf", "qf")
    schema = T.StructType([T.StructField("v", T.LongType()), T.StructField("c", T.LongType())])

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for p, q, at, pf, qf in zip(*(batch.column(i) for i in range(5))):
                a = pf.values.to_numpy(zero_copy_only=False)
                b = None if p == q else qf.values.to_numpy(zero_copy_only=False)
                v, c = node_links(a, b, at.as_py() if b is not None else 0, max_bits)
                if len(v):
                    yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(c.view(np.int64))], names=["v", "c"])

    parts = max(pairs.count() // 8, 1)
    units = units.repartition(int(min(parts, 4 * max(spark.sparkContext.defaultParallelism, 64))), "p", "q")
    return units.mapInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """From rows (v, c): ``v, comp``, one row per distinct ``v`` (every ``c`` is also a ``v``).

    Rows with the same ``c`` are one star. In each round every vertex moves to
    the first vertex, in a freshly hashed order, of the stars it is in; stars
    with one vertex left are done. A round removes a share of the vertices
    however long the chains are. Stars of any size go through :func:`attach`.
    """
    members = materialise(links.distinct(), "cc-members")
    moves = []
    while True:
        turn = len(moves)
        if turn and members.isEmpty():
            break
        rank = lambda v: F.struct(F.xxhash64(F.lit(turn), v).alias("r"), v.alias("v"))  # noqa: B023, E731
        first = materialise(members.groupBy("c").agg(F.min(rank(F.col("v"))).alias("m"), F.count(F.lit(1)).alias("n")), "cc-first")
        near = attach(members, first, "c", "n", F.xxhash64("v"))
        move = materialise(near.groupBy("v").agg(F.min("m")["v"].alias("to"), F.count(F.lit(1)).alias("n")), "cc-move")
        moves.append(move)
        there = attach(members, move, "v", "n", F.xxhash64("c")).select(F.col("to").alias("v"), "c").distinct()
        there = materialise(there, "cc-there")
        open_ = materialise(there.groupBy("c").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn("open", F.lit(True)), "cc-open")
        members = materialise(attach(there, open_, "c", "n", F.xxhash64("v")).filter("open").select("v", "c"), "cc-members")
    out = moves[-1].select("v", F.col("to").alias("comp"))
    for move in reversed(moves[:-1]):
        out = materialise(out, "cc-labels")
        many = move.groupBy("to").agg(F.count(F.lit(1)).alias("n"))
        later = materialise(many.join(out.withColumnRenamed("v", "to"), "to", "left").select("to", "n", "comp"), "cc-later")
        out = attach(move.select("v", "to"), later, "to", "n", F.xxhash64("v")).select("v", F.coalesce("comp", "to").alias("comp"))
    return out


def grouped(rows: DataFrame, doc_id: str, max_bits: int = MAX_BITS) -> DataFrame:
    """From written rows with ``fp``: the rows with ``comp``, a fingerprint that names
    their component, and ``component_id``, the smallest id in it."""
    fps = materialise(rows.groupBy("fp").agg(F.min(doc_id).alias("low"), F.count(F.lit(1)).alias("n")), "simhash-fps")
    comp = materialise(components(self_join(fps.select("fp"), max_bits)), "simhash-comp")
    named = materialise(fps.join(comp.withColumnRenamed("v", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp")), "simhash-named")
    lows = materialise(named.groupBy("comp").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("k")), "simhash-lows")
    known = attach(named.select("fp", "n", "comp"), lows, "comp", "k", F.xxhash64("fp"))
    known = materialise(known, "simhash-known")
    return attach(rows, known, "fp", "n", F.xxhash64(doc_id))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    rows = materialise(fingerprints(df, [doc_id], text, shingle), "simhash-docs")
    out = grouped(rows, doc_id, max_bits)
    return out.select(F.col(doc_id).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component in the columns of ``df``: the one with the
    smallest id. Where rows share that id, and in components of null ids only,
    it is the smallest row by its columns in their order."""
    cols = df.columns
    plain = df.select(*[F.col(c).alias(f"in_{i}") for i, c in enumerate(cols)])
    at, body = f"in_{cols.index(doc_id)}", f"in_{cols.index(text)}"
    rows = materialise(fingerprints(plain, [at], body, shingle), "simhash-docs")
    named = materialise(grouped(rows, at, max_bits), "simhash-named")
    chosen = materialise(named.filter(F.col(at) == F.col("component_id")).groupBy(F.col(at).alias("_id")).agg(
        F.count(F.lit(1)).alias("_rows")), "simhash-kept")
    once = chosen.filter("_rows = 1").select("_id")
    # The ids grow with the input: a sort-merge join at every size, never a broadcast.
    kept = plain.join(once.hint("merge"), plain[at] == once["_id"], "left_semi")
    smallest = F.min(F.struct(*plain.columns)).alias("_row")
    more = chosen.filter("_rows > 1").select("_id")
    if not more.isEmpty():
        some = plain.join(more.hint("merge"), plain[at] == more["_id"], "left_semi")
        kept = kept.unionByName(some.groupBy(at).agg(smallest).select("_row.*"))
    orphans = named.filter(F.col("component_id").isNull()).select("fp", "comp").distinct()
    if not orphans.isEmpty():
        some = fingerprints(plain.filter(F.col(at).isNull()), plain.columns, body, shingle).join(orphans, "fp")
        kept = kept.unionByName(some.groupBy("comp").agg(smallest).select("_row.*"))
    return kept.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(cols)])

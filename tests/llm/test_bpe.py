import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from payguard.llm import bpe

from .helpers import SMOKE, awkward_docs, empty, with_clashes

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_merge_as_the_library(word):
    if word:
        assert bpe.merge(word.encode(), RANKS) == LIBRARY._core_bpe.encode_single_piece(word.encode())


@pytest.mark.parametrize("word", ["a" * 5000, "ab" * 3000, "=" * 777, "é漢" * 400, "".join(random.Random(1).choice("aeiou") for _ in range(4000))])
def test_merge_of_long_words(word):
    assert bpe.merge(word.encode(), RANKS) == LIBRARY._core_bpe.encode_single_piece(word.encode())


def check(df, **more):
    coded = bpe.encode(df, PATH, PATTERN, **more)
    rows = bpe.decode(coded, PATH).collect()
    assert len(rows) == df.count()
    for r in rows:
        assert list(r["ids"]) == LIBRARY.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    return coded


def test_awkward_texts(spark):
    docs = awkward_docs(spark)
    odd = [(200, "<|endoftext|> it's  \n\n \t x  y　 z \x1c\x85 1٣²Ⅷ"), (201, " "), (202, "\n"), (203, "'s't're"), (204, "x" * 3000)]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"), allowMissingColumns=True)
    got = check(with_clashes(docs).selectExpr("*", "1 AS ids", "2 AS chunk", "3 AS part", "4 AS body", "5 AS decoded").repartition(3))
    assert {"chunk", "body", "k_0", "_text"} <= set(got.columns)
    key = lambda r: str((r["doc_id"], r["text"], r["source"]))
    assert sorted(map(key, got.collect())) == sorted(map(key, docs.collect()))


def test_many_chunks(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").repartition(3)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = bpe.numbered(docs, "text", ["doc_id"], PATTERN, 8, 20_000)
        assert rows.select("chunk").distinct().count() > 10
        check(docs, keep=["doc_id", "text"], chunk_chars=20_000)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_digest_of_nulls_and_empty_tables(spark):
    docs = awkward_docs(spark)
    rows = bpe.digest(docs, "doc_id", PATH, PATTERN).collect()
    nothing = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert {tuple(r)[1:] for r in rows if r["doc_id"] in (4, 5)} == {(0, nothing, nothing)} and len(rows) == docs.count()
    assert bpe.digest(empty(spark, docs), "doc_id", PATH, PATTERN).count() == 0


def test_words_travel_without_offsets(spark):
    """The words of a chunk and part are one row of joined bytes, and a chunk is small enough for an executor of 3 GB."""
    import numpy as np
    from payguard.llm import bpe
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(500)))], "doc_id LONG, text STRING")
    rows = bpe.numbered(df, "text", ["doc_id"], r"\S+", 2, bpe.CHUNK).where("not texts").collect()
    held = [bpe.unpacked(bytes(r.body)) for r in rows]
    assert [b.num_rows for b in held] == [1, 1] and sum(len(b.column(1)[0]) for b in held) == 500
    codes = np.concatenate([np.cumsum(b.column(0).flatten().to_numpy()) for b in held])
    assert sorted(codes) == list(range(500)) and bpe.CHUNK <= 16_000_000

"""Byte-level BPE encoding and decoding by a shuffle of distinct words.

Every text is split into pre-tokens by the tokenizer's pattern. A task numbers
the distinct pre-tokens ("words") of a chunk of its texts, so a text becomes
the numbers of its words, position by position, and each word leaves its chunk
once, however often it occurs there. The words of all chunks meet in a shuffle
by their hash, where each distinct word is encoded once, and their ids go back
to the chunks, in which every position takes the ids of its word. A word that
holds a third of all tokens is one row of each chunk, so there is no hot key.

Words travel as packed columns (Arrow record batches, compressed), one for each
chunk and part of the hash space, and so do their ids on the way back. The texts
don't travel: their word numbers are written once, bucketed by chunk, and the
ids are shuffled to those buckets (a co-located join; the bucketed table is in
the scratch folder and has an entry in the catalog). Memory is one chunk's.

Decoding looks each id up in the table of token bytes (a vocabulary's size),
which every task holds, and joins the bytes.

Defined cases: a null or empty text has no ids and decodes to no bytes; a text
that is longer than a chunk is a chunk of its own; repeated rows repeat; special
tokens' strings are ordinary text; an id outside the table is an error. All
columns of the input pass through, but ``ids`` (or ``decoded``) is replaced.
"""

from __future__ import annotations

import base64
import heapq
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from payguard.llm.common import cuts
from payguard.session import plan_bytes, scratch_dir

#: Characters (bytes) of the texts of a chunk: bounds the words that a task holds.
CHUNK = 16_000_000
#: Input bytes for each part of the words' hash space: bounds the distinct words that a task encodes.
PART_BYTES = 64_000_000
#: Ids that are decoded together.
DECODED = 500_000
#: Part number of the rows that hold a chunk's texts.
TEXTS = -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank, from a rank file: base64 and number on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: of all neighbouring pieces that join to a token, those of the
    smallest rank (leftmost first) are joined until there are none."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))      # of the piece that starts at a position; 0: no piece starts there
    before = list(range(-1, n - 1))  # start of the piece before
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, a, stop = heapq.heappop(heap)
        b = end[a]
        if not b or b >= n or end[b] != stop:
            continue  # one of the two was joined to something else
        end[a], end[b] = stop, 0
        if stop < n:
            before[stop] = a
            if (r := ranks.get(word[a:end[stop]])) is not None:
                heapq.heappush(heap, (r, a, end[stop]))
        if (p := before[a]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


def packed(names: list[str], arrays: list) -> bytes:
    """An Arrow record batch as compressed bytes."""
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays(arrays, names=names)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=9))) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(body: bytes):
    import pyarrow as pa
    return pa.ipc.open_stream(body).read_next_batch()


def planes(values: np.ndarray, lengths) -> list:
    """List columns with the low and the high 16 bits of numbers: the high ones are nearly all 0."""
    return [ragged(lengths, (values & 0xFFFF).astype(np.uint16)), ragged(lengths, (values >> 16).astype(np.uint16))]


def joined_planes(low, high) -> np.ndarray:
    """All numbers of two such columns."""
    return low.flatten().to_numpy().astype(np.int64) | high.flatten().to_numpy().astype(np.int64) << 16


def whole(values: np.ndarray):
    """All values as the one row of an Arrow list column: no offsets."""
    return ragged([len(values)], values)


def ragged(lengths, flat: np.ndarray):
    """An Arrow list column of the given row lengths."""
    import pyarrow as pa
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(flat))


def spread_ids(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The ids of the words ``codes``, one after the other; word w has ``flat[starts[w]:starts[w] + sizes[w]]``."""
    n = sizes[codes]
    ends = np.cumsum(n)
    return flat[np.repeat(starts[codes] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


_ROWS = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("body", T.BinaryType()),
                      T.StructField("texts", T.BooleanType())])


def numbered(df: DataFrame, text: str, keep: list[str], pattern: str, parts: int, chunk_chars: int) -> DataFrame:
    """Rows of chunks: the ``keep`` columns with the word numbers of their texts, and the words by hash part."""

    def run(batches):
        import pyarrow as pa
        import regex
        from pyspark import TaskContext
        find = regex.compile(pattern).findall
        base, count = TaskContext.get().partitionId() << 33, 0
        words: dict[str, int] = {}
        size = 0

        def row(part, body):
            return pa.RecordBatch.from_arrays([pa.array([base + count]), pa.array([part], pa.int32()), pa.array([body], pa.binary()), pa.array([part == TEXTS])],
                                             names=_ROWS.names)

        def end():
            by_part: dict[int, tuple[list, list]] = {}
            for w, code in words.items():
                b = w.encode()
                held = by_part.setdefault(zlib.crc32(b) % parts, ([], []))
                held[0].append(code)
                held[1].append(b)
            for part, (codes, held) in by_part.items():
                # Codes grow, so their steps and the words' sizes are small numbers, which compress well.
                steps = np.diff(np.array(codes, dtype=np.int64), prepend=0).astype(np.uint32)
                sizes = np.array([len(b) for b in held], dtype=np.uint32)
                yield row(part, packed(["step", "size", "words"], [whole(steps), whole(sizes), pa.array([b"".join(held)], pa.binary())]))

        for batch in batches:
            for start, stop in cuts(batch.column(0)):
                part = batch.slice(start, stop - start)
                texts = part.column(0).to_pylist()
                got = sum(len(t) for t in texts if t)
                if size and size + got > chunk_chars:
                    yield from end()
                    words, size, count = {}, 0, count + 1
                size += got
                lengths, codes = [], []
                for t in texts:
                    found = find(t) if t else []
                    lengths.append(len(found))
                    codes += [words.setdefault(w, len(words)) for w in found]
                body = [part.column(1 + i) for i in range(len(keep))] + planes(np.array(codes, dtype=np.int64), lengths)
                yield row(TEXTS, packed([f"c{i}" for i in range(len(body))], body))
        if size or count:
            yield from end()

    chosen = [F.col(text).cast("string").alias("_text"), *[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]]
    return df.select(*chosen).mapInArrow(run, _ROWS)


def encoded_words(rows: DataFrame, ranks) -> DataFrame:
    """The same rows with the words' ids; a distinct word is encoded once, where its part is."""
    def run(batches):
        import pyarrow as pa
        known: dict[bytes, list[int]] = {}
        here = None
        for batch in batches:
            for chunk, part, body in zip(*[c.to_pylist() for c in batch.columns]):
                if part != here:
                    known, here = {}, part
                held = unpacked(body)
                data, ids, start = held.column(2)[0].as_py(), [], 0
                for stop in np.cumsum(held.column(1).flatten().to_numpy(), dtype=np.int64).tolist():
                    w, start = data[start:stop], stop
                    got = known.get(w)
                    if got is None:
                        got = known[w] = merge(w, ranks.value)
                    ids.append(got)
                flat = np.array([i for got in ids for i in got], dtype=np.int64)
                sizes = np.array([len(got) for got in ids], dtype=np.uint32)
                out = packed(["step", "size", "low", "high"], [held.column(0), whole(sizes), *planes(flat, [len(flat)])])
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([part], pa.int32()), pa.array([out], pa.binary())], names=["chunk", "part", "body"])

    return rows.sortWithinPartitions("part").mapInArrow(run, "chunk bigint, part int, body binary")


def reassembled(texts: DataFrame, words: DataFrame, schema: T.StructType) -> DataFrame:
    """Per chunk (of bounded size): each position of its texts takes its word's ids."""
    def run(texts, words):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        out = to_arrow_schema(schema)
        codes, sizes, flats = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for body in words.column("body").to_pylist():
            held = unpacked(body)
            codes.append(np.cumsum(held.column(0).flatten().to_numpy(), dtype=np.int64))
            sizes.append(held.column(1).flatten().to_numpy())
            flats.append(joined_planes(held.column(2), held.column(3)))
        code, size, flat = (np.concatenate(v).astype(np.int64) for v in (codes, sizes, flats))
        starts, lengths = np.zeros(len(code), dtype=np.int64), np.zeros(len(code), dtype=np.int64)
        starts[code], lengths[code] = np.cumsum(size) - size, size
        done = []
        for body in texts.column("body").to_pylist():
            held = unpacked(body)
            low, high = held.columns[-2:]
            at = joined_planes(low, high)
            total = np.concatenate([[0], np.cumsum(lengths[at])])
            ids = ragged(np.diff(total[low.offsets.to_numpy()]), spread_ids(at, starts, lengths, flat).astype(np.int32))
            arrays = [held.column(i).cast(out.field(i).type) for i in range(held.num_columns - 2)]
            done.append(pa.RecordBatch.from_arrays([*arrays, ids.cast(out.field(len(arrays)).type)], schema=out))
        return pa.Table.from_batches(done, schema=out)

    return texts.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(run, schema)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None, chunk_chars: int = CHUNK) -> DataFrame:
    """``keep`` columns (default: all) and ``ids`` (array of int) of every row."""
    spark = df.sparkSession
    keep = [c for c in (df.columns if keep is None else keep) if c != "ids"]
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))  # the vocabulary
    known = plan_bytes(df)  # nothing to go by where Catalyst can't estimate
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), known // PART_BYTES + 1 if known < 2 ** 60 else 0)
    # A task writes its few chunks to their buckets: no shuffle, and texts and words in files of their own.
    name = f"payguard_bpe_{uuid.uuid4().hex[:12]}"
    numbered(df, text, keep, pattern, parts, chunk_chars).write.partitionBy("texts").bucketBy(parts, "chunk").format("parquet").option(
        "path", scratch_dir(spark, "bpe-words")).saveAsTable(name)
    rows = spark.table(name)
    words = encoded_words(rows.filter(~F.col("texts")).select("chunk", "part", "body").repartition(parts, "part"), ranks)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField(f"k_{i}", kinds[c]) for i, c in enumerate(keep)] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    got = reassembled(rows.filter("texts").select("chunk", "body"), words, schema)
    return got.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], "ids")


def slices(lengths: np.ndarray, most: int):
    """(start, stop) of runs of rows with about ``most`` values together, one row at least."""
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the bytes of their ids."""
    keep = [c for c in df.columns if c != "decoded"]
    tokens = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))  # the vocabulary
    at = keep.index(ids)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField(f"k_{i}", kinds[c]) for i, c in enumerate(keep)] + [T.StructField("decoded", T.BinaryType())])

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark.sql.pandas.types import to_arrow_schema
        out = to_arrow_schema(schema)
        size = np.zeros(max(tokens.value.values(), default=-1) + 1, dtype=np.int64)
        for token, rank in tokens.value.items():
            size[rank] = len(token)
        flat = np.frombuffer(b"".join(sorted(tokens.value, key=tokens.value.get)), dtype=np.uint8)
        starts = np.cumsum(size) - size
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in slices(lengths, DECODED):
                part = batch.slice(i, j - i)
                got = part.column(at).flatten().to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(size[got])])[np.concatenate([[0], np.cumsum(lengths[i:j])])]
                data = spread_ids(got, starts, size, flat)
                body = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*[part.column(c).cast(out.field(c).type) for c in range(len(keep))], body], schema=out)

    mapped = df.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]).mapInArrow(run, schema)
    return mapped.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], "decoded")


def digest(df: DataFrame, doc_id: str, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Per document: how many ids, the hash of the ids, and that of the bytes they decode to."""
    both = decode(encode(df, ranks_path, pattern, text, [doc_id]), ranks_path)
    return both.select(doc_id, F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))

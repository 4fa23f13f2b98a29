"""Shared helpers of the corpus operators: hot-key joins, hashes, table input."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from payguard.session import materialise, prepare

#: A key with more than 1/HOT_SHARE of all rows counts as hot, so there are
#: fewer than HOT_SHARE hot keys whatever the input: the bound of what
#: :func:`attach` broadcasts.
HOT_SHARE = 1000
#: Number of salts that the rows of a hot key are spread over.
SALTS = 4096


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """``cols`` of a given table (only they reach the scan)."""
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def attach(left: DataFrame, right: DataFrame, key: str, rows: str, salt: Column) -> DataFrame:
    """Left join of ``right`` (one row per ``key``, never null) to ``left`` without a hot task.

    ``rows`` names the column of ``right`` with the number of ``left`` rows of
    the key. Keys with over 1/HOT_SHARE of all rows (fewer than HOT_SHARE of
    them, so the broadcast is bounded) are joined by broadcast; the others by a
    shuffle in which the already joined rows are dealt out by ``salt``, an
    expression over ``left``. ``right`` is read twice: pass a written table.
    ``rows`` is not part of the result.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    hot = F.col(rows) > F.lit(max(total // HOT_SHARE, 1))
    value = F.struct(*[c for c in right.columns if c not in (key, rows)])
    warm = right.filter(hot).select(F.col(key).alias("_hk"), value.alias("_hv"))
    cold = right.filter(~hot).select(F.col(key).alias("_ck"), F.lit(0).alias("_cs"), value.alias("_cv"))
    joined = left.join(F.broadcast(warm), F.col(key) == F.col("_hk"), "left").withColumn(
        "_s", F.when(F.col("_hk").isNull(), 0).otherwise(1 + F.pmod(salt, F.lit(SALTS))).cast("int"))
    joined = joined.join(cold, (F.col(key) == F.col("_ck")) & (F.col("_s") == F.col("_cs")), "left")
    taken = F.coalesce("_hv", "_cv")
    fields = [c for c in right.columns if c not in (key, rows)]
    return joined.select(*[left[c] for c in left.columns], *[taken[c].alias(c) for c in fields])


def crc_mod(doc_id, mod: int) -> int:
    """crc32 of the id written as text (null: the empty text), modulo ``mod``."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def crc_mod_col(col: str, mod: int) -> Column:
    """The same as a column."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def map_text(df: DataFrame, text: str, keep: list[str], added: T.StructType, make) -> DataFrame:
    """``keep`` columns of ``df`` plus the columns ``added``, computed from ``text`` in
    Arrow batches inside the tasks.

    ``make()`` runs once per task and returns a function from a list of texts
    (None for null) to a dict of lists, one per added column. The batches are
    cut to ``BATCH_CHARS`` characters, so very long texts come a few at a time.
    """
    cols = [F.col(text).alias("_text"), *[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]]
    kinds = {f.name: f for f in df.schema.fields}
    schema = T.StructType([T.StructField(f"k_{i}", kinds[c].dataType) for i, c in enumerate(keep)] + added.fields)
    names = [f.name for f in added.fields]

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        fn, out = make(), to_arrow_schema(schema)
        for batch in batches:
            for start, stop in cuts(batch.column(0)):
                part = batch.slice(start, stop - start)
                got = fn(part.column(0).to_pylist())
                arrays = [part.column(1 + i).cast(out.field(i).type) for i in range(len(keep))]
                arrays += [pa.array(got[n], type=out.field(len(keep) + i).type) for i, n in enumerate(names)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    mapped = df.select(*cols).mapInArrow(run, schema)
    return mapped.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], *names)


BATCH_CHARS = 4_000_000


def cuts(texts):
    """(start, stop) of runs of rows with about BATCH_CHARS bytes together."""
    import numpy as np
    import pyarrow.compute as pc
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype="int64")
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > BATCH_CHARS:
            yield start, i
            start, held = i, 0
        held += n + 16
    if start < len(sizes):
        yield start, len(sizes)


__all__ = ["attach", "crc_mod", "crc_mod_col", "cuts", "map_text", "materialise", "table"]

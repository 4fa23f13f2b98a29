"""Replay a sample: repeat it n times, pace it in groups.

Pacing semantics (per repetition the row counter restarts): after every
``g`` rows the producer pauses ``pause`` seconds, so row ``i`` (0-based, in
sequence order) of repetition ``r`` is sent at

    send_offset_s = pause * (r * (N div g) + (i div g))

where N is the sample size. A non-numeric group size means no grouping, a
non-numeric pause means 0, a non-numeric repetition count means 1;
g <= 0 pauses after every row, like g = 1.

The row index is computed without funnelling rows into one task: the frame
is range-partitioned on the sequence key, each partition numbers its rows,
and a small table of per-partition counts (one row per partition, so its
size is bounded by the partition count, not the data) gives each partition
its starting index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from payguard.session import materialise, scratch_dir

INT32_MAX = 2**31 - 1
#: Rows of a stored range of steps, about (one step at least).
RANGE_ROWS = 100_000
_LOCAL_BITS = 33  # monotonically_increasing_id: partition id in the upper 31 bits


def _to_int(text: str | int | None, fallback: int) -> int:
    try:
        return int(str(text).strip())
    except (TypeError, ValueError):
        return fallback


@dataclass(frozen=True)
class Pacing:
    group_size: int = INT32_MAX
    pause_s: int = 0
    repetitions: int = 1

    @classmethod
    def from_text(cls, messages_per_group, seconds_to_pause, repetitions) -> "Pacing":
        g = _to_int(messages_per_group, INT32_MAX)
        return cls(max(g, 1), _to_int(seconds_to_pause, 0), _to_int(repetitions, 1))


def range_partitions(df: DataFrame) -> int:
    """Partition count for a range shuffle of ``df``: one for each read split's
    worth of estimated bytes, but at least ``spark.sql.shuffle.partitions``.
    Nothing runs for it."""
    from payguard.session import SPLIT_BYTES, plan_bytes
    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, min(plan_bytes(df) // SPLIT_BYTES + 1, 200_000))


def dense_index(df: DataFrame, order: list[str] | None, group: str | None = None,
                partitions: int | None = None, index_col: str = "_idx",
                total_col: str | None = "_total") -> DataFrame:
    """0-based position of each row in ``order`` (within ``group`` if given),
    plus the group's row count. Order keys should be unique for a
    reproducible numbering; ties get adjacent indexes in arbitrary order.

    With ``order=None`` any dense numbering will do (e.g. log offsets): rows
    keep their partitions, only sorted by group inside each, so there is no
    shuffle at all.
    """
    keys = ([group] if group else []) + (order or [])
    # As many range partitions as the input has splits (at least the shuffle
    # setting): a fixed 200 would put hundreds of GB in each task at scale.
    n = partitions or (range_partitions(df) if order else None)
    g = F.col(group) if group else F.lit(0)
    if order:
        df = df.repartitionByRange(n, *keys)
    if keys:
        df = df.sortWithinPartitions(*keys)
    # The ids depend on physical partitioning, which AQE may coalesce
    # differently for each consumer of a shuffle; writing the numbered rows
    # once (a table in the cluster's shared checkpoint folder) fixes them, so
    # the counts and the rows agree and a lost executor cannot renumber
    # anything. The count pass then reads two columns only.
    ranged = (materialise(df.withColumn("_mid", F.monotonically_increasing_id()), "dense-index")
                .withColumn("_sp", F.shiftright(F.col("_mid"), _LOCAL_BITS))
                .withColumn("_grp", g))
    # One row per (input partition, group): bounded by partitions x groups.
    counts = (ranged.groupBy("_sp", "_grp")
              .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first")))
    w = Window.partitionBy("_grp").orderBy("_sp")
    starts = counts.select(
        "_sp", "_grp", "_first",
        (F.sum("_cnt").over(w) - F.col("_cnt")).alias("_start"),
        F.sum("_cnt").over(Window.partitionBy("_grp")).alias("_gtotal"))
    # The start table is small by construction but grows with partitions x
    # groups: store it, count it, and broadcast only within the threshold.
    starts = materialise(starts, "dense-index-starts")
    from payguard.session import broadcast_if_small
    out = ranged.join(broadcast_if_small(starts, starts.count()), ["_sp", "_grp"])
    out = out.withColumn(index_col, F.col("_start") + F.col("_mid") - F.col("_first"))
    if total_col:
        out = out.withColumn(total_col, F.col("_gtotal"))
    return out.drop("_mid", "_sp", "_grp", "_start", "_first", "_gtotal")


def repeat(df: DataFrame, n: int, rep_col: str = "rep") -> DataFrame:
    """Each row ``n`` times, tagged 0..n-1 (a per-row generator, no join).
    n = 0 gives no rows; use :func:`repeat_forever` for n = -1."""
    if n < 0:
        raise ValueError("endless replay is a stream: use repeat_forever")
    if n == 0:
        return df.where(F.lit(False)).withColumn(rep_col, F.lit(0))
    return df.withColumn(rep_col, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def pace(df: DataFrame, order: list[str], pacing: Pacing, rep_col: str = "rep",
         seq_col: str = "seq", offset_col: str = "send_offset_s") -> DataFrame:
    """Repeat the sample and give every row its send offset (seconds from start)."""
    indexed = dense_index(df, order, index_col=seq_col, total_col="_n")
    g, pause = pacing.group_size, pacing.pause_s
    reps = repeat(indexed, pacing.repetitions, rep_col)
    per_pass = F.floor(F.col("_n") / F.lit(g))
    offset = F.lit(pause) * (F.col(rep_col) * per_pass + F.floor(F.col(seq_col) / F.lit(g)))
    return reps.withColumn(offset_col, offset.cast("bigint")).drop("_n")


def step_ticks(spark: SparkSession, pacing: Pacing, tick_s: float = 1.0) -> DataFrame:
    """A stream of steps: a ``rate`` source counts them, step ``t`` comes ``t`` pauses after the start."""
    pause = max(pacing.pause_s * tick_s, 0.001)
    ticks = spark.readStream.format("rate").option("rowsPerSecond", max(int(1 / pause), 1)).load()
    if pause > 1:  # the source counts whole seconds
        return ticks.where(F.col("value") % int(pause) == 0).select((F.col("value") / int(pause)).cast("bigint").alias("step"))
    return ticks.select(F.col("value").alias("step"))


class PacedSample:
    """The paced replay of a sample, also endless (``repetitions`` below 0), step by step.

    Row ``i`` of pass ``r`` is due at step ``r * (N div g) + i div g``. The sample is
    stored once, partitioned by ranges of about ``RANGE_ROWS`` rows' steps; :meth:`due`
    finds the rows of some steps by an equi-join on the step modulo ``N div g`` that
    reads only those steps' ranges. So a step's work doesn't depend on the sample's size.
    A sample shorter than a group has all its passes at step 0 if they are finite, and
    one pass a step if they are endless. An empty sample is never due.
    """

    def __init__(self, static: DataFrame, order: list[str], pacing: Pacing):
        self.spark, self.pacing = static.sparkSession, pacing
        rows = dense_index(static, order, index_col="seq", total_col="_n")
        n = rows.select(F.max("_n")).first()[0] or 0
        self.pass_steps = n // pacing.group_size
        self.at_once = self.pass_steps == 0 and pacing.repetitions >= 0
        self.cycle = self.pass_steps or 1
        self.span = max(RANGE_ROWS // pacing.group_size, 1)  # steps of a range
        rows = rows.drop("_n").withColumn("_k", F.floor(F.col("seq") / F.lit(pacing.group_size)).cast("bigint"))
        rows = rows.withColumn("_slot", F.col("_k") % self.cycle).withColumn("_range", F.floor(F.col("_slot") / F.lit(self.span)).cast("bigint"))
        # A step may hold more rows than a range should: its blocks are tasks of their own.
        path = scratch_dir(self.spark, "paced-sample")
        rows.repartition("_range", F.floor(F.col("seq") / F.lit(RANGE_ROWS))).write.mode("overwrite").partitionBy("_range").parquet(path)
        self.rows = self.spark.read.schema(rows.schema).parquet(path)

    def due(self, ticks: DataFrame) -> DataFrame:
        """The rows that are due at the steps of ``ticks`` (a batch), with ``rep``, ``seq`` and ``step``."""
        first, last = ticks.agg(F.min("step"), F.max("step")).first()
        rows = self.rows
        if first is None:
            rows = rows.where(F.lit(False))
        elif last - first + 1 < self.cycle:  # literals, so the scan's partitions are pruned
            a, b = first % self.cycle, last % self.cycle
            after, before = F.col("_range") >= a // self.span, F.col("_range") <= b // self.span
            rows = rows.where(after & before if a <= b else after | before)
        due = ticks.select("step").withColumn("_slot", F.col("step") % self.cycle).join(rows.drop("_range"), "_slot")
        if self.at_once:
            due = repeat(due.where(F.col("step") == 0), self.pacing.repetitions)
        else:
            due = due.withColumn("rep", F.floor((F.col("step") - F.col("_k")) / self.cycle)).where(F.col("step") >= F.col("_k"))
            if self.pacing.repetitions >= 0:
                due = due.where(F.col("rep") < self.pacing.repetitions)
        return due.withColumn("rep", F.col("rep").cast("bigint")).drop("_slot", "_k")


def last_step(n: int, pacing: Pacing) -> int | None:
    """The step of the last row of a finite replay, None if it is endless."""
    if pacing.repetitions < 0:
        return None
    if n == 0 or pacing.repetitions == 0:
        return -1
    return (pacing.repetitions - 1) * (n // pacing.group_size) + (n - 1) // pacing.group_size

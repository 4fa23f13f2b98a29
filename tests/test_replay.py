"""Replay repetition and pacing; distributed row index."""

import pytest
from pyspark.sql import Window, functions as F

from payguard.operators.replay import INT32_MAX, Pacing, dense_index, pace, repeat


def test_pacing_fixture(spark):
    df = spark.createDataFrame([(i,) for i in range(7)], "event_id INT")
    rows = pace(df, ["event_id"], Pacing(3, 2, 2)).orderBy("rep", "seq").collect()
    assert [r.send_offset_s for r in rows if r.rep == 0] == [0, 0, 0, 2, 2, 2, 4]
    assert [r.send_offset_s for r in rows if r.rep == 1] == [4, 4, 4, 6, 6, 6, 8]


@pytest.mark.parametrize("args,expected", [
    (("10", "1", "1"), Pacing(10, 1, 1)),
    (("x", "1", "2"), Pacing(INT32_MAX, 1, 2)),
    (("10", "", None), Pacing(10, 0, 1)),
    (("0", "3", "-1"), Pacing(1, 3, -1)),
    (("-4", "3", "0"), Pacing(1, 3, 0)),
])
def test_pacing_settings(args, expected):
    assert Pacing.from_text(*args) == expected


def test_repeat_counts(spark):
    df = spark.range(5)
    assert repeat(df, 0).count() == 0
    assert repeat(df, 1).count() == 5
    assert sorted(r.rep for r in repeat(spark.range(1), 3).collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        repeat(df, -1)


def test_dense_index_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("g"))
    got = dense_index(df, ["k"], group="g", partitions=6)
    w = Window.partitionBy("g").orderBy("k")
    ref = df.withColumn("_ref", F.row_number().over(w) - 1).withColumn("_rt", F.count("*").over(Window.partitionBy("g")))
    j = got.join(ref, ["g", "k"])
    assert j.count() == 5000
    assert j.where((F.col("_idx") != F.col("_ref")) | (F.col("_total") != F.col("_rt"))).count() == 0


def test_range_shuffle_runs_nothing(spark):
    """The size of a range shuffle comes from the plan's estimate, also behind a shuffle."""
    from payguard.operators.replay import range_partitions
    from payguard.session import SPLIT_BYTES
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup(None)
    assert range_partitions(spark.range(1000).distinct()) == shuffle
    big = spark.range(SPLIT_BYTES * shuffle)  # 8 bytes a row
    assert range_partitions(big) >= 8 * shuffle
    assert tracker.getJobIdsForGroup(None) == before


@pytest.mark.parametrize("n,pacing,expected", [(7, Pacing(3, 2, 2), 4), (6, Pacing(3, 2, 1), 1), (5, Pacing(10, 1, 3), 0), (5, Pacing(1, 1, -1), None), (0, Pacing(), -1)])
def test_last_step(n, pacing, expected):
    from payguard.operators.replay import last_step
    assert last_step(n, pacing) == expected

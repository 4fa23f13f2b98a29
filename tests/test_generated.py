"""What the JVM compiles of the decoder, and how rows are dealt out to it."""

import contextlib
import io
import re

import pytest

from conftest import SMOKE
from payguard.operators.decode import decode_invoice, decode_raw
from payguard.session import TASK_BYTES, plan_bytes, spread
from payguard.sources.adapter import raw_text_view, to_payload, token_payloads


def method_bytes(df) -> int:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("codegen")
    return max((int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())), default=0)


@pytest.mark.parametrize("decoder", [decode_raw, decode_invoice])
@pytest.mark.parametrize("payloads", [lambda li: to_payload(raw_text_view(li)), token_payloads])
def test_methods_are_small_enough_to_be_compiled(spark, decoder, payloads):
    # The JVM interprets a method of more than 8,000 bytes, at many times the cost.
    df = decoder(payloads(spark.read.parquet(f"{SMOKE}/lineitem.parquet")))
    assert method_bytes(df) <= 8000


def test_a_filter_on_decoded_columns_parses_once(spark):
    good = decode_raw(to_payload(raw_text_view(spark.read.parquet(f"{SMOKE}/lineitem.parquet")))).where("_error IS NULL").drop("_error")
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_tasks_of_row_work_are_bounded(spark):
    big = spark.range(TASK_BYTES * 5)  # 8 bytes a row
    assert plan_bytes(big) == 40 * TASK_BYTES
    tasks = spread(big)._jdf.queryExecution().optimizedPlan().numPartitions()
    assert tasks >= 40 and tasks % spark.sparkContext.defaultParallelism == 0


def test_topics_and_dated_tables_are_stored_as_zstd(spark):
    """Half the bytes of the default codec; they are most of what a subscription's queries write (F20)."""
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from payguard.streaming import scenario, tables
    run = scenario.new_run(spark, "t_stored")
    rows = spark.range(0, 30, 1, 1).select(F.col("id").cast("string").alias("value"), F.lit("2024-01-01").cast("date").alias("day"))
    scenario.append(rows.drop("day"), run)
    tables.write_batch(rows, run.sinks.raw, "run-0", 0)
    files = tables.folders(spark, f"{run.topic}/*.parquet") + tables.folders(spark, f"{run.sinks.raw}/day=*/run=*/batch_id=*/*.parquet")
    assert len(files) == 2
    for f in files:
        assert pq.ParquetFile(f.removeprefix("file:")).metadata.row_group(0).column(0).compression == "ZSTD"


def test_a_table_is_dealt_out_without_a_sort(spark):
    """Dealt out in turn, each task sorts all its rows first and spills what its memory doesn't hold."""
    from payguard.sources.tables import read_table
    table = read_table(spark, "/root/testdata/sf0.001", "lineitem")
    spread = read_table(spark, "/root/testdata/sf0.001", "lineitem", spread=True)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and "hashpartitioning" in plan and spread.columns == table.columns
    assert sorted(map(str, spread.collect())) == sorted(map(str, table.collect()))
    rows = spread.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    assert max(rows) < 2 * sum(rows) / len(rows)


def test_stream_raw_stores_zstd(spark):
    from payguard.plans.catalog import REGISTRY
    assert all(f.endswith(".zstd.parquet") for f in REGISTRY["stream_raw"].run(spark, "/root/testdata/sf0.001").inputFiles())


def test_empty_text_takes_no_bytes_of_a_sample_file(spark, tmp_path):
    from payguard.sources.files import read_large_csv, read_sample_csv, write_sample_csv
    rows = [("a", "", None), ("", "", ""), ('say "x"', "two\nlines", "")]
    write_sample_csv(spark.createDataFrame(rows, "x STRING, y STRING, z STRING").coalesce(1), f"{tmp_path}/three")
    (text,) = [f.read_text() for f in (tmp_path / "three").glob("*.csv")]
    assert text == 'x,y,z\na,,\n,,\n"say ""x""","two\nlines",\n'
    for read in (read_sample_csv, read_large_csv):
        assert sorted(map(tuple, read(spark, f"{tmp_path}/three", ("x", "y", "z")).collect())) == sorted(tuple(v or "" for v in r) for r in rows)
    write_sample_csv(spark.createDataFrame([("a",), ("",)], "x STRING"), f"{tmp_path}/one")
    assert sorted(r.x for r in read_sample_csv(spark, f"{tmp_path}/one", ("x",)).collect()) == ["", "a"]

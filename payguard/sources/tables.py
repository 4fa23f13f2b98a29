"""Readers for the parquet tables the jobs run over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read a table. ``spread=True`` for CPU-heavy row work (JSON, Python):
    its rows are dealt out first, by the hash of their numbers in their files."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if spread:
        from payguard.session import spread as _spread
        df = _spread(df, by=F.col("_metadata.row_index"))
    return df

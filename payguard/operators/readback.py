"""What a user runs on the stored results: count, first page, clear."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def index_total(df: DataFrame, name: str) -> DataFrame:
    """One row: (index_name, total)."""
    return df.select(F.lit(name).alias("index_name"), F.count(F.lit(1)).alias("total"))


def search(df: DataFrame, order: list[str], size: int = 10) -> DataFrame:
    """First ``size`` documents in ``order`` plus the index total on each row.

    Top-k is a per-partition top-k then a merge (no full sort); the total is
    a scalar subquery, not a join.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    return df.orderBy(*order).limit(size).withColumn("total", total)


def clear_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Empty a table in place (its schema stays)."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def init_tables(spark: SparkSession, tables: dict[str, T.StructType], location_root: str | None = None,
                partitioned_by: T.StructType | None = None) -> list[str]:
    """Create each missing table (name -> schema) at ``<location_root>/<name>``;
    existing ones are left alone. Returns the names that were created, as they
    are in the catalog (other characters than letters and digits become ``_``)."""
    from payguard.schemas import table_ddl
    from payguard.streaming.tables import catalog_name
    created = []
    for folder, schema in tables.items():
        name = catalog_name(folder)
        if spark.catalog.tableExists(name):
            continue
        columns = T.StructType(schema.fields + (partitioned_by.fields if partitioned_by else []))
        parts = f" PARTITIONED BY ({', '.join(partitioned_by.names)})" if partitioned_by else ""
        place = f" LOCATION '{location_root.rstrip('/')}/{folder}'" if location_root else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({table_ddl(columns)}) USING parquet{parts}{place}")
        created.append(name)
    return created

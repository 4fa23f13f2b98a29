"""Session helpers: UTC time zone and the shared scratch folder.

Intermediate tables and streaming checkpoints go under the folder the
cluster names in ``spark.checkpoint.dir``. Only when that is unset (local
tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("payguard")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


_SHIPPED: set[str] = set()
#: A task that writes a dated table keeps files of this many days open; only rows of further days are sorted by day first.
WRITERS, DAY_WRITERS = "spark.sql.maxConcurrentOutputFileWriters", 16
#: How wide rows are stored that are read again soon: a third of the default codec's bytes, and small buffers, as many files are open.
#: No dictionaries: looking up every value costs a quarter of the write, and zstd finds most of the repeats (files are an eighth larger).
WIDE = {"compression": "zstd", "parquet.block.size": str(16 * 1024 * 1024), "parquet.enable.dictionary": "false", "parquet.column.statistics.enabled": "false",
        "parquet.size.statistics.enabled": "false"}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin UTC (event times are UTC text), make sure a checkpoint dir exists,
    and ship this package to the Python workers."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if int(spark.conf.get(WRITERS)) == 0:
        spark.conf.set(WRITERS, str(DAY_WRITERS))
    scratch_root(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Add this package to the Python workers' path (like ``--py-files``), once
    per application: Python steps (model scoring) import it in the workers.
    The archive is written into the shared scratch folder."""
    import io
    import zipfile
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    path = f"{scratch_root(spark).rstrip('/')}/payguard-{uuid.uuid4().hex[:12]}.zip"
    fs, p = file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir``, or on a local master
    a folder of this machine. A cluster must name one: executors write there
    and the driver reads it back."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="payguard-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared scratch root (never reused)."""
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    fs, p = file_system(spark, path)
    fs.mkdirs(p)
    return path


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path on any supported store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def free(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, or anything else under a path of ours."""
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def plan_bytes(df) -> int:
    """Catalyst's estimate of the frame's size; nothing runs for it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: The default size of a read split.
SPLIT_BYTES = 128 * 1024 * 1024
#: Stored bytes of a table that one task of CPU-heavy row work takes.
TASK_BYTES = 32 * 1024 * 1024


def spread(df, partitions: int | None = None, by=None):
    """Deal out a stored table for CPU-heavy narrow stages (JSON, Python scoring).

    A row there costs many times its stored bytes, so a read split of 128 MB, or a single small file,
    would be a task of minutes: a task gets at most about TASK_BYTES, and the tasks are a multiple of
    the cores. What is shuffled is the table's own rows, before they are widened. They are dealt out by the
    hash of ``by``, if given, which should differ from row to row: dealt out in turn, each task sorts all its
    rows first, and spills those that don't fit its memory.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    rounds = max(1, -(-plan_bytes(df) // (TASK_BYTES * cores)))
    return df.repartition(partitions or rounds * cores, *([] if by is None else [by]))


def broadcast_if_small(df, rows: int, row_bytes: int = 64):
    """Broadcast hint only when ``rows`` (already counted) fits the session's
    broadcast threshold; otherwise leave the join to a shuffle."""
    from pyspark.sql import functions as F
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    limit_b = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")))
    return F.broadcast(df) if 0 <= rows * row_bytes <= limit_b else df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any Hadoop-supported file system."""
    fs, p = file_system(spark, path)
    return fs.exists(p)


def materialise(df, name: str, path: str | None = None, **options):
    """Write ``df`` once as a parquet table under the shared scratch folder
    (or at ``path``, for a caller that frees it) and read it back: cuts lineage,
    survives lost executors, and later passes read only the columns they need."""
    path = path or scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Index tables of the stream job: parquet, dated, one folder per run and batch.

``<root>/<table>/day=<date>/run=<run>/batch_id=<n>``. The day comes from the
records' own time, so a batch that runs again lands on the same days; records
without a time have no day, and upkeep leaves them alone. A batch replaces what
an earlier attempt of it wrote, also when it has no rows now.

Retention drops whole days before a limit that a clock sets, never the newest
record; where rows hold their time, the one day that a limit cuts can be rewritten
to the instant. Compaction rewrites batches that the stream has committed, which it
never runs again, and deletes exactly those: batches that are written meanwhile,
to whatever day, stay. A reader that lists a day in the moment of the swap can
miss it; nothing is lost.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from payguard.session import WIDE, file_system, path_exists

PARTS = T.StructType([T.StructField("day", T.DateType()), T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
#: Where a day's rows are staged (readers skip the name), and the file there that lists what they replace.
STAGED, SOURCES = "_compacting", "_sources"
#: Bytes of a compacted file, about.
FILE_BYTES = 128 * 1024 * 1024


def catalog_name(name: str) -> str:
    """A table's name in the catalog: letters, digits and underscores."""
    return re.sub(r"\W", "_", name)


def table_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + PARTS.fields)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, p = file_system(spark, pattern)
    found = fs.globStatus(p) if p is not None else None
    return [s.getPath().toString() for s in found] if found else []


def drop(spark: SparkSession, pattern: str) -> int:
    """Delete what matches a glob pattern."""
    found = folders(spark, pattern)
    for path in found:
        fs, p = file_system(spark, path)
        fs.delete(p, True)
    return len(found)


def write_batch(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    """``df`` (with its ``day``) as batch ``batch_id`` of ``run``, instead of any earlier attempt."""
    drop(df.sparkSession, f"{path}/day=*/run={run}/batch_id={batch_id}")
    (df.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
       .write.mode("append").options(**WIDE).partitionBy("day", "run", "batch_id").parquet(path))


def move_batch(spark: SparkSession, staged: str, path: str, run: str, batch_id: int) -> None:
    """The dated folders under ``staged`` (none where it is missing) as batch ``batch_id`` of ``run``, instead of any earlier
    attempt. A call that is cut short is made good by the batch's next attempt."""
    drop(spark, f"{path}/day=*/run={run}/batch_id={batch_id}")
    fs, p = file_system(spark, path)
    fs.mkdirs(p)
    for found in folders(spark, f"{staged}/day=*"):
        _, source = file_system(spark, found)
        _, target = file_system(spark, f"{path}/{source.getName()}/run={run}/batch_id={batch_id}")
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"can't move {found} to {target.toString()}")


def drop_other_runs(spark: SparkSession, path: str, run: str) -> None:
    """Delete the rows of every run but ``run``."""
    for found in folders(spark, f"{path}/day=*/run=*"):
        if not found.endswith(f"/run={run}"):
            drop(spark, found)


def read_index(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows with their ``day``, ``run`` and ``batch_id``; no rows before the first write."""
    full = table_schema(schema)
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(path)


def days_of(spark: SparkSession, path: str) -> dict[dt.date, str]:
    """The dated folders of a table."""
    return {dt.date.fromisoformat(f.rsplit("=", 1)[1]): f for f in folders(spark, f"{path}/day=[0-9]*")}


def drop_old_days(spark: SparkSession, path: str, keep_days: int, newest: dt.date | None = None) -> list[dt.date]:
    """Retention: delete the days more than ``keep_days`` days before ``newest``, the caller's
    clock. Without one it is the newest day there is, but never later than today, so
    records with a future time drop nothing. Only folder names are read."""
    days = days_of(spark, path)
    if not days:
        return []
    now = newest or min(max(days), dt.datetime.now(dt.timezone.utc).date())
    gone = sorted(d for d in days if d < now - dt.timedelta(days=keep_days))
    for d in gone:
        drop(spark, days[d])
    return gone


def committed(spark: SparkSession, checkpoint: str) -> int:
    """The newest batch that a checkpoint has committed, -1 if none: Spark runs none of them again."""
    done = [f.rsplit("/", 1)[1] for f in folders(spark, f"{checkpoint}/commits/[0-9]*")]
    return max((int(n) for n in done if n.isdigit()), default=-1)


def _modified(spark: SparkSession, path: str) -> int:
    fs, p = file_system(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def stage_day(spark: SparkSession, path: str, schema: T.StructType, day: dt.date, run: str, files: int | None = None, upto: int | None = None,
              where: Column | None = None) -> bool:
    """Copy the rows of a day's batches up to ``upto`` (default: all there are) to the staged folder
    and list the folders they came from; False if there is only one. With ``where`` only the rows
    that meet it, of one folder too; False if all do."""
    here = f"{path}/day={day.isoformat()}"
    staged = f"{here}/{STAGED}"
    drop(spark, staged)
    number = lambda f: int(f.rsplit("=", 1)[1])
    sources = sorted((f for f in folders(spark, f"{here}/run={run}/batch_id=*") if upto is None or number(f) <= upto), key=number)
    if len(sources) < (2 if where is None else 1):
        return False
    rows = spark.read.schema(schema).parquet(*sources)
    if where is not None:
        kept = rows.where(where)
        if rows.where(~where).isEmpty():
            return False
        rows = kept
    if files is None:
        fs, _ = file_system(spark, here)
        size = sum(fs.getContentSummary(file_system(spark, f)[1]).getLength() for f in sources)
        files = size // FILE_BYTES + 1
    rows.coalesce(files).write.options(**WIDE).parquet(staged)  # splits put together, nothing shuffled
    write_text(spark, f"{staged}/{SOURCES}", "\n".join(f.rsplit("/", 1)[1] for f in sources))
    return True


def swap_day(spark: SparkSession, path: str, day: dt.date, run: str) -> None:
    """Put a complete staged folder in the place of what it lists. A call that is cut short is
    finished by the next one; folders that aren't listed stay."""
    here = f"{path}/day={day.isoformat()}"
    staged = f"{here}/{STAGED}"
    listed = read_text(spark, f"{staged}/{SOURCES}")
    if listed is None:  # cut before the list was written: what is older than the copy is in it
        made = _modified(spark, f"{staged}/_SUCCESS")
        listed = "\n".join(f.rsplit("/", 1)[1] for f in folders(spark, f"{here}/run={run}/batch_id=*") if _modified(spark, f) <= made)
    names = listed.split()
    for name in names:
        drop(spark, f"{here}/run={run}/{name}")
    # Below zero, so no batch is ever written there, and of its own: the newest batch in it makes the number.
    numbers = [int(n.rsplit("=", 1)[1]) for n in names]
    number = -2 - max((n if n >= 0 else -2 - n for n in numbers), default=0)
    fs, source = file_system(spark, staged)
    _, target = file_system(spark, f"{here}/run={run}/batch_id={number}")
    fs.mkdirs(target.getParent())
    fs.rename(source, target)


def compact_day(spark: SparkSession, path: str, schema: T.StructType, day: dt.date, run: str, files: int | None = None, upto: int | None = None) -> None:
    """Rewrite a day's batches up to ``upto`` (the newest committed one, while a stream runs) as
    ``files`` files (default: by their bytes)."""
    staged = f"{path}/day={day.isoformat()}/{STAGED}"
    if path_exists(spark, f"{staged}/_SUCCESS"):
        swap_day(spark, path, day, run)
    if stage_day(spark, path, schema, day, run, files, upto):
        swap_day(spark, path, day, run)


def drop_older(spark: SparkSession, path: str, schema: T.StructType, limit: dt.datetime, run: str, time: str = "timestamp",
               upto: int | None = None) -> list[dt.date]:
    """Retention to the instant: the rows of ``run`` whose ``time`` is before ``limit`` (UTC) go. Days before the limit's
    are dropped by name; of the limit's own day the batches up to ``upto`` are rewritten, staged and swapped as
    in compaction, so a call that is cut short loses nothing; no other day is read. Rows without a time stay. Returns the days dropped."""
    day = limit.date()
    gone = drop_old_days(spark, path, 0, day)
    if path_exists(spark, f"{path}/day={day.isoformat()}/{STAGED}/_SUCCESS"):
        swap_day(spark, path, day, run)
    since = F.lit(limit.isoformat(sep=" ")).cast(schema[time].dataType)
    if stage_day(spark, path, schema, day, run, upto=upto, where=F.coalesce(F.col(time) >= since, F.lit(True))):
        swap_day(spark, path, day, run)
    return gone


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, None if there is none."""
    if not path_exists(spark, path):
        return None
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode().strip()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file in one step: written beside it, then renamed over it."""
    fs, temp = file_system(spark, f"{path}.new")
    out = fs.create(temp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _, p = file_system(spark, path)
    sc = spark.sparkContext
    kind = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    over = sc._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(temp), fs.makeQualified(p), over)

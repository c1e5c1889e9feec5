"""Stored tables: scans, materializations, loads and the shared folder.

A table is Parquet, written by loads that only ever add files: a load is a partition of
the table, with the rows' days below it and buckets by key. Once its rows are
complete a row about it is appended to the loads beside the table, and only loads
named there are read: a run that dies leaves the table as it was. Of several rows
with one key the reader takes the newest; as files are bucketed by key, that needs
no exchange. A full refresh is a load that makes all before it count no more.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LOAD, _NUMBER = "load", "_number"
_LOADS = "batch string, load string, number long, base boolean, keys array<string>, day string, newest_by string, buckets int, columns string"


def scan(spark: SparkSession, table: str) -> DataFrame:
    """A table by its catalog name or, when it holds a slash, by its path."""
    return read_table(spark, table) if "/" in table else spark.table(table)


def save_model(df: DataFrame, name: str, mode: str = "view", path: str | None = None) -> DataFrame:
    """Materialize a model as a ``view``, or as a ``table`` stored at ``path``.

    The incremental mode is ``operators.upsert_table``.
    """
    spark = df.sparkSession
    if mode == "view":
        df.createOrReplaceTempView(name)
        return df
    if mode != "table" or path is None:
        raise ValueError("mode is 'view', or 'table' with a path")
    replace_table(df, path)
    stored = read_table(spark, path)
    stored.createOrReplaceTempView(name)
    return stored


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share, as ``spark.checkpoint.dir`` names it.

    Only a local session without the setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="shelftrack-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def read_if_any(spark: SparkSession, path: str, base: str | None = None) -> DataFrame | None:
    """The Parquet files under ``path``, None if there are none; any other problem is raised."""
    try:
        reader = spark.read if base is None else spark.read.option("basePath", base)
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


# Loads.


def loads(spark: SparkSession, path: str) -> DataFrame | None:
    """The loads that count, the first of each batch; None if there is no such table."""
    known = read_if_any(spark, f"{path.rstrip('/')}-loads")
    if known is None:
        return None
    first = known.groupBy("batch").agg(F.min(F.struct("number", "load", "base", "keys", "day", "newest_by", "buckets", "columns")).alias("row"))
    first = first.select("batch", "row.*")
    base = first.filter("base").agg(F.max("number")).scalar()
    return first.filter(F.col("number") >= F.coalesce(base, F.lit(0)))


def _last(known: DataFrame | None):
    """How many loads count, the last one's number and what it says of the table."""
    return None if known is None else known.agg(F.count("*").alias("n"), F.max(F.struct("number", "load", "keys", "day", "newest_by", "buckets", "columns")).alias("row")).first()


def is_known(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether a batch of this name has been loaded, also before the last full refresh."""
    known = read_if_any(spark, f"{path.rstrip('/')}-loads")
    return known is not None and bool(known.filter(F.col("batch") == batch).limit(1).count())


def is_counted(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether the rows of a batch still count: it was loaded, and not before the last full refresh."""
    known = loads(spark, path)
    return known is not None and bool(known.filter(F.col("batch") == batch).limit(1).count())


def is_table(spark: SparkSession, path: str) -> bool:
    """Whether a table lies at ``path``; one that cannot be read is no reason to say no."""
    try:
        return read_if_any(spark, f"{path.rstrip('/')}-loads") is not None or read_if_any(spark, path) is not None
    except Exception:  # whatever the reader says, there is something to read
        return True


def _files(spark: SparkSession, path: str, columns: str, keys: Sequence[str], day: str | None, buckets: int) -> str:
    """The catalog's name for the files of a table, entered if the catalog does not know it."""
    name = f"shelftrack_{hashlib.md5(path.encode()).hexdigest()}"
    by = [key for key in keys if key != day]
    bucketed = f"CLUSTERED BY ({', '.join(f'`{key}`' for key in by)}) INTO {buckets} BUCKETS" if by and buckets else ""
    parts = ", ".join(["`load`", *([f"`{day}`"] if day else [])])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `load` string) USING parquet PARTITIONED BY ({parts}) {bucketed} LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return name


def add_load(
    rows: DataFrame, path: str, batch: str, keys: Sequence[str] = (), day: str | None = None,
    newest_by: str | None = None, base: bool = False, buckets: int | None = None,
) -> None:
    """Write the rows of a batch, then let them count.

    The first load settles columns, days and buckets: as many buckets as ``buckets`` says or
    half the shuffle partitions.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    last = _last(loads(spark, path))
    if last is None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2) if buckets is None else buckets
        number = 1
    else:
        columns, day, buckets, number = last.row.columns, last.row.day, last.row.buckets, last.row.number + 1
        keys = keys or last.row["keys"]
    files, load = _files(spark, path, columns, keys if last is None else last.row["keys"], day, buckets), uuid.uuid4().hex
    by = [key for key in keys if key != day]
    names = [name for name in spark.table(files).columns if name != _LOAD]
    # One task a bucket, so that a day gets a file for each; without buckets days are brought together.
    given = rows.select(*names)
    given = given.repartition(buckets, *by) if by and buckets else given.hint("rebalance", day) if day else given
    target = f"{files} PARTITION (load = '{load}'{f', `{day}`' if day else ''})"
    cells = [f"`{name}`" for name in names if name != day] + ([f"`{day}`"] if day else [])
    spark.sql(f"INSERT INTO {target} SELECT {', '.join(cells)} FROM {{given}}", given=given)
    _count(spark, path, (batch, load, number, base, list(keys), day, newest_by, buckets, columns))


def _count(spark: SparkSession, path: str, load: tuple) -> None:
    """From now on a load is read."""
    spark.createDataFrame([load], _LOADS).coalesce(1).write.mode("append").parquet(f"{path}-loads")


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the loads that count, also those whose key a later one has again."""
    return _read(spark, path.rstrip("/"))[0].drop(_NUMBER)


def batch_rows(spark: SparkSession, path: str, batch: str) -> DataFrame:
    """The rows one batch gave the table at ``path``; no other load is read. None of a batch that is not known."""
    path = path.rstrip("/")
    known = loads(spark, path)
    found = known.filter(F.col("batch") == batch).select("load").first()
    last = _last(known)
    rows = spark.table(_files(spark, path, last.row.columns, last.row["keys"], last.row.day, last.row.buckets))
    return rows.filter(F.col(_LOAD) == (found.load if found else "")).drop(_LOAD)


def _read(spark: SparkSession, path: str, before: str | None = None):
    known = loads(spark, path)
    last = _last(known)
    if last is None:
        return spark.read.parquet(path), None
    if before is not None:
        known = known.filter(F.col("number") < known.filter(F.col("batch") == before).select("number").scalar())
    rows = spark.table(_files(spark, path, last.row.columns, last.row["keys"], last.row.day, last.row.buckets))
    names = [name for name in rows.columns if name != _LOAD]
    order = [part.split("` ")[0].strip("` ") for part in last.row.columns.split(", `")]
    names.sort(key=order.index)
    if last.n == 1 and before is None:
        rows = rows.filter(F.col(_LOAD) == last.row.load).withColumn(_NUMBER, F.lit(last.row.number))
    else:
        rows = rows.join(known.select(_LOAD, F.col("number").alias(_NUMBER)), _LOAD)
    return rows.select(*names, _NUMBER), last


def read_table(spark: SparkSession, path: str, before: str | None = None) -> DataFrame:
    """The table at ``path``, the newest row of each key; as it was ``before`` a batch, or now. Without loads it is plain Parquet."""
    rows, last = _read(spark, path.rstrip("/"), before)
    if last is None:
        return rows
    if last.n > 1 and last.row["keys"]:
        # The day follows from the key; named here, a filter on it reaches the files.
        keys = dict.fromkeys([*last.row["keys"], *([last.row.day] if last.row.day else [])])
        newest = [F.col(last.row.newest_by).desc_nulls_last()] if last.row.newest_by else []
        window = Window.partitionBy(*keys).orderBy(*newest, F.col(_NUMBER).desc())
        rows = rows.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    return rows.drop(_NUMBER)


def replace_table(df: DataFrame, path: str, partition: str | None = None, keys: Sequence[str] = (), newest_by: str | None = None) -> None:
    """Write a table from scratch; batches it has seen stay known. ``df`` may read the table itself."""
    add_load(df, path, f"base-{uuid.uuid4().hex}", keys, partition, newest_by, base=True)

"""Landed CSV files: one folder per source, text columns bound by name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.functions.text import as_column, null_if_missing, strip_space
from shelftrack.session import ship
from shelftrack.sources.landing_source import NAME, LandingSource

# Landed files hold line breaks inside quotes, so each is read by one task;
# the writer bounds their size instead.
ROWS_PER_FILE = 1_000_000


def _source_globs(root: str, sources: Sequence[str]) -> str:
    """Folders named by the source, plain or as ``source=name`` partitions."""
    names = ",".join(f"{s},source={s}" for s in sources)
    return f"{root.rstrip('/')}/{{{names}}}"


def source_of(path: Column | str) -> Column:
    return F.regexp_extract(as_column(path), r"([^/=]+)/[^/]+\z", 1)


def _listing(spark: SparkSession, root: str, sources: Sequence[str]) -> DataFrame:
    try:
        return (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.csv")
            .load(_source_globs(root, sources))
            .select("path", "modificationTime", "length")
        )
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long")


def landed_files(spark: SparkSession, root: str, sources: Sequence[str] = fixed.SOURCES) -> DataFrame:
    """The landed files with their source and size; contents are not read. Files without a byte are in ``scan_landing`` only."""
    listed = _listing(spark, root, sources)
    return listed.select("path", source_of("path").alias("source"), "modificationTime", "length")


def missing_sources(
    spark: SparkSession, landed: DataFrame, expected: Sequence[str] = fixed.SOURCES
) -> DataFrame:
    """Expected sources without a single landed file; empty means the landing is complete."""
    wanted = spark.createDataFrame([(s,) for s in expected], "source string")
    return wanted.join(landed.select("source").distinct(), "source", "left_anti")


def scan_landing(
    spark: SparkSession, root: str, sources: Sequence[str] = fixed.SOURCES, required: Sequence[str] = fixed.REQUIRED_COLUMNS
) -> DataFrame:
    """All landed records of the sources as stripped text, and a row of ``line`` 0 for every file.

    One scan, see ``landing_source``. Missing cells are NULL. ``surplus`` marks records with more
    fields than their file's header, ``lacking`` names the required columns that a file does not have; such a
    file gives no records.
    """
    return tidy(_options(spark, spark.read, sources, required).load(root), required)


def _options(spark: SparkSession, reader, sources: Sequence[str], required: Sequence[str]):
    ship(spark)
    spark.dataSource.register(LandingSource)
    return reader.format(NAME).option("sources", ",".join(sources)).option("required", ",".join(required))


def tidy(scanned: DataFrame, required: Sequence[str] = fixed.REQUIRED_COLUMNS) -> DataFrame:
    cells = [F.nullif(strip_space(null_if_missing(c)), F.lit("")).alias(c) for c in required]
    return scanned.select(*cells, "file", "source", "line", "surplus", "lacking")


def stream_landing(
    spark: SparkSession,
    root: str,
    sources: Sequence[str] = fixed.SOURCES,
    required: Sequence[str] = fixed.REQUIRED_COLUMNS,
    settle: float | None = None,
) -> DataFrame:
    """``scan_landing`` as a stream: every file once, in the order of their times."""
    reader = _options(spark, spark.readStream, sources, required)
    return tidy((reader if settle is None else reader.option("settle", settle)).load(root), required)


def skipped_files(scanned: DataFrame) -> DataFrame:
    """Files left out as a whole, and the columns they lack."""
    return scanned.filter((F.col("line") == 0) & (F.size("lacking") > 0)).select("file", "source", F.col("lacking").alias("missing"))


def records(scanned: DataFrame) -> DataFrame:
    """The records of a scan, without the files' own rows."""
    return scanned.filter(F.col("line") > 0).drop("lacking")


def project_required(df: DataFrame, required: Sequence[str] = fixed.REQUIRED_COLUMNS) -> DataFrame:
    return df.select(*required)


def strip_all(df: DataFrame) -> DataFrame:
    """Strip white space in every text column."""
    return df.select(
        *[strip_space(name).alias(name) if kind == "string" else F.col(name) for name, kind in df.dtypes]
    )


def append_batches(batches: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), batches)


def read_landing(
    spark: SparkSession,
    root: str,
    sources: Sequence[str] = fixed.SOURCES,
    required: Sequence[str] = fixed.REQUIRED_COLUMNS,
) -> DataFrame:
    """All landed records of the sources with their ``file``, ``source``, ``line`` and ``surplus`` mark; files that lack a column are left out."""
    return records(scan_landing(spark, root, sources, required))


def stamp_scraped_at(df: DataFrame, ts: str | Column | None = None) -> DataFrame:
    """One UTC time for the whole batch, as landed files write it."""
    moment = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp") if isinstance(ts, str) else ts
    return df.withColumn("scraped_at", F.concat(F.date_format(moment, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))


def write_landing(df: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Land a batch of records with a ``source`` column; an empty batch writes no file.

    A list-valued description is joined by line breaks.
    """
    if dict(df.dtypes).get("description", "string").startswith("array"):
        df = df.withColumn("description", F.array_join("description", "\n"))
    (
        df.select("source", *fixed.REQUIRED_COLUMNS)
        .write.mode("append")
        .partitionBy("source")
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("maxRecordsPerFile", rows_per_file)
        .csv(f"{root.rstrip('/')}/{fixed.LANDING_FOLDER}")
    )

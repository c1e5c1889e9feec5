"""The raw table: whole files are accepted or refused.

A batch parses its landed files once, into Parquet beside the table, and counts
rows and bad rows on the way. Files are admitted by their counts, and the batch's
own folder of the table is replaced as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.schemas import raw_schema
from shelftrack.sources.tables import read_if_any


def parse_scraped_at(c: Column) -> Column:
    """Time of a landed row: its own format, or an ISO time."""
    return F.coalesce(F.try_to_timestamp(c, F.lit(fixed.SCRAPED_AT_FORMAT)), c.try_cast("timestamp"))


def violation(required: Sequence[str] = fixed.REQUIRED_VALUES, marked: bool = True) -> Column:
    """The first constraint a landed row breaks, NULL for a good row; ``marked`` rows tell of surplus fields."""
    surplus = [F.when(F.col("surplus"), "more fields than the header")] if marked else []
    missing = [F.when(F.col(c).isNull(), f"{c} is null") for c in required]
    too_long = F.when(F.length("currency") > fixed.CURRENCY_LENGTH, "currency is too long")
    no_time = F.when(parse_scraped_at(F.col("scraped_at")).isNull(), "scraped_at is no time")
    return F.coalesce(*surplus, *missing, too_long, no_time)


def load_metrics(scanned: DataFrame) -> DataFrame:
    """Rows, bad rows and the reason for refusal per file of a landing scan or of its records.

    A scan tells of files without rows too. Files that lack a column count as skipped, not here.
    """
    return _metrics(scanned, violation(marked="surplus" in scanned.columns))


def _metrics(scanned: DataFrame, reason: Column) -> DataFrame:
    if "lacking" in scanned.columns:
        scanned = scanned.filter(F.col("lacking").isNull() | (F.size("lacking") == 0))
    # A file's own row is no record.
    record = F.col("line") > 0
    return scanned.groupBy("file", "source").agg(
        F.count(F.when(record, 1)).alias("rows"),
        F.count(F.when(record, reason)).alias("bad_rows"),
        F.min(F.when(record, reason)).alias("reason"),
    )


def loaded_total(metrics: DataFrame) -> DataFrame:
    """Files and rows loaded and files refused, in one row."""
    good = F.col("bad_rows") == 0
    return metrics.agg(
        F.count(F.when(good, 1)).alias("files_loaded"),
        F.coalesce(F.sum(F.when(good, F.col("rows"))), F.lit(0)).alias("rows_loaded"),
        F.count(F.when(~good, 1)).alias("files_refused"),
    )


def split_by_constraint(landed: DataFrame, metrics: DataFrame, batch: str = "0") -> tuple[DataFrame, DataFrame]:
    """Records of accepted files as raw rows, and records of refused files with the reason.

    A single bad row refuses its whole file. Spark broadcasts the refused file
    names when they are few and shuffles on the file name otherwise.
    """
    refused = metrics.filter(F.col("bad_rows") > 0).select("file", "reason")
    accepted = landed.join(refused, "file", "left_anti")
    return as_raw(accepted, batch), landed.join(refused, "file")


def as_raw(landed: DataFrame, batch: str = "0") -> DataFrame:
    """Typed raw rows; the id is made of the batch, the file and the record's number in it."""
    typed = landed.select(
        F.concat_ws(":", F.lit(batch), "file", "line").alias("id"),
        *[c for c in fixed.RECORD_FIELDS if c not in ("currency", "publisher", "description")],
        F.coalesce("currency", F.lit(fixed.CURRENCY)).alias("currency"),
        "publisher",
        "description",
        parse_scraped_at(F.col("scraped_at")).alias("scraped_at"),
    )
    return typed.select(*raw_schema().names)


def append_raw(spark: SparkSession, scanned: DataFrame, path: str, batch: str, quarantine: str | None = None) -> DataFrame:
    """Append the accepted files of a landing scan to the raw table and return the load metrics.

    The scan is parsed once; what it gives stays in ``<path>-parsed`` by batch and may be
    deleted at any time. Rows are stored by batch and scan day, so a reader with a
    watermark skips old days. A repeated batch replaces all it has stored: raw rows, refused rows
    and metrics, whatever its files held before. Ids follow from batch, file and record.
    """
    path = path.rstrip("/")
    parsed, counts = f"{path}-parsed/batch={batch}", Observation()
    reason = F.when(F.col("line") > 0, violation(marked="surplus" in scanned.columns))
    marked = scanned.withColumn("reason", reason).observe(counts, F.count("reason").alias("bad"))
    marked.write.mode("overwrite").parquet(parsed)
    rows = spark.read.parquet(parsed)
    _metrics(rows, F.col("reason")).write.mode("overwrite").parquet(f"{path}-metrics/batch={batch}")
    metrics = spark.read.parquet(f"{path}-metrics/batch={batch}")
    landed = rows.filter(F.col("line") > 0).drop("reason", "lacking")
    if counts.get["bad"]:
        accepted, refused = split_by_constraint(landed, metrics, batch)
    else:
        accepted, refused = as_raw(landed, batch), None
    stored = accepted.withColumn("scrape_day", F.to_date("scraped_at"))
    stored.write.mode("overwrite").partitionBy("scrape_day").parquet(f"{path}/batch={batch}")
    if quarantine:
        refused = landed.withColumn("reason", F.lit(None).cast("string")).limit(0) if refused is None else refused
        refused.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={batch}")
    return metrics


def read_batch(spark: SparkSession, path: str, batch: str) -> DataFrame | None:
    """The raw rows of one batch, without listing the others; None if all were refused."""
    return read_if_any(spark, f"{path}/batch={batch}", path)

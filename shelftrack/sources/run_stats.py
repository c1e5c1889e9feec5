"""Run statistics: one row and one nested document per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.functions.dates import seconds_between
from shelftrack.schemas import stats_schema


def run_stats(items: DataFrame, source: str, ts: str, requests: str | None = None, responses: str | None = None) -> DataFrame:
    """Counts, first and last time and duration per source.

    ``requests`` and ``responses`` name flag columns to be counted where true;
    a counter that is not kept is 0.
    """
    def counted(flag: str | None) -> Column:
        total = F.sum(F.col(flag).cast("int")) if flag else F.lit(None).cast("long")
        return F.coalesce(total, F.lit(0)).cast("long")

    stats = items.groupBy(F.col(source).alias("spider_name")).agg(
        F.count("*").alias("item_scraped_count"),
        counted(responses).alias("response_received_count"),
        counted(requests).alias("request_count"),
        F.min(ts).alias("start_time"),
        F.max(ts).alias("finish_time"),
    )
    return stats.withColumn("duration", seconds_between("start_time", "finish_time"))


def counters_to_stats(counters: DataFrame) -> DataFrame:
    """Stats from reported counters: missing counts are 0, unreadable times NULL."""
    counts = [
        F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
        for c in ("item_scraped_count", "response_received_count", "request_count")
    ]
    times = [F.col(c).try_cast("timestamp").alias(c) for c in ("start_time", "finish_time")]
    duration = seconds_between("start_time", "finish_time").alias("duration")
    return counters.select("spider_name", *counts, *times, duration)


def stats_document(stats: DataFrame, reason: str = "finished", stamp: Column | None = None) -> DataFrame:
    """The nested document of every run, with its source beside it."""
    stamp = F.current_timestamp() if stamp is None else stamp
    return stats.select(
        F.col("spider_name").alias("source"),
        F.col("spider_name").alias("spider"),
        F.struct(
            F.col("item_scraped_count").alias("items_scraped"),
            F.col("response_received_count").alias("responses_received"),
            F.col("request_count").alias("requests_made"),
            F.col("start_time").cast("string").alias("start_time"),
            F.col("finish_time").cast("string").alias("finish_time"),
            F.col("duration").alias("duration_seconds"),
            F.lit(reason).alias("completion_reason"),
        ).alias("stats"),
        F.struct(
            F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            F.lit(fixed.PROJECT_VERSION).alias("project_version"),
        ).alias("metadata"),
    )


def stats_json(documents: DataFrame) -> DataFrame:
    """The documents as JSON text."""
    return documents.select("source", F.to_json(F.struct("spider", "stats", "metadata")).alias("document"))


def write_stats_json(documents: DataFrame, root: str) -> None:
    documents.write.mode("append").partitionBy("source").json(f"{root.rstrip('/')}/{fixed.STATS_FOLDER}")


def append_stats_table(stats: DataFrame, path: str, run_timestamp: Column | None = None) -> None:
    """Append run stats to the monitoring table, as declared; its clock runs a fixed shift ahead of UTC."""
    if run_timestamp is None:
        run_timestamp = F.current_timestamp() + F.make_dt_interval(hours=F.lit(fixed.MONITORING_CLOCK_SHIFT_HOURS))
    rows = stats.withColumn("run_timestamp", run_timestamp).withColumn("id", F.expr("uuid()"))
    # Times of sources without a zone are UTC.
    rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stats_schema()]).write.mode("append").parquet(path)

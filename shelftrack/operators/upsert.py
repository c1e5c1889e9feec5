"""Watermark-incremental tables.

A batch holds the rows newer than what the target has seen; its rows replace
target rows of the same key and all others stay. A stored table only ever gets
files added: a batch costs what it holds, whatever the table holds, and readers
take the newest row of a key, see ``sources.tables``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftrack.operators.aggregates import high_watermark
from shelftrack.operators.ranking import latest_per_key
from shelftrack.sources.tables import add_load, is_known, read_table, replace_table

_BEFORE_ALL = "0001-01-01 00:00:00"


def newer_than(
    new: DataFrame,
    target: DataFrame | None,
    ts: str,
    target_ts: str | None = None,
    by: str | None = None,
    partition: str | None = None,
    day: str | None = None,
) -> DataFrame:
    """Rows of ``new`` above the target's high watermark; late rows drop out.

    Without a target, or with an empty one, every row is new. ``by`` keeps one
    watermark per value of a column (one per source, say), so that a source
    which reports late is not measured by the others. ``partition`` is the
    target's day partition and ``day`` that of ``new``: with them only the
    last day of the target and no older day of ``new`` is read.
    """
    if target is None:
        return new
    marks = high_watermark(target, target_ts or ts, by, partition)
    if by is not None:
        # One row per source, sent to where the rows lie: exchanged by it, all rows of a source would meet in one task.
        marked = new.join(F.broadcast(marks), by, "left")
        return marked.filter(F.col("watermark").isNull() | (F.col(ts) > F.col("watermark"))).drop("watermark")
    least = F.lit(_BEFORE_ALL).cast(new.schema[ts].dataType)
    floor = marks.select(F.coalesce("watermark", least)).scalar()
    fresh = new.filter(F.col(ts) > floor)
    return fresh if day is None else fresh.filter(F.col(day) >= F.to_date(floor))


def upsert(target: DataFrame | None, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``new``, and all of ``new``.

    ``new`` must hold one row per key; reduce it with ``latest_per_key`` first.
    """
    if target is None:
        return new
    return target.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def newest(target: DataFrame, new: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Of old and new rows the latest per key; a new row wins a tie."""
    both = target.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return latest_per_key(both, keys, ts, ["_new"]).drop("_new")


def full_refresh(
    spark: SparkSession, new: DataFrame, path: str, partition: str | None = None, keys: Sequence[str] = (), newest_by: str | None = None
) -> DataFrame:
    """Write a table from scratch, with no watermark; with ``keys`` batches may be upserted into it."""
    replace_table(new, path, partition, keys, newest_by)
    return read_table(spark, path)


def upsert_table(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    keys: Sequence[str],
    partition: str | None,
    batch: str,
    newest_by: str | None = None,
) -> DataFrame:
    """Upsert ``new`` into the stored table at ``path``.

    A batch whose name the table knows changes nothing, whatever came after it; a run that died
    before its load counted left the table as it was and is simply repeated.
    Batch names must not be used twice for different rows. ``partition`` is a date
    column that the key determines, None for a table without days. A new row replaces the old one of its key;
    with ``newest_by`` the later of the two stays (of equal ones the new), so that batches may come in any
    order. What the last load says of ``keys`` and ``newest_by`` holds for the table.
    """
    if not is_known(spark, path, batch):
        add_load(new, path, batch, keys, partition, newest_by)
    return read_table(spark, path)

"""The incremental load as a stream over landed files.

The stream reads every landed file once, by the source's own offsets. A
micro-batch is parsed once, into the raw table, under a name made of the
stream's id and the micro-batch's number, so that a repeated micro-batch
replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelftrack import fixed_values as fixed
from shelftrack.plans.warehouse import Warehouse
from shelftrack.sources.landing import stream_landing
from shelftrack.sources.raw_table import append_raw, read_batch


def landing_stream(
    spark: SparkSession, root: str, sources: Sequence[str] = fixed.SOURCES, settle: float | None = None
) -> DataFrame:
    """Records of landed files as they arrive, and a row for each file; ``settle`` seconds pass before a file is taken."""
    return stream_landing(spark, root, sources, settle=settle)


def _each_batch(
    scanned: DataFrame, checkpoint: str, handle: Callable[[DataFrame, str], None]
) -> StreamingQuery:
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        handle(batch, f"{stream}-{batch_id:012d}")

    return (
        scanned.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_stream(
    scanned: DataFrame, raw_path: str, checkpoint: str, quarantine: str | None = None
) -> StreamingQuery:
    """Append arriving files to the raw table."""

    def handle(landed: DataFrame, batch: str) -> None:
        append_raw(landed.sparkSession, landed, raw_path, batch, quarantine)

    return _each_batch(scanned, checkpoint, handle)


def streaming_upsert(
    scanned: DataFrame,
    warehouse: Warehouse,
    dim_date: DataFrame,
    checkpoint: str,
    as_of: Column | None = None,
    ignore_late: bool = False,
) -> StreamingQuery:
    """Keep raw, staging and facts current with arriving files.

    Files of different sources arrive in any order, and of every book and day
    the latest scan wins whatever file it came in: the result equals one full
    refresh over all files. ``ignore_late`` applies the rule of the scheduled
    batch run instead, by which rows at or below the watermark of what is
    loaded are left out.
    """

    def handle(landed: DataFrame, batch: str) -> None:
        spark = landed.sparkSession
        append_raw(spark, landed, warehouse.path("raw"), batch, warehouse.path("quarantine"))
        loaded = read_batch(spark, warehouse.path("raw"), batch)
        if loaded is None:
            return
        if ignore_late:
            warehouse.update_staging(loaded, batch, as_of)
            warehouse.update_facts(dim_date, batch)
        else:
            warehouse.apply_batch(loaded, dim_date, batch, as_of)

    return _each_batch(scanned, checkpoint, handle)

"""The upsert as a stateful stream: of every key the newest row, however rows arrive.

State holds a time and a tie per key, in the state store on the executors and its
checkpoint. Rows at or below the watermark are ignored as late. What the state of a key is for
ends once the watermark reaches its newest row, as any row that still comes is
newer then: a timer removes it.

Keys are dealt out over buckets, and the state of a bucket is one value, a small table of
its keys: a call of Python and of the store is made for a bucket, not for a key, and
what it does inside is done for all keys at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from shelftrack.functions.text import as_column
from shelftrack.session import ship
from shelftrack.sources.tables import add_load, is_known

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# pandas would rename names that begin with a low line
_BUCKET, _KEY, _STAMP, _TIE = "newest_bucket", "newest_key", "newest_stamp", "newest_tie"
_MARKS = [_KEY, _STAMP, _TIE]
# Buckets of keys: as many calls a micro-batch at most. Ten million keys make buckets of 10,000, some 600 KB of state.
BUCKETS = 1024


def _newest(rows: pd.DataFrame) -> pd.DataFrame:
    """Of each key the row of the greatest time and tie."""
    return rows.sort_values([_STAMP, _TIE], kind="stable").drop_duplicates(_KEY, keep="last")


class Newest(StatefulProcessor):
    """Passes on of each key of a bucket the newest row, if it is newer than all rows of the key so far."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "marks binary, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for part in rows:
            # One row a key is kept, however many come.
            best = _newest(part if best is None else pd.concat([best, part]))
        if best is None:
            return
        known, timer = self._read()
        at = pd.Index(known[_KEY]).get_indexer(best[_KEY])
        seen = at >= 0
        stamp, tie = best[_STAMP].to_numpy(), best[_TIE].to_numpy()
        newer = ~seen
        stamp_known, tie_known = known[_STAMP].to_numpy()[at[seen]], known[_TIE].to_numpy()[at[seen]]
        newer[seen] = (stamp[seen] > stamp_known) | ((stamp[seen] == stamp_known) & (tie[seen] > tie_known))
        if not newer.any():
            return
        changed = best[newer]
        stays = np.ones(len(known), bool)
        stays[at[seen & newer]] = False
        self._write(pd.concat([known[stays], changed[_MARKS]]), timer, timerValues)
        yield changed.drop(columns=[_BUCKET, *_MARKS])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known, _ = self._read()
        self._write(known, None, timerValues)
        yield from ()

    def _read(self) -> tuple[pd.DataFrame, int | None]:
        if not self.known.exists():
            return pd.DataFrame({_KEY: pd.Series(dtype=object), _STAMP: np.zeros(0, "int64"), _TIE: np.zeros(0, "int64")}), None
        marks, timer = self.known.get()
        return pa.ipc.open_stream(bytes(marks)).read_all().to_pandas(), timer

    def _write(self, known: pd.DataFrame, timer: int | None, timerValues) -> None:
        """Store what the watermark has not reached. The timer is set to where half of that has ended, so a key's end costs the same however many there are."""
        expiry = _expiry(known[_STAMP].to_numpy())
        left = expiry > timerValues.getCurrentWatermarkInMs()
        if timer is not None:
            self.handle.deleteTimer(timer)
        if not left.any():
            self.known.clear()
            return
        timer = int(np.sort(expiry[left])[left.sum() // 2])
        table = pa.Table.from_pandas(known[left], pa.schema([(_KEY, pa.string()), (_STAMP, pa.int64()), (_TIE, pa.int64())]), preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema.remove_metadata()) as writer:
            writer.write_table(table.replace_schema_metadata())
        self.known.update((sink.getvalue().to_pybytes(), timer))
        self.handle.registerTimer(timer)

    def close(self) -> None:
        pass


def _expiry(stamp: np.ndarray) -> np.ndarray:
    """The first millisecond that is no earlier."""
    return np.maximum(0, -(-stamp // 1000))


def _key_text(keys: Sequence[str]) -> Column:
    """A text for each combination of key values, nulls and microseconds told apart."""
    return F.to_json(F.struct(*keys), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def newest_per_key(
    rows: DataFrame, keys: Sequence[str], ts: str, late: str, tie: Column | str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """The stream of those rows that are newer, when they come, than all before of their key.

    The newest row of a key so far is the last that was passed on. ``late`` is how far a row may lie
    behind the newest time of all rows up to the micro-batch before the last one, as an interval; older
    ones are dropped, and with them rows without a time. Of rows of one time that of the larger ``tie``, a number, is newer; a row
    that comes again is not. How many ``buckets`` keys are dealt out over must not change while a checkpoint is used.
    """
    spark = rows.sparkSession
    ship(spark)
    if spark.conf.get(_STORE) != _ROCKS:
        spark.conf.set(_STORE, _ROCKS)  # the only store that keeps timers
    tie = F.lit(0) if tie is None else as_column(tie)
    marks = [F.unix_micros(F.col(ts).cast("timestamp")).alias(_STAMP), F.coalesce(tie.cast("long"), F.lit(-(2**63))).alias(_TIE)]
    placed = [F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias(_BUCKET), _key_text(keys).alias(_KEY)]
    marked = rows.filter(F.col(ts).isNotNull()).withWatermark(ts, late).select("*", *placed, *marks)
    return marked.groupBy(_BUCKET).transformWithStateInPandas(
        statefulProcessor=Newest(), outputStructType=rows.schema, outputMode="Update", timeMode="EventTime"
    )


def state_upsert(
    rows: DataFrame, path: str, keys: Sequence[str], ts: str, day: str, checkpoint: str, late: str, tie: Column | str | None = None
) -> StreamingQuery:
    """Keep the stored table at ``path`` current with a stream of rows.

    Only rows that change the table are written, a load for each micro-batch; one that is
    repeated writes nothing. ``day`` is a date column that the key determines.
    """

    def on_batch(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        stream = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        name = f"{stream}-{number:012d}"
        if not is_known(spark, path, name):
            add_load(batch, path, name, keys, day, ts)

    changed = newest_per_key(rows, keys, ts, late, tie)
    writer = changed.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(on_batch).trigger(availableNow=True).start()

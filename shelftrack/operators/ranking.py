"""Latest rows, caps per group and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelftrack.functions.text import as_column

# Up to this rank Spark itself keeps only each task's best rows of a group
# before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
_LOCAL_RANK_LIMIT = 1000


def _ranked(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def _newest_first(ts: Column | str, tiebreak: Sequence[Column | str]) -> list[Column]:
    ties = [as_column(c).desc_nulls_last() for c in tiebreak]
    return [as_column(ts).desc_nulls_first(), *ties]


def latest_per_key(
    df: DataFrame, keys: Sequence[Column | str], ts: Column | str, tiebreak: Sequence[Column | str] = ()
) -> DataFrame:
    """The newest row of every key; ``tiebreak`` settles equal times.

    Tasks drop all but one row of a key before the shuffle, so a key that
    holds most of the rows costs no more than any other.
    """
    return _ranked(df, keys, _newest_first(ts, tiebreak), 1)


def latest_per_key_per_day(
    df: DataFrame,
    keys: Sequence[Column | str],
    ts: Column | str,
    day: Column | None = None,
    tiebreak: Sequence[Column | str] = (),
) -> DataFrame:
    """The newest row of every key and calendar day."""
    day = F.to_date(as_column(ts)) if day is None else day
    return _ranked(df, [*keys, day], _newest_first(ts, tiebreak), 1)


def per_source_cap(
    df: DataFrame, n: int, order: Sequence[Column | str], source: str = "source", spread: int = 64
) -> DataFrame:
    """At most ``n`` rows per source, first by ``order``.

    Large caps are taken in two steps: the best ``n`` of each of ``spread``
    slices of a source, dealt out by the partition rows lie in, then the best
    ``n`` of those, so that no task sorts a whole source.
    """
    order = [as_column(c) for c in order]
    if n > _LOCAL_RANK_LIMIT:
        sliced = df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(spread)))
        df = _ranked(sliced, [source, "_slice"], order, n).drop("_slice")
    return _ranked(df, [source], order, n)


def sample_per_source(df: DataFrame, n: int, key: str, source: str = "source") -> DataFrame:
    """The ``n`` rows of each source whose keys have the smallest hashes; all, if it has no more.

    Hashes are spread evenly, so of a source of many rows only those below twice the share that ``n``
    is of it are ranked. Should that leave too few, its rows are ranked as a whole.
    """
    mark, left, total = F.xxhash64(key), "_left", "_total"
    totals = df.groupBy(F.col(source).alias("_of")).agg(F.count("*").alias(total))
    known = df.join(totals, F.col(source).eqNullSafe(F.col("_of"))).drop("_of")
    share = mark.cast("double") / F.lit(2.0**64) + 0.5
    few = known.filter(share * F.col(total) < 2.0 * n)
    kept = few.groupBy(F.col(source).alias("_of"), total).agg(F.count("*").alias(left))
    enough = kept.filter(F.col(left) >= F.least(F.lit(n), F.col(total))).select("_of")
    same = F.col(source).eqNullSafe(F.col("_of"))
    chosen = few.join(enough, same, "left_semi").unionByName(known.join(enough, same, "left_anti"))
    return _ranked(chosen, [source], [mark, F.col(key)], n).drop(total)


def top_k(df: DataFrame, by: Column | str, k: int, tiebreak: Sequence[Column | str] = ()) -> DataFrame:
    """The ``k`` largest values, NULLs first as in the default descending order of SQL stores."""
    return df.orderBy(as_column(by).desc_nulls_first(), *tiebreak).limit(k)

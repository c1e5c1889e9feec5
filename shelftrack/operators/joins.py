"""Joins against dimensions and key sets.

Sides whose size is bounded by construction, such as a calendar, are
broadcast. All other sides carry no hint: Spark broadcasts them when their
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles. ``skew_join`` is for shuffled joins whose left keys are uneven.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrack.functions.text import as_column

_SALT = "_salt"


def left_join_dim(
    fact: DataFrame, dim: DataFrame, on: Column | str | list[str], bounded: bool = False
) -> DataFrame:
    """Attach a dimension and keep unmatched fact rows with NULLs.

    ``bounded`` marks a dimension that cannot grow with the facts.
    """
    return fact.join(F.broadcast(dim) if bounded else dim, on, "left")


def hot_keys(df: DataFrame, on: Sequence[str], rows_per_slice: int, max_hot: int = 1000) -> DataFrame:
    """The most frequent keys and into how many slices to cut each.

    At most ``max_hot`` rows, so the result may be broadcast at any scale; a
    key beyond them holds less than one ``max_hot``-th of all rows.
    """
    counts = df.groupBy(*on).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_slice)
    slices = F.ceil(F.col("_n") / F.lit(rows_per_slice)).cast("int")
    return counts.orderBy(F.col("_n").desc(), *on).limit(max_hot).select(*on, slices.alias("_slices"))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    rows_per_slice: int = 5_000_000,
    max_hot: int = 1000,
) -> DataFrame:
    """Equi-join (inner, left, left_semi, left_anti) that survives hot left keys.

    Rows of a hot key are dealt out over slices by a hash of the whole row,
    which a repeated task finds unchanged however the rows lie, and the right
    rows of that key, few by contract, are repeated once per slice. All other keys keep a single
    slice. Every left row still meets every right row of its key exactly once.
    NULL keys match nothing and are dealt out freely.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join cannot do {how!r}")
    on = list(on)
    hot = F.broadcast(hot_keys(left, on, rows_per_slice, max_hot))
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    left_slices = F.when(_known(on), slices).otherwise(max_hot)
    dealt = (
        left.join(hot, on, "left")
        .withColumn(_SALT, F.pmod(F.xxhash64(*left.columns), left_slices))
        .drop("_slices")
    )
    repeated = (
        right.join(hot, on, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices")
    )
    return dealt.join(repeated, [*on, _SALT], how).drop(_SALT)


def attach_group_max(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Every row with the greatest ``value`` of its group.

    The group maximum is aggregated, with partial results before the shuffle,
    and joined back: one row per group, so adaptive execution may split a group
    that piles up. A window over whole groups would put it into one task.
    """
    best = df.groupBy(*keys).agg(F.max(value).alias(name))
    return df.join(best, list(keys), "left")


def _known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _key_set(df: DataFrame, column: Column | str, name: str) -> DataFrame:
    """Distinct keys: repeats collapse before the shuffle, so none stays hot."""
    return df.select(as_column(column).alias(name)).distinct()


def missing_in(df: DataFrame, column: str, other: DataFrame, other_column: Column | str) -> DataFrame:
    """Rows whose key does not occur in ``other``; rows with a NULL key included."""
    return df.join(_key_set(other, other_column, column), column, "left_anti")


def present_in(df: DataFrame, column: str, other: DataFrame, other_column: Column | str) -> DataFrame:
    """Rows whose key occurs in ``other``."""
    return df.join(_key_set(other, other_column, column), column, "left_semi")

"""Grouped and global aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.functions.text import as_column


def group_stats(df: DataFrame, keys: Sequence[str], distinct: str, value: str) -> DataFrame:
    """Distinct items and mean, least and greatest value per group."""
    return df.groupBy(*keys).agg(
        F.count_distinct(distinct).alias("distinct_count"),
        F.avg(value).alias("average_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


def first_per_key(df: DataFrame, key: str, value: Column | str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(as_column(value)).alias(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keys that occur more than once, with their row counts; NULL keys do not count."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rows = df.filter(known if where is None else known & where)
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def high_watermark(df: DataFrame, ts: str, by: str | None = None, partition: str | None = None) -> DataFrame:
    """Latest time seen, overall or per ``by``; an empty table has none.

    ``partition`` names a partition column that grows with ``ts``: only its
    last partition is read then.
    """
    if by is not None:
        return df.groupBy(by).agg(F.max(ts).alias("watermark"))
    if partition is not None:
        last = df.agg(F.max(partition)).scalar()
        df = df.filter(F.col(partition) == last)
    return df.agg(F.max(ts).alias("watermark"))


def price_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with mean and sample deviation of every column."""
    values = [F.col(c).cast("double") for c in columns]
    means = [F.avg(v).alias(f"avg_{c}") for c, v in zip(columns, values)]
    spreads = [F.stddev_samp(v).alias(f"stddev_{c}") for c, v in zip(columns, values)]
    return df.agg(*means, *spreads)


def moments(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Count, mean and sum of squared deviations of every column, a row for each value of ``by``.

    Such rows of different days can be put together, see ``merged_statistics``.
    """
    cells = []
    for c in columns:
        v = F.col(c).cast("double")
        cells += [F.count(v).alias(f"n_{c}"), F.avg(v).alias(f"mean_{c}"), (F.var_pop(v) * F.count(v)).alias(f"squares_{c}")]
    return df.groupBy(by).agg(*cells)


def merged_statistics(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``price_statistics`` of all rows that ``moments`` was taken of.

    Squares about the common mean are those about a part's own and the part's count times its
    mean's squared distance; the means come first, so that no large numbers cancel.
    """
    weighted = [F.sum(F.col(f"n_{c}") * F.col(f"mean_{c}")) for c in columns]
    centre = parts.agg(F.struct(*[(w / F.sum(f"n_{c}")).alias(c) for w, c in zip(weighted, columns)]).alias("mean")).scalar()
    cells = []
    for c in columns:
        mean, n = centre.getField(c), F.sum(f"n_{c}")
        squares = F.sum(F.col(f"squares_{c}") + F.col(f"n_{c}") * (F.col(f"mean_{c}") - mean) ** 2)
        cells += [F.max(F.when(F.col(f"n_{c}") > 0, mean)).alias(f"avg_{c}"), F.when(n > 1, F.sqrt(squares / (n - 1))).alias(f"stddev_{c}")]
    return parts.agg(*cells)


def upper_outliers(
    df: DataFrame, columns: Sequence[str], deviations: float = fixed.OUTLIER_DEVIATIONS, stats: DataFrame | None = None
) -> DataFrame:
    """Rows in which any column lies more than ``deviations`` above its mean.

    ``stats`` are statistics taken elsewhere, by default those of ``df``. The one row of statistics comes in as a scalar subquery, not as a join. A
    bound is NULL, and so excludes nothing, where the deviation is NULL or 0.
    """
    stats = price_statistics(df, columns) if stats is None else stats
    bounds = stats.select(
        F.struct(
            *[
                F.when(F.col(f"stddev_{c}") > 0, F.col(f"avg_{c}") + deviations * F.col(f"stddev_{c}")).alias(c)
                for c in columns
            ]
        )
    ).scalar()
    beyond = [F.col(c).cast("double") > bounds.getField(c) for c in columns]
    return df.filter(reduce(lambda a, b: a | b, [F.coalesce(b, F.lit(False)) for b in beyond]))

"""The star schema: dimensions, bridge and the daily price fact.

Keys of authors and publishers are hashes of their names, so the bridge, the
book dimension and the fact can compute them and need no join. Where a
dimension is passed in, it is joined and decides which keys exist.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftrack.functions import calendar_columns, month_start, not_blank, split_list, surrogate_key
from shelftrack.operators.generators import as_day, date_spine
from shelftrack.operators.joins import left_join_dim
from shelftrack.operators.ranking import latest_per_key, latest_per_key_per_day

FCT_KEYS = ("book_price_daily_pk",)
_TIES = ("discount_price", "old_price", "publisher", "title")


def build_int_books(stg: DataFrame) -> DataFrame:
    """One row per book, author and scan; scans without an author keep one row."""
    return stg.select(
        "book_id",
        F.explode_outer(split_list("author")).alias("author_name"),
        "title",
        "category",
        "year_of_publication",
        "script_type",
        "page_numbers",
        F.col("publisher").alias("publisher_name"),
        "currency",
        "old_price",
        "discount_price",
        "scraped_at",
        "updated_at",
    )


def _named(df: DataFrame, column: str, name: str, key: str) -> DataFrame:
    names = df.filter(not_blank(column)).select(F.col(column).alias(name)).distinct()
    return names.select(surrogate_key(name).alias(key), name)


def build_dim_authors(int_books: DataFrame) -> DataFrame:
    return _named(int_books, "author_name", "author_name", "author_id")


def build_dim_publishers(stg: DataFrame) -> DataFrame:
    return _named(stg, "publisher", "publisher_name", "publisher_id")


def build_dim_date(
    spark: SparkSession,
    as_of: date | str | Column | None = None,
    start: date | str | Column | None = None,
    end: date | str | Column | None = None,
) -> DataFrame:
    """The calendar, by default from the first of last month to two years ahead."""
    today = as_day(as_of)
    first = month_start(today, -1) if start is None else as_day(start)
    last = F.add_months(today, 24) if end is None else as_day(end)
    return date_spine(spark, first, last).select(*calendar_columns("full_date"))


def _with_publisher_id(df: DataFrame, dim_publishers: DataFrame | None) -> DataFrame:
    if dim_publishers is None:
        return df.withColumn("publisher_id", F.when(not_blank("publisher"), surrogate_key("publisher")))
    dim = dim_publishers.select(F.col("publisher_name").alias("publisher"), "publisher_id")
    return left_join_dim(df, dim, "publisher")


def build_dim_books(stg: DataFrame, dim_publishers: DataFrame | None = None) -> DataFrame:
    """Latest known attributes of every book."""
    wanted = stg.select(
        "book_id", "publisher", "title", "category", "isbn", "script_type", "page_numbers",
        "year_of_publication", "scraped_at", "updated_at", "discount_price", "old_price",
    )
    latest = latest_per_key(wanted, ["book_id"], "scraped_at", _TIES)
    return _with_publisher_id(latest, dim_publishers).select(
        "book_id",
        "publisher_id",
        "title",
        "category",
        "isbn",
        "script_type",
        "page_numbers",
        "year_of_publication",
        F.col("scraped_at").alias("last_scraped_at"),
        F.col("updated_at").alias("dbt_last_processed_at"),
    )


def build_bridge(int_books: DataFrame, dim_authors: DataFrame | None = None) -> DataFrame:
    """Distinct pairs of book and author."""
    pairs = int_books.filter(not_blank("author_name")).select("book_id", "author_name").distinct()
    if dim_authors is None:
        return pairs.select("book_id", surrogate_key("author_name").alias("author_id"))
    # The placeholder author may hold a large share of the pairs; a name has one row to meet.
    known = dim_authors.select("author_name", "author_id")
    return pairs.join(known, "author_name").select("book_id", "author_id")


def build_fct_prices(
    stg: DataFrame, dim_date: DataFrame, dim_publishers: DataFrame | None = None, keep_day: bool = False
) -> DataFrame:
    """Daily price of every book: its last scan of the day.

    ``keep_day`` adds the day as a partition column for stored tables, and the
    instant and source of the scan if staging has them.
    """
    # Where the instant is known it decides: local time repeats an hour in autumn.
    instant = [name for name in ("scraped_at_utc", "source") if name in stg.columns]
    wanted = stg.select(
        "book_id", "scraped_at", "publisher", "currency", "old_price", "discount_price", "title",
        F.to_date("scraped_at").alias("price_day"), *instant,
    )
    latest = "scraped_at_utc" if instant else "scraped_at"
    daily = latest_per_key_per_day(wanted, ["book_id"], latest, F.col("price_day"), _TIES)
    dated = left_join_dim(
        daily, dim_date.select(F.col("full_date").alias("price_day"), "date_id"), "price_day", bounded=True
    )
    fact = _with_publisher_id(dated, dim_publishers).select(
        surrogate_key("book_id", "price_day").alias("book_price_daily_pk"),
        "book_id",
        "date_id",
        "publisher_id",
        "currency",
        "old_price",
        "discount_price",
        # The greatest scan time of the day is the kept row's own.
        F.col("scraped_at").alias("max_scraped_at"),
        "price_day",
        *([F.col("scraped_at_utc").alias("max_scraped_at_utc"), "source"] if instant else []),
    )
    return fact if keep_day else fact.drop("price_day", "max_scraped_at_utc", "source")

"""Raw text to typed, cleaned scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.functions import (
    book_key, clean_author, cut_publisher, extract_isbn, extract_publisher, page_numbers,
    parse_price, publication_year, resolve_publisher, script_in_lower, to_local, validate_isbn,
)
from shelftrack.operators.ranking import latest_per_key

STG_KEYS = ("book_id", "scraped_at_utc")


def keep_priced(df: DataFrame, old: str = "old_price", discount: str = "discount_price") -> DataFrame:
    """Rows with at least one readable price."""
    return df.filter(F.col(old).isNotNull() | F.col(discount).isNotNull())


def build_stg_books(
    raw: DataFrame,
    as_of: Column | None = None,
    placeholder: str = fixed.UNKNOWN_AUTHOR,
    strict: bool = False,
    keep_instant: bool = False,
    source: str = "publisher",
) -> DataFrame:
    """The staging table: one row per scan with a readable price.

    ``scraped_at`` is local wall-clock time. ``keep_instant`` adds the UTC
    instant, the scan day and the raw value of the ``source`` column, which stored
    tables need: local time repeats an hour every autumn and cannot serve as a
    watermark, and cleaned names cannot be compared with raw ones. Prices are read and
    unpriced rows dropped before any description is searched.
    """
    now = F.current_timestamp() if as_of is None else as_of
    scans = raw.select(
        book_key("book_link").alias("book_id"),
        F.trim("title").alias("title"),
        clean_author("author", placeholder, strict).alias("author"),
        F.trim("book_link").alias("book_link"),
        F.trim("category").alias("category"),
        F.trim("publisher").alias("original_publisher"),
        "description",
        parse_price("old_price").alias("old_price"),
        parse_price("discount_price").alias("discount_price"),
        F.col("scraped_at").alias("scraped_at_utc"),
        F.col(source).alias("source"),
    )
    # What later expressions use more than once is a column of its own here.
    described = keep_priced(scans).select(
        "*",
        extract_isbn("description").alias("isbn_found"),
        cut_publisher(extract_publisher("description")).alias("described_publisher"),
        F.lower("description").alias("lower_description"),
    )
    staged = described.select(
        "book_id",
        "title",
        "author",
        "book_link",
        "category",
        resolve_publisher("book_link", "described_publisher", "original_publisher").alias("publisher"),
        "old_price",
        "discount_price",
        F.lit(fixed.CURRENCY).alias("currency"),
        validate_isbn("isbn_found").alias("isbn"),
        to_local("scraped_at_utc").alias("scraped_at"),
        to_local(now).alias("updated_at"),
        script_in_lower("lower_description").alias("script_type"),
        page_numbers("description").alias("page_numbers"),
        publication_year("description").alias("year_of_publication"),
        "scraped_at_utc",
        "source",
    )
    if keep_instant:
        return staged.withColumn("scrape_day", F.to_date("scraped_at"))
    return staged.drop("scraped_at_utc", "source")


def one_per_scan(stg: DataFrame) -> DataFrame:
    """One row per book and scan, as the stored staging table holds them; by the instant where it is known.

    Of rows that agree in these the greatest stays, compared by all other columns.
    """
    key = ["book_id", "scraped_at_utc" if "scraped_at_utc" in stg.columns else "scraped_at"]
    first = ["discount_price", "old_price", "title", "author", "publisher", "book_link"]
    ties = [*first, *(name for name in stg.columns if name not in (*first, *key, "updated_at"))]
    return latest_per_key(stg, key, "updated_at", ties)

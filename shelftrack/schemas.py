"""Declared schemas of records and tables."""

from __future__ import annotations

from pyspark.sql import types as T

from shelftrack import fixed_values as fixed
from shelftrack.functions.prices import PRICE_TYPE

_TEXT, _INT, _LONG, _TIME = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


def book_schema() -> T.StructType:
    """A record as extracted from a page: text only, all optional."""
    return _struct(*[(name, _TEXT, True) for name in fixed.RECORD_FIELDS])


def landed_schema() -> T.StructType:
    """A landed CSV file: the record and its batch time, all text."""
    return _struct(*[(name, _TEXT, True) for name in fixed.REQUIRED_COLUMNS])


def raw_schema() -> T.StructType:
    """The raw table; ids are ``batch:file:record`` texts."""
    return _struct(
        ("id", _TEXT, False),
        ("title", _TEXT, False),
        ("author", _TEXT, True),
        ("book_link", _TEXT, False),
        ("category", _TEXT, True),
        ("old_price", _TEXT, True),
        ("discount_price", _TEXT, True),
        ("currency", _TEXT, True),
        ("publisher", _TEXT, False),
        ("description", _TEXT, True),
        ("scraped_at", _TIME, False),
    )


def stats_schema() -> T.StructType:
    """The run monitoring table."""
    return _struct(
        ("id", _TEXT, False),
        ("spider_name", _TEXT, True),
        ("item_scraped_count", _LONG, True),
        ("response_received_count", _LONG, True),
        ("request_count", _LONG, True),
        ("start_time", _TIME, True),
        ("finish_time", _TIME, True),
        ("duration", T.DoubleType(), True),
        ("run_timestamp", _TIME, True),
    )


def stats_document_schema() -> T.StructType:
    """The nested run statistics document."""
    stats = _struct(
        ("items_scraped", _LONG, True),
        ("responses_received", _LONG, True),
        ("requests_made", _LONG, True),
        ("start_time", _TEXT, True),
        ("finish_time", _TEXT, True),
        ("duration_seconds", T.DoubleType(), True),
        ("completion_reason", _TEXT, True),
    )
    metadata = _struct(("timestamp", _TEXT, True), ("project_version", _TEXT, True))
    return _struct(("spider", _TEXT, True), ("stats", stats, True), ("metadata", metadata, True))


def stg_books_schema() -> T.StructType:
    """The staging table."""
    return _struct(
        ("book_id", _TEXT, False),
        ("title", _TEXT, False),
        ("author", _TEXT, False),
        ("book_link", _TEXT, False),
        ("category", _TEXT, True),
        ("publisher", _TEXT, True),
        ("old_price", PRICE_TYPE, True),
        ("discount_price", PRICE_TYPE, True),
        ("currency", _TEXT, False),
        ("isbn", _TEXT, True),
        ("scraped_at", _TIME, False),
        ("updated_at", _TIME, False),
        ("script_type", _TEXT, True),
        ("page_numbers", _INT, True),
        ("year_of_publication", _INT, True),
    )

"""The rules that guard the warehouse, layer by layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.operators.aggregates import upper_outliers
from shelftrack.plans import checks as rules
from shelftrack.plans.checks import (
    Check, accepted, not_null, relationship, row_check, table_check, unique, unique_combination,
)

# Which columns must be present, per table.
NOT_NULL = {
    "raw": ("id", "title", "book_link", "discount_price", "publisher", "scraped_at"),
    "stg_books": ("book_id", "scraped_at", "book_link", "title", "currency", "updated_at"),
    "int_books": (
        "book_id", "author_name", "title", "publisher_name", "currency", "discount_price",
        "scraped_at", "updated_at",
    ),
    "dim_date": ("date_id", "full_date"),
    "dim_authors": ("author_id", "author_name"),
    "dim_publishers": ("publisher_id", "publisher_name"),
    "dim_books": ("book_id", "publisher_id", "title"),
    "brg_book_author": ("book_id", "author_id"),
    "fct_book_prices": (
        "book_price_daily_pk", "book_id", "date_id", "publisher_id", "currency",
        "discount_price", "max_scraped_at",
    ),
}
UNIQUE = (
    ("raw", "id"), ("dim_date", "date_id"), ("dim_date", "full_date"), ("dim_authors", "author_id"),
    ("dim_publishers", "publisher_id"), ("dim_books", "book_id"), ("dim_books", "isbn"),
    ("fct_book_prices", "book_price_daily_pk"),
)
SCRIPTS = (fixed.LATIN_SCRIPT, fixed.CYRILLIC_SCRIPT)
ACCEPTED = (
    ("raw", "currency", (fixed.CURRENCY,)),
    ("stg_books", "currency", (fixed.CURRENCY,)),
    ("stg_books", "script_type", SCRIPTS),
    ("int_books", "currency", (fixed.CURRENCY,)),
    ("dim_date", "day_of_month", tuple(range(1, 32))),
    ("dim_date", "month_of_year", tuple(range(1, 13))),
    ("dim_books", "script_type", SCRIPTS),
    ("fct_book_prices", "currency", (fixed.CURRENCY,)),
)
RELATIONSHIPS = (
    ("dim_books", "publisher_id", "dim_publishers", "publisher_id"),
    ("brg_book_author", "book_id", "dim_books", "book_id"),
    ("brg_book_author", "author_id", "dim_authors", "author_id"),
    ("fct_book_prices", "book_id", "dim_books", "book_id"),
    ("fct_book_prices", "date_id", "dim_date", "date_id"),
    ("fct_book_prices", "publisher_id", "dim_publishers", "publisher_id"),
)


def generic_checks() -> list[Check]:
    present = [not_null(table, column) for table, columns in NOT_NULL.items() for column in columns]
    distinct = [
        unique(table, column, F.col("isbn").isNotNull() if column == "isbn" else None) for table, column in UNIQUE
    ]
    listed = [accepted(*rule) for rule in ACCEPTED]
    linked = [relationship(*rule) for rule in RELATIONSHIPS]
    return present + distinct + listed + linked + [unique_combination("brg_book_author", ("book_id", "author_id"))]


def singular_checks(as_of=None, date_limit: str = fixed.DATE_LIMIT) -> list[Check]:
    prices = ("old_price", "discount_price")
    return [
        table_check("authors_without_books", ("dim_authors", "brg_book_author"), rules.authors_without_books),
        table_check("books_without_authors", ("dim_books", "brg_book_author"), rules.books_without_authors),
        table_check("books_without_prices", ("dim_books", "fct_book_prices"), rules.books_without_prices),
        table_check("publishers_without_books", ("dim_publishers", "dim_books"), rules.publishers_without_books),
        table_check("uncovered_dates", ("stg_books", "dim_date"), rules.uncovered_dates),
        row_check("dates_past_limit", "dim_date", rules.past_date_limit(date_limit)),
        row_check("wrong_weekend_flag", "dim_date", rules.wrong_weekend_flag()),
        row_check("insane_fact_price", "fct_book_prices", rules.insane_price()),
        table_check("unstaged_rows", ("raw", "stg_books"), rules.unstaged_rows, "stg"),
        row_check("future_publication_year", "stg_books", rules.future_year(as_of)),
        row_check("malformed_link", "stg_books", rules.malformed_link()),
        row_check("malformed_isbn", "stg_books", rules.malformed_isbn()),
        row_check("non_positive_pages", "stg_books", rules.no_pages()),
        row_check("discount_above_old", "stg_books", rules.discount_above_old()),
        table_check("price_outliers", ("stg_books",), lambda stg: upper_outliers(stg, prices)),
    ]


def warehouse_checks(as_of=None, date_limit: str = fixed.DATE_LIMIT) -> list[Check]:
    return generic_checks() + singular_checks(as_of, date_limit)


def source_checks() -> list[Check]:
    """What can be checked before staging runs: the raw table alone."""
    return rules.select_checks(warehouse_checks(), tables=["raw"], exclude_tags=["stg"])

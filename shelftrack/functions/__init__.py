"""Column functions: every one is a native expression, none is a Python UDF."""

from shelftrack.functions.dates import (
    calendar_columns, date_id, local_day, month_start, seconds_between, to_local,
)
from shelftrack.functions.descriptions import (
    cut_publisher, extract_isbn, extract_publisher, page_numbers, publication_year,
    resolve_publisher, script_in_lower, script_type, validate_isbn,
)
from shelftrack.functions.keys import book_key, surrogate_key
from shelftrack.functions.prices import parse_price, price_is_lost
from shelftrack.functions.text import (
    clean_author, default_empty, first_match, initcap_words, not_blank, null_if_blank,
    null_if_missing, split_list, strip_space,
)
from shelftrack.functions.urls import (
    absolutize, host, on_hosts, publisher_from_url, resolve_link, valid_link,
)

__all__ = [
    "absolutize", "book_key", "calendar_columns", "clean_author", "cut_publisher", "date_id",
    "default_empty", "extract_isbn", "extract_publisher", "first_match", "host",
    "initcap_words", "local_day", "month_start", "not_blank", "null_if_blank",
    "null_if_missing", "on_hosts", "page_numbers", "parse_price", "price_is_lost", "publication_year",
    "publisher_from_url", "resolve_link", "resolve_publisher", "script_in_lower", "script_type",
    "seconds_between", "split_list", "strip_space", "surrogate_key", "to_local",
    "valid_link", "validate_isbn",
]

"""Facts read out of free-text product descriptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.functions.text import as_column, first_match, initcap_words


def extract_isbn(description: Column | str) -> Column:
    """The digits after the first ISBN marker, unchecked."""
    return F.trim(first_match(description, fixed.ISBN_PATTERN))


def validate_isbn(isbn: Column | str) -> Column:
    """Ten or thirteen places without hyphens, else NULL; no checksum."""
    trimmed = F.trim(as_column(isbn))
    bare = F.regexp_replace(trimmed, fixed.ISBN_SEPARATORS, "")
    return F.when(bare.rlike(fixed.ISBN_SHAPE), F.replace(trimmed, F.lit("-"), F.lit("")))


def extract_publisher(description: Column | str) -> Column:
    """The rest of the line after the publisher label."""
    return first_match(description, fixed.PUBLISHER_PATTERN)


def cut_publisher(line: Column | str, labels: tuple[str, ...] = fixed.LABELS_AFTER_PUBLISHER) -> Column:
    """Cut a publisher line before the first label that belongs to another field."""
    any_label = "|".join(labels)
    return F.trim(F.regexp_replace(as_column(line), rf"(?ius)\s*({any_label}).*\z", ""))


def resolve_publisher(
    link: Column | str,
    described: Column | str,
    original: Column | str,
    host: str = fixed.MULTI_PUBLISHER_HOST,
) -> Column:
    """A store of many publishers names them in the description, others by source."""
    in_store = F.lower(as_column(link)).contains(host)
    named = F.when(in_store, F.nullif(as_column(described), F.lit("")))
    return initcap_words(F.coalesce(named, as_column(original)))


def _mentions(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda found, word: found | text.contains(word), words[1:], text.contains(words[0]))


def script_in_lower(text: Column | str) -> Column:
    """Script named in lower-case text; Latin wins where both are named."""
    text = as_column(text)
    return F.when(_mentions(text, fixed.LATIN_WORDS), fixed.LATIN_SCRIPT).when(
        _mentions(text, fixed.CYRILLIC_WORDS), fixed.CYRILLIC_SCRIPT
    )


def script_type(description: Column | str) -> Column:
    return script_in_lower(F.lower(as_column(description)))


def page_numbers(description: Column | str, patterns: tuple[str, ...] = fixed.PAGE_PATTERNS) -> Column:
    """Page count under the first label that is present, case-sensitive."""
    return F.coalesce(*[_number(description, p) for p in patterns])


def publication_year(description: Column | str) -> Column:
    """First run of four digits that reads as a year from 1800 to 2029."""
    return _number(description, fixed.YEAR_PATTERN)


def _number(description: Column | str, pattern: str) -> Column:
    return first_match(description, pattern).try_cast("int")

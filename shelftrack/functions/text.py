"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed


# A private-use character and a space.
_WORD_MARK = "\ue000 "


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_space(c: Column | str) -> Column:
    """Drop white space of any kind at both ends; ``trim`` drops only U+0020."""
    return F.regexp_replace(as_column(c), r"(?U)^\s+|\s+\z", "")


def null_if_missing(c: Column | str, markers: tuple[str, ...] = fixed.NA_CELLS) -> Column:
    """NULL for cells that stand for a missing value."""
    c = as_column(c)
    return F.when(~c.isin(*markers), c)


def not_blank(c: Column | str) -> Column:
    c = as_column(c)
    return c.isNotNull() & (c != "")


def default_empty(c: Column | str) -> Column:
    return F.coalesce(as_column(c), F.lit(""))


def null_if_blank(c: Column | str, strict: bool = False) -> Column:
    """Trimmed text; NULL when it is blank or the word ``none``, which ``strict`` leaves alone."""
    trimmed = F.trim(as_column(c))
    empty = [""] if strict else ["", fixed.MISSING_TEXT.lower()]
    return F.when(~F.lower(trimmed).isin(*empty), trimmed)


def clean_author(
    c: Column | str, placeholder: str = fixed.UNKNOWN_AUTHOR, strict: bool = False
) -> Column:
    return F.coalesce(null_if_blank(c, strict), F.lit(placeholder))


def first_match(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of a capture group, NULL when there is none."""
    return F.nullif(F.regexp_extract(as_column(c), pattern, group), F.lit(""))


def initcap_words(c: Column | str) -> Column:
    """Capital after every character that is no letter or digit.

    The built-in ``initcap`` starts words only after a space. A space that is
    marked, so that it can be taken out again, is put wherever else a word
    starts, as in ``o'reilly d.o.o.``
    """
    marked = F.regexp_replace(as_column(c), r"(?<=[^\p{L}\p{N} ])(?=[\p{L}\p{N}])", _WORD_MARK)
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))


def split_list(c: Column | str, separator: str = ",") -> Column:
    """A separated list as an array of trimmed elements; NULL for NULL and ''."""
    c = as_column(c)
    parts = F.split(F.when(c != "", c), "[" + separator + "]")
    return F.transform(parts, lambda part: F.trim(part))

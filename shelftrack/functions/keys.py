"""Natural and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.functions.text import as_column


def book_key(link: Column | str) -> Column:
    """Natural key of a book: hash of its trimmed link."""
    return F.md5(F.trim(as_column(link)))


def surrogate_key(*columns: Column | str) -> Column:
    """Hash over the text of several columns, NULLs included."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(fixed.SURROGATE_NULL)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))

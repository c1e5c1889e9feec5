"""Prices written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelftrack import fixed_values as fixed
from shelftrack.functions.text import as_column

# Wide enough for what people write; differences and means of it still keep ten decimals.
PRICE_TYPE = T.DecimalType(36, 10)


def parse_price(c: Column | str) -> Column:
    """Decimal value of a price text.

    Only a trailing separator with exactly two digits marks decimals; any
    other separator is dropped. Of a number with decimals the first two parts
    around that separator count, so ``1.299.00`` reads as ``1.299``.

    Every step uses the one before it once: the expression stays linear and
    compiles well whatever it is applied to. The decimal mark is first turned
    into a semicolon, commas before dots; then separators up to it are dropped.
    Text without digits, ``None`` included, is NULL.
    """
    kept = F.regexp_replace(as_column(c), fixed.PRICE_NOISE, "")
    comma_marked = F.regexp_replace(kept, rf"^([^,]*),([^,]*)(?:,.*)?(?<={fixed.COMMA_DECIMALS})\z", "$1;$2")
    marked = F.regexp_replace(
        comma_marked, rf"^([^.;]*)\.([^.;]*)(?:\.[^;]*)?(?<={fixed.DOT_DECIMALS})\z", "$1;$2"
    )
    ungrouped = F.regexp_replace(marked, r"\G([^.,;]*)[.,]", "$1")
    number = F.translate(ungrouped, ";", ".")
    # A failing cast is costly, and most failures are texts without any digit.
    return F.nullif(number, F.lit("")).try_cast(PRICE_TYPE)


def price_is_lost(c: Column | str) -> Column:
    """Whether a text has digits but its price does not fit the type; such rows are reported, not dropped unseen."""
    text = as_column(c)
    return F.coalesce(text.rlike("[0-9]"), F.lit(False)) & parse_price(text).isNull()

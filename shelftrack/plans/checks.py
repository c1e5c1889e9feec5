"""Data-quality rules. A rule passes when no row violates it.

Every ``check_*`` function and every named rule returns the violating rows.
``run_checks`` only counts them: rules that look at single rows of one table
share one scan of it, however many they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.functions import book_key, valid_link
from shelftrack.operators.aggregates import duplicate_keys
from shelftrack.operators.generators import as_day
from shelftrack.operators.joins import missing_in

Tables = Mapping[str, DataFrame]


# Generic rules.


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """Values that occur more than once; NULLs are left to ``check_not_null``."""
    return duplicate_keys(df, [column], where)


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; here NULLs compare equal."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def check_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    value = F.col(column)
    odd = df.filter(value.isNotNull() & ~value.isin(list(values)))
    return odd.groupBy(column).agg(F.count("*").alias("n_rows"))


def check_relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows; NULL passes.

    Child rows are counted per key before the join, so a frequent key meets
    the parent as one row.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return missing_in(used, column, parent, parent_column)


def check_freshness(
    df: DataFrame,
    ts: str,
    as_of: datetime | str | Column | None = None,
    warn_hours: float = fixed.FRESHNESS_WARN_HOURS,
    error_hours: float = fixed.FRESHNESS_ERROR_HOURS,
) -> DataFrame:
    """One row: last load, its age and ``pass``, ``warn`` or ``error``; an empty table is an error."""
    now = F.current_timestamp() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    last = df.agg(F.max(F.col(ts).cast("timestamp")).alias("max_loaded_at"))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros("max_loaded_at")) / F.lit(3.6e9)
    hours = F.col("age_hours")
    status = F.when(hours.isNull() | (hours > error_hours), "error").when(hours > warn_hours, "warn").otherwise("pass")
    return last.withColumn("age_hours", age).withColumn("status", status)


# Named rules: row predicates.


def _outside_shape(c: Column) -> Column:
    return c.isNotNull() & ~F.regexp_replace(c, fixed.ISBN_SEPARATORS, "").rlike(fixed.ISBN_SHAPE)


def future_year(as_of=None) -> Column:
    return F.col("year_of_publication") > F.year(as_day(as_of))


def past_date_limit(limit: str = fixed.DATE_LIMIT) -> Column:
    return F.col("full_date") > F.lit(limit).cast("date")


def wrong_weekend_flag() -> Column:
    return F.col("is_weekend") != ((F.weekday("full_date") + 1).isin(6, 7))


def discount_above_old() -> Column:
    return F.col("discount_price") > F.col("old_price")


def insane_price() -> Column:
    return (F.col("old_price") < 0) | (F.col("discount_price") < 0) | discount_above_old()


def malformed_link() -> Column:
    return F.col("book_link").isNotNull() & ~valid_link("book_link")


def malformed_isbn() -> Column:
    return _outside_shape(F.col("isbn"))


def no_pages() -> Column:
    return F.col("page_numbers") <= 0


# Named rules: several tables.


def authors_without_books(dim_authors: DataFrame, bridge: DataFrame) -> DataFrame:
    return missing_in(dim_authors.select("author_id"), "author_id", bridge, "author_id")


def books_without_authors(dim_books: DataFrame, bridge: DataFrame) -> DataFrame:
    return missing_in(dim_books.select("book_id"), "book_id", bridge, "book_id")


def books_without_prices(dim_books: DataFrame, fct: DataFrame) -> DataFrame:
    return missing_in(dim_books.select("book_id"), "book_id", fct, "book_id")


def publishers_without_books(dim_publishers: DataFrame, dim_books: DataFrame) -> DataFrame:
    return missing_in(dim_publishers.select("publisher_id"), "publisher_id", dim_books, "publisher_id")


def uncovered_dates(stg: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Scan days that the calendar lacks."""
    days = stg.filter(F.col("scraped_at").isNotNull()).select(F.to_date("scraped_at").alias("scraped_date"))
    return missing_in(days.distinct(), "scraped_date", dim_date, "full_date")


def unstaged_rows(
    raw: DataFrame, stg: DataFrame, id_column: str = "id", priced_only: bool = False
) -> DataFrame:
    """Ids of raw rows whose book is not staged.

    Rows dropped on purpose for lack of a price count too, unless
    ``priced_only``. Raw rows meet each staged key once, in one pass; a row
    without a key counts as missing.
    """
    if priced_only:
        from shelftrack.functions import parse_price

        raw = raw.filter(parse_price("old_price").isNotNull() | parse_price("discount_price").isNotNull())
    rows = raw.select(id_column, book_key("book_link").alias("book_id"))
    return missing_in(rows, "book_id", stg, "book_id").select(id_column)


# Running rules.


@dataclass(frozen=True)
class Check:
    """A rule with a name, the tables it reads and tags to select it by.

    ``predicate`` marks the violating rows of ``tables[0]``; any other rule
    gives ``find``, a function of the tables. ``counted`` is the aggregate
    that counts violations.
    """

    name: str
    tables: tuple[str, ...]
    predicate: Column | None = None
    find: Callable[[Tables], DataFrame] | None = None
    tags: frozenset[str] = frozenset()
    per_row: bool = False

    def violations(self, tables: Tables) -> DataFrame:
        if self.predicate is not None:
            return tables[self.tables[0]].filter(self.predicate)
        return self.find(tables)

    def n_violations(self, tables: Tables) -> DataFrame:
        counted = F.coalesce(F.sum("n_rows"), F.lit(0)) if self.per_row else F.count("*")
        return self.violations(tables).agg(F.lit(self.name).alias("check"), counted.cast("long").alias("n_violations"))


def row_check(name: str, table: str, predicate: Column, *tags: str) -> Check:
    return Check(name, (table,), predicate=predicate, tags=frozenset(tags))


def not_null(table: str, column: str, *tags: str) -> Check:
    return row_check(f"not_null_{table}_{column}", table, F.col(column).isNull(), *tags)


def unique(table: str, column: str, where: Column | None = None, *tags: str) -> Check:
    return Check(
        f"unique_{table}_{column}", (table,), find=lambda t: check_unique(t[table], column, where), tags=frozenset(tags)
    )


def unique_combination(table: str, columns: Sequence[str], *tags: str) -> Check:
    name = f"unique_combination_{table}_{'_'.join(columns)}"
    return Check(name, (table,), find=lambda t: check_unique_combination(t[table], columns), tags=frozenset(tags))


def accepted(table: str, column: str, values: Sequence, *tags: str) -> Check:
    return Check(
        f"accepted_values_{table}_{column}",
        (table,),
        find=lambda t: check_accepted(t[table], column, values),
        tags=frozenset(tags),
    )


def relationship(table: str, column: str, parent: str, parent_column: str, *tags: str) -> Check:
    return Check(
        f"relationships_{table}_{column}_{parent}",
        (table, parent),
        find=lambda t: check_relationship(t[table], column, t[parent], parent_column),
        tags=frozenset(tags),
        per_row=True,
    )


def table_check(name: str, tables: Sequence[str], find: Callable[..., DataFrame], *tags: str) -> Check:
    """A rule over several tables; ``find`` takes them in order."""
    return Check(name, tuple(tables), find=lambda t: find(*[t[n] for n in tables]), tags=frozenset(tags))


def select_checks(
    checks: Iterable[Check],
    tables: Sequence[str] | None = None,
    tags: Sequence[str] | None = None,
    exclude_tags: Sequence[str] = (),
) -> list[Check]:
    """Rules that read any of the tables, carry any of the tags and none of the excluded ones."""
    chosen = []
    for check in checks:
        if tables is not None and not set(tables) & set(check.tables):
            continue
        if tags is not None and not set(tags) & check.tags:
            continue
        if not set(exclude_tags) & check.tags:
            chosen.append(check)
    return chosen


def run_checks(tables: Tables, checks: Sequence[Check]) -> DataFrame:
    """One row per rule: ``check``, ``n_violations``, ``passed``."""
    if not checks:
        raise ValueError("no checks selected")
    counts = [c.n_violations(tables) for c in checks if c.predicate is None]
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        if check.predicate is not None:
            by_table.setdefault(check.tables[0], []).append(check)
    counts += [_one_scan(tables[name], group) for name, group in by_table.items()]
    results = reduce(lambda a, b: a.unionByName(b), counts)
    return results.withColumn("passed", F.col("n_violations") == 0)


def _one_scan(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Counts of all row rules of a table in one aggregation, one output row each."""
    totals = df.agg(*[F.count(F.when(c.predicate, 1)).alias(f"_{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(F.lit(c.name).alias("check"), F.col(f"_{i}").alias("n_violations"))
            for i, c in enumerate(checks)
        ]
    )
    return totals.select(F.inline(rows))

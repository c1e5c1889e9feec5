"""Questions asked of the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.operators.aggregates import first_per_key, group_stats
from shelftrack.operators.generators import as_day
from shelftrack.operators.joins import left_join_dim
from shelftrack.operators.ranking import top_k


def avg_price_per_publisher(fct: DataFrame, dim_publishers: DataFrame) -> DataFrame:
    """Priced books and mean, least and greatest price per publisher, dearest first.

    Prices are aggregated by key before names are joined, so what meets the
    dimension is one row per publisher.
    """
    priced = fct.filter(F.col("discount_price").isNotNull() & F.col("publisher_id").isNotNull())
    stats = group_stats(priced, ["publisher_id"], "book_id", "discount_price")
    named = stats.join(dim_publishers, "publisher_id").select(
        "publisher_name",
        F.col("distinct_count").alias("distinct_books_count"),
        F.col("average_value").alias("average_discount_price"),
        F.col("min_value").alias("min_discount_price"),
        F.col("max_value").alias("max_discount_price"),
    )
    return named.orderBy(F.col("average_discount_price").desc_nulls_first(), "publisher_name")


def newly_added_books(
    fct: DataFrame,
    dim_date: DataFrame,
    dim_books: DataFrame,
    dim_publishers: DataFrame,
    as_of: date | str | Column | None = None,
    days: int = fixed.NEW_BOOK_DAYS,
) -> DataFrame:
    """Books first seen within the last ``days`` days, newest first."""
    # Day numbers grow with the days: one row per book meets the calendar, and days it lacks do not count.
    known = fct.select("book_id", "date_id").filter(F.col("date_id").isNotNull())
    first_day = first_per_key(known, "book_id", "date_id", "date_id")
    first_seen = first_day.join(dim_date.select("date_id", F.col("full_date").alias("first_seen_date")), "date_id")
    recent = first_seen.filter(F.col("first_seen_date") >= F.date_sub(as_day(as_of), days))
    return (
        recent.join(dim_books.select("book_id", "title", "publisher_id"), "book_id")
        .join(dim_publishers, "publisher_id")
        .select("title", "publisher_name", "book_id", "first_seen_date")
        .orderBy(F.col("first_seen_date").desc_nulls_first(), F.col("title").asc_nulls_last(), "book_id")
    )


def comparison_dates(
    dim_date: DataFrame,
    as_of: date | str | Column | None = None,
    months: int = fixed.CHANGE_MONTHS,
    days: int | None = None,
    fct: DataFrame | None = None,
) -> DataFrame:
    """One row: the latest day up to ``as_of`` and the day a lookback before it.

    Both are structs of ``day`` and ``id``. The latest day is the calendar's,
    or the last with prices where ``fct`` is given. The calendar, which has a
    row per day and no more, is searched as one array.
    """
    calendar = dim_date.select("date_id", "full_date", F.lit(True).alias("priced"))
    if fct is not None:
        priced = fct.select("date_id").distinct().withColumn("priced", F.lit(True))
        calendar = left_join_dim(calendar.drop("priced"), priced, "date_id", bounded=True)
    entry = F.struct(F.col("full_date").alias("day"), F.col("date_id").alias("id"))
    today = as_day(as_of)
    known = F.max(F.when(F.col("priced") & (F.col("full_date") <= today), entry))
    found = calendar.agg(known.alias("latest"), F.collect_list(entry).alias("days"))
    latest = F.col("latest.day")
    bound = F.date_sub(latest, days) if days is not None else F.add_months(latest, -months)
    past = F.array_max(F.filter("days", lambda d: d.getField("day") <= bound))
    return found.select("latest", past.alias("past"))


def price_change(
    fct: DataFrame,
    dim_date: DataFrame,
    dim_books: DataFrame,
    dim_publishers: DataFrame,
    as_of: date | str | Column | None = None,
    months: int = fixed.CHANGE_MONTHS,
    k: int = fixed.CHANGE_TOP,
    days: int | None = None,
    latest_from: str = "calendar",
    with_percentage: bool = False,
) -> DataFrame:
    """The ``k`` largest price rises between the latest day and a month before.

    A book has one price a day, so the two snapshots are matched by one
    aggregation per book over one scan, not by joining the fact with itself.
    The days enter the scan as a scalar subquery; a fact that is stored by
    ``price_day`` reads just the two partitions.
    """
    dates = comparison_dates(dim_date, as_of, months, days, fct if latest_from == "fact" else None)
    compared = dates.select(F.struct("latest", "past")).scalar()
    latest, past = compared.getField("latest"), compared.getField("past")
    snapshots = fct.filter(F.col("discount_price").isNotNull())
    snapshots = snapshots.filter(F.col("date_id").isin(latest.getField("id"), past.getField("id")))
    if "price_day" in fct.columns:
        snapshots = snapshots.filter(F.col("price_day").isin(latest.getField("day"), past.getField("day")))

    def price_on(day: Column) -> Column:
        return F.max(F.when(F.col("date_id") == day.getField("id"), F.col("discount_price")))

    both = (
        snapshots.groupBy("book_id")
        .agg(price_on(past).alias("price_month_ago"), price_on(latest).alias("price_latest"))
        .filter(F.col("price_month_ago").isNotNull() & F.col("price_latest").isNotNull())
    )
    change = F.col("price_latest") - F.col("price_month_ago")
    columns = [
        "title", "publisher_name", "book_id", "price_month_ago", "price_latest", change.alias("absolute_change"),
    ]
    if with_percentage:
        columns.append(percentage_change("price_month_ago", "price_latest").alias("percentage_change"))
    named = (
        both.join(dim_books.select("book_id", "title", "publisher_id"), "book_id")
        .join(dim_publishers, "publisher_id")
        .select(*columns)
    )
    return top_k(named, "absolute_change", k, ["title", "book_id"]).drop("book_id")


def percentage_change(before: str, after: str) -> Column:
    """Change in percent, NULL from a price of zero."""
    old, new = F.col(before), F.col(after)
    return F.when(old != 0, (new - old) * 100 / old)

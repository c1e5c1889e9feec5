"""Column functions, one query each, over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelftrack import functions as fn
from shelftrack.operators.generators import date_spine
from shelftrack.plans.analytics import percentage_change
from workload import oracle_parts as sql
from workload.book_tables import raw_books, shown, table
from workload.registry import query


def _raw_column(name: str, alias: str, column, expression: str) -> None:
    """A column function over the raw table."""

    @query(name, sql.with_raw(f"SELECT id, {expression} AS {alias} FROM told"))
    def run(spark, sf):
        return shown(raw_books(spark, sf).select("id", column().alias(alias)))


_raw_column("book_key", "book_id", lambda: fn.book_key("book_link"), "md5(trim(book_link))")
_raw_column(
    "surrogate_key", "key", lambda: fn.surrogate_key("author", "category", "currency"),
    sql.key("author", "category", "currency"),
)
_raw_column("clean_author", "author", lambda: fn.clean_author("author"), sql.AUTHOR)
_raw_column(
    "clean_author_strict", "author", lambda: fn.clean_author("author", "(none)", strict=True),
    "CASE WHEN author IS NULL OR trim(author) = '' THEN '(none)' ELSE trim(author) END",
)
_raw_column("trim_lower", "title", lambda: F.lower(F.trim("title")), "lower(trim(title))")
_raw_column("initcap_words", "publisher", lambda: fn.initcap_words(F.trim("publisher")), sql.HOUSE)
_raw_column("parse_price", "price", lambda: fn.parse_price("old_price"), sql.shown_price(sql.price("old_price")))
_raw_column("extract_isbn", "isbn", lambda: fn.extract_isbn("description"), sql.ISBN_FOUND)
_raw_column(
    "validate_isbn", "isbn", lambda: fn.validate_isbn(fn.extract_isbn("description")), sql.ISBN_VALID
)
_raw_column("extract_publisher", "line", lambda: fn.extract_publisher("description"), sql.PUBLISHER_LINE)
_raw_column(
    "cut_publisher", "name", lambda: fn.cut_publisher(fn.extract_publisher("description")), sql.PUBLISHER_CUT
)
_raw_column(
    "resolve_publisher",
    "publisher",
    lambda: fn.resolve_publisher(
        "book_link", fn.cut_publisher(fn.extract_publisher("description")), F.trim("publisher")
    ),
    sql.PUBLISHER,
)
_raw_column("script_type", "script", lambda: fn.script_type("description"), sql.SCRIPT)
_raw_column("page_numbers", "pages", lambda: fn.page_numbers("description"), sql.PAGES)
_raw_column("publication_year", "year", lambda: fn.publication_year("description"), sql.YEAR)
_raw_column(
    "valid_link", "valid", lambda: fn.valid_link("book_link"), "regexp_matches(book_link, '^https?://.+', 'i')"
)
_raw_column("default_empty", "author", lambda: fn.default_empty("author"), "coalesce(author, '')")
_raw_column("constant_currency", "currency", lambda: F.lit("RSD"), "'RSD'")
_raw_column(
    "absolutize_link", "link", lambda: fn.absolutize(F.trim("book_link"), "https://izdanja.rs/"),
    "CASE WHEN lower(trim(book_link)) LIKE 'http%' THEN trim(book_link) "
    "ELSE 'https://izdanja.rs/' || regexp_replace(trim(book_link), '^/+', '') END",
)
_raw_column(
    "split_price_parts", "part", lambda: F.split_part(F.replace("old_price", F.lit("."), F.lit("")), F.lit(","), F.lit(2)),
    "split_part(replace(old_price, '.', ''), ',', 2)",
)
_raw_column(
    "first_digits", "digits", lambda: fn.first_match("description", r"(\d+)"),
    "nullif(regexp_extract(description, '([0-9]+)', 1), '')",
)
_raw_column(
    "strip_digits", "letters", lambda: F.regexp_replace("title", r"\d", ""), "regexp_replace(title, '[0-9]', '', 'g')"
)
_raw_column("to_local", "local_time", lambda: fn.to_local("scraped_at"), sql.when_text(sql.local("scraped_at")))
_raw_column(
    "case_coalesce_nullif", "shelf",
    lambda: F.when(F.col("category").isNull(), "none").otherwise(
        F.coalesce(F.nullif(F.trim("category"), F.lit("Oblast 3")), F.lit("third"))
    ),
    "CASE WHEN category IS NULL THEN 'none' ELSE coalesce(nullif(trim(category), 'Oblast 3'), 'third') END",
)
_raw_column(
    "first_list_element", "first_author", lambda: F.get(fn.split_list("author"), F.lit(0)),
    "trim(string_split(nullif(author, ''), ',')[1])",
)


@query(
    "explode_list",
    sql.with_raw("SELECT id, trim(unnest(string_split(author, ','))) AS author_name FROM raw WHERE author <> ''"),
)
def explode_list(spark, sf):
    return raw_books(spark, sf).select("id", F.explode(fn.split_list("author")).alias("author_name"))


@query(
    "publisher_from_url",
    "SELECT page_id, url, string_split(regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1), '.')[-2] AS publisher FROM pages",
)
def publisher_from_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", fn.publisher_from_url("url").alias("publisher"))


_CALENDAR_SQL = (
    "cast(day({d}) AS INTEGER) AS day_of_month, cast(month({d}) AS INTEGER) AS month_of_year, "
    "cast(year({d}) AS INTEGER) AS year, cast(quarter({d}) AS INTEGER) AS quarter_of_year, dayname({d}) AS day_name, "
    "cast(isodow({d}) AS INTEGER) AS day_of_week_iso, isodow({d}) IN (6, 7) AS is_weekend"
)


@query(
    "calendar_columns",
    "SELECT o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, "
    "cast(cast(o_orderdate AS DATE) AS VARCHAR) AS full_date, " + _CALENDAR_SQL.format(d="o_orderdate") + " FROM orders",
)
def calendar_columns(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return shown(orders.select("o_orderkey", *fn.calendar_columns("d")))


@query(
    "date_id",
    "SELECT l_orderkey, l_linenumber, l_partkey, cast(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_id FROM lineitem",
)
def date_id(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.date_id("l_shipdate").alias("date_id")
    )


@query(
    "local_day",
    "SELECT event_id, cast(cast(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Belgrade' AS DATE) AS VARCHAR) AS day FROM events",
)
def local_day(spark, sf):
    events = table(spark, sf, "events")
    return shown(events.select("event_id", fn.local_day(F.col("ts").cast("timestamp")).alias("day")))


@query(
    "local_time_daylight_saving",
    "SELECT o_orderkey, strftime((o_orderdate + INTERVAL 23 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Belgrade', "
    "'%Y-%m-%d %H:%M:%S') AS local_time FROM orders",
)
def local_time_daylight_saving(spark, sf):
    """Orders span years, so both offsets occur."""
    late = F.col("o_orderdate").cast("timestamp") + F.expr("interval 23 hours")
    local = F.date_format(fn.to_local(late), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "orders").select("o_orderkey", local.alias("local_time"))


@query(
    "month_bounds",
    "SELECT o_orderkey, cast(cast(date_trunc('month', o_orderdate - INTERVAL 1 MONTH) AS DATE) AS VARCHAR) AS month_before, "
    "cast(cast(o_orderdate + INTERVAL 24 MONTH AS DATE) AS VARCHAR) AS two_years_on, "
    "cast(cast(o_orderdate - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS month_ago FROM orders",
)
def month_bounds(spark, sf):
    day = F.to_date("o_orderdate")
    return shown(
        table(spark, sf, "orders").select(
            "o_orderkey",
            fn.month_start(day, -1).alias("month_before"),
            F.add_months(day, 24).alias("two_years_on"),
            F.add_months(day, -1).alias("month_ago"),
        )
    )


@query(
    "date_spine",
    "SELECT cast(cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS VARCHAR) "
    "AS full_date FROM orders",
)
def spine(spark, sf):
    orders = table(spark, sf, "orders")
    first = orders.agg(F.to_date(F.min("o_orderdate"))).scalar()
    last = orders.agg(F.to_date(F.max("o_orderdate"))).scalar()
    return shown(date_spine(spark, first, last))


@query(
    "rolling_window_filter",
    "SELECT o_orderkey FROM orders WHERE cast(o_orderdate AS DATE) >= "
    "(SELECT cast(max(o_orderdate) AS DATE) - INTERVAL 7 DAY FROM orders)",
)
def rolling_window_filter(spark, sf):
    orders = table(spark, sf, "orders")
    last = orders.agg(F.to_date(F.max("o_orderdate"))).scalar()
    return orders.filter(F.to_date("o_orderdate") >= F.date_sub(last, 7)).select("o_orderkey")


@query(
    "seconds_between",
    "SELECT user_id, round(date_diff('microsecond', min(ts), max(ts)) / 1e6, 6) AS seconds FROM events GROUP BY user_id",
)
def seconds_between(spark, sf):
    spans = table(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    texts = spans.select("user_id", F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"))
    return texts.select("user_id", F.round(fn.seconds_between("a", "b"), 6).alias("seconds"))


@query(
    "format_timestamps",
    "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S_%f') AS file_stamp, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' "
    "AS scraped_at FROM events",
)
def format_timestamps(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "yyyyMMdd_HHmmss_SSSSSS").alias("file_stamp"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("scraped_at"),
    )


@query(
    "percentage_change",
    "SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN l_extendedprice <> 0 THEN "
    "(l_extendedprice * (1 - l_discount) - l_extendedprice) * 100 / l_extendedprice END, 4) AS percent, "
    "round(l_extendedprice * (1 - l_discount) - l_extendedprice, 4) AS change FROM lineitem",
)
def percent(spark, sf):
    prices = table(spark, sf, "lineitem").withColumn("reduced", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return prices.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(percentage_change("l_extendedprice", "reduced"), 4).alias("percent"),
        F.round(F.col("reduced") - F.col("l_extendedprice"), 4).alias("change"),
    )


@query(
    "cast_columns",
    "SELECT event_id, cast(user_id AS VARCHAR) AS book, cast(value AS INTEGER) AS whole, "
    "cast(cast(ts AS DATE) AS VARCHAR) AS day, try_cast(nullif(event_type, '') AS INTEGER) AS no_number FROM events",
)
def cast_columns(spark, sf):
    return shown(
        table(spark, sf, "events").select(
            "event_id",
            F.col("user_id").cast("string").alias("book"),
            F.rint("value").cast("int").alias("whole"),
            F.to_date("ts").alias("day"),
            F.nullif("event_type", F.lit("")).try_cast("int").alias("no_number"),
        )
    )

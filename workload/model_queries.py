"""Models, analyses and checks over the book scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from shelftrack.operators.aggregates import upper_outliers
from shelftrack.operators.upsert import newer_than, upsert
from shelftrack.plans import analytics, checks, marts, suite
from shelftrack.plans.warehouse import build_models
from shelftrack.sources.landing import append_batches
from shelftrack.sources.tables import shared_folder
from workload.book_tables import (
    calendar, models, raw_books, rounded_mean, shown, staged, stored_models, table,
)
from workload.oracle_parts import mean_of_cents, shown_price, when_text, with_raw, with_stg, with_star
from workload.registry import query

_STG_SHOWN = (
    "book_id, title, author, book_link, category, publisher, "
    f"{shown_price('old_price')} AS old_price, {shown_price('discount_price')} AS discount_price, currency, isbn, "
    f"{when_text('scraped_at')} AS scraped_at, {when_text('updated_at')} AS updated_at, script_type, page_numbers, "
    "year_of_publication"
)
_FCT_SHOWN = (
    "book_price_daily_pk, book_id, date_id, publisher_id, currency, "
    f"{shown_price('old_price')} AS old_price, {shown_price('discount_price')} AS discount_price, "
    f"{when_text('max_scraped_at')} AS max_scraped_at"
)


@query("build_stg_books", with_stg(f"SELECT {_STG_SHOWN} FROM stg"))
def stg_books(spark, sf):
    return shown(staged(spark, sf))


@query(
    "build_models",
    with_star(
        "SELECT 'stg_books' AS model, count(*) AS n_rows FROM stg UNION ALL SELECT 'int_books', count(*) FROM exploded "
        "UNION ALL SELECT 'dim_date', count(*) FROM dim_date UNION ALL SELECT 'dim_authors', count(*) FROM dim_authors "
        "UNION ALL SELECT 'dim_publishers', count(*) FROM dim_publishers UNION ALL SELECT 'dim_books', count(*) FROM dim_books "
        "UNION ALL SELECT 'brg_book_author', count(*) FROM brg UNION ALL SELECT 'fct_book_prices', count(*) FROM fct"
    ),
)
def all_models(spark, sf):
    """Row counts of all models, computed from raw text in one plan."""
    frames = build_models(raw_books(spark, sf), calendar(spark, sf))
    counts = [
        df.agg(F.lit(name).alias("model"), F.count("*").alias("n_rows")) for name, df in frames.items() if name != "raw"
    ]
    return append_batches(counts)


@query(
    "build_int_books",
    with_star(
        "SELECT book_id, author_name, title, category, year_of_publication, script_type, page_numbers, "
        f"publisher AS publisher_name, currency, {shown_price('old_price')} AS old_price, "
        f"{shown_price('discount_price')} AS discount_price, {when_text('scraped_at')} AS scraped_at, "
        f"{when_text('updated_at')} AS updated_at FROM exploded"
    ),
)
def int_books(spark, sf):
    return shown(models(spark, sf)["int_books"])


@query("build_dim_authors", with_star("SELECT author_id, author_name FROM dim_authors"))
def dim_authors(spark, sf):
    return models(spark, sf)["dim_authors"]


@query("build_dim_publishers", with_star("SELECT publisher_id, publisher_name FROM dim_publishers"))
def dim_publishers(spark, sf):
    return models(spark, sf)["dim_publishers"]


_BOOKS_SQL = with_star(
    f"SELECT * REPLACE ({when_text('last_scraped_at')} AS last_scraped_at, "
    f"{when_text('dbt_last_processed_at')} AS dbt_last_processed_at) FROM dim_books"
)


@query("build_dim_books", _BOOKS_SQL)
def dim_books(spark, sf):
    return shown(models(spark, sf)["dim_books"])


@query("build_dim_books_joined", _BOOKS_SQL)
def dim_books_joined(spark, sf):
    m = models(spark, sf)
    return shown(marts.build_dim_books(m["stg_books"], m["dim_publishers"]))


@query("build_dim_date", with_star("SELECT * REPLACE (cast(full_date AS VARCHAR) AS full_date) FROM dim_date"))
def dim_date(spark, sf):
    return shown(calendar(spark, sf))


_BRIDGE_SQL = with_star("SELECT book_id, author_id FROM brg")


@query("build_bridge", _BRIDGE_SQL)
def bridge(spark, sf):
    return models(spark, sf)["brg_book_author"]


@query(
    "dimensions_by_batch",
    with_star(
        "SELECT 'author' AS kind, NULL AS book_id, author_name AS name FROM dim_authors UNION ALL "
        "SELECT 'publisher', NULL, publisher_name FROM dim_publishers UNION ALL "
        "SELECT 'pair', book_id, author_id FROM brg UNION ALL SELECT 'book', book_id, title FROM dim_books"
    ),
)
def dimensions_by_batch(spark, sf):
    """Some scans come with wrong authors, publishers and titles and are corrected by a later batch; another batch comes twice: equal to a rebuild."""
    from uuid import uuid4

    from shelftrack.plans.warehouse import Warehouse

    warehouse = Warehouse(spark, f"{shared_folder(spark)}/workload/{uuid4()}/warehouse")
    raw, days = raw_books(spark, sf), calendar(spark, sf)
    wrong = F.crc32("book_link") % 5 == 0
    changed = {"author": F.lit("Neko Drugi, Treći"), "publisher": F.lit("nije ta"), "title": F.lit("pogrešno")}
    early = F.col("scraped_at") <= F.lit("2024-01-15 12:00:00").cast("timestamp")
    batches = {
        "first": raw.filter(early).select(*(F.when(wrong, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else c for c in raw.columns)),
        "second": raw.filter(~early),
        "third": raw.filter(early & wrong),
    }
    for batch in ("first", "second", "second", "third", "first"):
        warehouse.apply_batch(batches[batch], days, batch, F.lit("2024-02-01 00:00:00").cast("timestamp"))
        warehouse.update_dimensions(batch)
    m = warehouse.dimensions()
    none = F.lit(None).cast("string")
    parts = [
        ("author", none, "author_name", m["dim_authors"]), ("publisher", none, "publisher_name", m["dim_publishers"]),
        ("pair", F.col("book_id"), "author_id", m["brg_book_author"]), ("book", F.col("book_id"), "title", m["dim_books"]),
    ]
    shown_parts = [df.select(F.lit(kind).alias("kind"), book.alias("book_id"), F.col(name).alias("name")) for kind, book, name, df in parts]
    return reduce(lambda a, b: a.unionByName(b), shown_parts)


@query("build_bridge_joined", _BRIDGE_SQL)
def bridge_joined(spark, sf):
    m = models(spark, sf)
    return marts.build_bridge(m["int_books"], m["dim_authors"])


_FCT_SQL = with_star(f"SELECT {_FCT_SHOWN} FROM fct")


@query("build_fct_prices", _FCT_SQL)
def fct_prices(spark, sf):
    return shown(models(spark, sf)["fct_book_prices"])


@query("build_fct_prices_joined", _FCT_SQL)
def fct_prices_joined(spark, sf):
    m = models(spark, sf)
    return shown(marts.build_fct_prices(m["stg_books"], m["dim_date"], m["dim_publishers"]))


@query(
    "avg_price_per_publisher",
    with_star(
        "SELECT p.publisher_name, count(DISTINCT f.book_id) AS distinct_books_count, "
        f"{mean_of_cents('cast(f.discount_price * 100 AS BIGINT)')} AS average_discount_price, "
        f"{shown_price('min(f.discount_price)')} AS min_discount_price, "
        f"{shown_price('max(f.discount_price)')} AS max_discount_price FROM fct f "
        "JOIN dim_publishers p USING (publisher_id) WHERE f.discount_price IS NOT NULL GROUP BY p.publisher_name"
    ),
)
def avg_price_per_publisher(spark, sf):
    m = stored_models(spark, sf)
    means = analytics.avg_price_per_publisher(m["fct_book_prices"], m["dim_publishers"])
    return shown(means.withColumn("average_discount_price", rounded_mean("average_discount_price")))


# The calendar starts in the month before the last scan; every book of these
# tables is seen early, so the window is counted from the second day on.
_NEW_DAYS = 29


@query(
    "newly_added_books",
    with_star(
        ", first_seen AS (SELECT f.book_id, min(d.full_date) AS first_seen_date FROM fct f JOIN dim_date d "
        "USING (date_id) GROUP BY f.book_id) SELECT b.title, p.publisher_name, b.book_id, "
        "cast(s.first_seen_date AS VARCHAR) AS first_seen_date FROM first_seen s JOIN dim_books b USING (book_id) "
        "JOIN dim_publishers p ON b.publisher_id = p.publisher_id, today "
        f"WHERE s.first_seen_date >= today.d - INTERVAL {_NEW_DAYS - 1} DAY"
    ),
)
def newly_added_books(spark, sf):
    m = stored_models(spark, sf)
    day = table(spark, sf, "events").agg(F.to_date(F.max("ts"))).scalar()
    found = analytics.newly_added_books(
        m["fct_book_prices"], m["dim_date"], m["dim_books"], m["dim_publishers"], day, _NEW_DAYS - 1
    )
    return shown(found)


def _change_sql(days: int, tail: str) -> str:
    return with_star(
        f", latest AS (SELECT max(date_id) AS id, max(full_date) AS day FROM dim_date, today WHERE full_date <= today.d), "
        f"past AS (SELECT max(date_id) AS id FROM dim_date, latest WHERE full_date <= latest.day - INTERVAL {days} DAY), "
        "change AS (SELECT b.title, p.publisher_name, b.book_id, c.discount_price AS price_latest, "
        "o.discount_price AS price_month_ago, c.discount_price - o.discount_price AS absolute_change "
        "FROM fct c JOIN fct o ON c.book_id = o.book_id JOIN dim_books b ON c.book_id = b.book_id "
        "JOIN dim_publishers p ON b.publisher_id = p.publisher_id "
        "WHERE c.date_id = (SELECT id FROM latest) AND o.date_id = (SELECT id FROM past) "
        "AND c.discount_price IS NOT NULL AND o.discount_price IS NOT NULL) " + tail
    )


_CHANGE_TAIL = (
    f"SELECT title, publisher_name, {shown_price('price_month_ago')} AS price_month_ago, "
    f"{shown_price('price_latest')} AS price_latest, {shown_price('absolute_change')} AS absolute_change "
    "FROM change ORDER BY change.absolute_change DESC NULLS FIRST, title, book_id LIMIT 100"
)


@query("price_change", _change_sql(14, _CHANGE_TAIL))
def price_change(spark, sf):
    m = stored_models(spark, sf)
    day = table(spark, sf, "events").agg(F.to_date(F.max("ts"))).scalar()
    return shown(
        analytics.price_change(
            m["fct_book_prices"], m["dim_date"], m["dim_books"], m["dim_publishers"], day, days=14
        )
    )


# Incremental loads: staging up to a cut, then the rest on top of it.

_CUT = "2024-01-20 00:00:00"
_DAILY = (
    "SELECT event_id, user_id, event_type, value, ts FROM (SELECT *, row_number() OVER "
    "(PARTITION BY user_id, cast(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM {rows}) WHERE rn = 1"
)


def _daily(rows):
    from shelftrack.operators.ranking import latest_per_key_per_day

    return latest_per_key_per_day(rows.drop("props"), ["user_id"], "ts", None, ["event_id"]).withColumn(
        "day", F.to_date("ts")
    )


@query(
    "incremental_upsert",
    f"WITH daily AS ({_DAILY.format(rows='events')}) SELECT event_id, user_id, event_type, value, "
    f"{when_text('ts')} AS ts, cast(cast(ts AS DATE) AS VARCHAR) AS day FROM daily",
)
def incremental_upsert(spark, sf):
    """A first load up to noon of a day, then the rows after it: equal to one full load."""
    events = table(spark, sf, "events")
    target = _daily(events.filter(F.col("ts") <= F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")))
    new = _daily(newer_than(events, target, "ts"))
    return shown(upsert(target, new, ["user_id", "day"]))


@query(
    "full_refresh",
    f"WITH daily AS ({_DAILY.format(rows='events')}) SELECT event_id, user_id, event_type, value, "
    f"{when_text('ts')} AS ts, cast(cast(ts AS DATE) AS VARCHAR) AS day FROM daily",
)
def full_refresh(spark, sf):
    from uuid import uuid4

    from shelftrack.operators.upsert import full_refresh as refresh

    path = f"{shared_folder(spark)}/workload/{uuid4()}/daily"
    stored = refresh(spark, _daily(table(spark, sf, "events")), path, "day")
    return shown(stored).select("event_id", "user_id", "event_type", "value", "ts", "day")


@query(
    "stored_upsert",
    f"WITH daily AS ({_DAILY.format(rows='events')}) SELECT event_id, user_id, event_type, value, "
    f"{when_text('ts')} AS ts, cast(cast(ts AS DATE) AS VARCHAR) AS day FROM daily",
)
def stored_upsert(spark, sf):
    """The same through a stored table whose touched days are rewritten."""
    from uuid import uuid4

    from shelftrack.operators.upsert import upsert_table

    path = f"{shared_folder(spark)}/workload/{uuid4()}/daily"
    events = table(spark, sf, "events")
    first = _daily(events.filter(F.col("ts") <= F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")))
    stored = upsert_table(spark, path, first, ["user_id", "day"], "day", "first")
    rest = _daily(newer_than(events, stored, "ts", partition="day"))
    return shown(upsert_table(spark, path, rest, ["user_id", "day"], "day", "second")).select(
        "event_id", "user_id", "event_type", "value", "ts", "day"
    )


@query(
    "upsert_repeated",
    f"WITH daily AS ({_DAILY.format(rows='events')}) SELECT event_id, user_id, event_type, value, "
    f"{when_text('ts')} AS ts, cast(cast(ts AS DATE) AS VARCHAR) AS day FROM daily",
)
def upsert_repeated(spark, sf):
    """Two loads, and then both again in turn: equal to one full refresh."""
    from uuid import uuid4

    from shelftrack.operators.upsert import upsert_table

    path = f"{shared_folder(spark)}/workload/{uuid4()}/daily"
    events = table(spark, sf, "events")
    cut = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    first, second = _daily(events.filter(F.col("ts") <= cut)), _daily(events.filter(F.col("ts") > cut))
    for new, batch in ((first, "first"), (second, "second"), (first, "first"), (second, "second")):
        stored = upsert_table(spark, path, new, ["user_id", "day"], "day", batch)
    return shown(stored).select("event_id", "user_id", "event_type", "value", "ts", "day")


def _loaded_in_two(spark, sf, first, by=None):
    """The fact after a load of the ``first`` rows and one of all rows."""
    from uuid import uuid4

    from shelftrack.plans.warehouse import Warehouse

    warehouse = Warehouse(spark, f"{shared_folder(spark)}/workload/{uuid4()}/warehouse")
    raw, days = raw_books(spark, sf), calendar(spark, sf)
    for batch, rows in (("first", raw.filter(first)), ("second", raw)):
        warehouse.update_staging(rows, batch, F.lit("2024-02-01 00:00:00").cast("timestamp"), by)
        warehouse.update_facts(days, batch, per_source=by is not None)
    return shown(warehouse.table("fct_book_prices").drop("price_day", "max_scraped_at_utc", "source"))


@query("facts_late_source", _FCT_SQL)
def facts_late_source(spark, sf):
    """One publisher's scans come with the second load, older than what the first held: equal to a full refresh."""
    return _loaded_in_two(spark, sf, ~F.col("publisher").contains("-view "), by="publisher")


@query("facts_in_two_loads", _FCT_SQL)
def facts_in_two_loads(spark, sf):
    return _loaded_in_two(spark, sf, F.col("scraped_at") <= F.lit("2024-01-20 22:30:00").cast("timestamp"))


_NIGHT = "TIMESTAMP '2024-10-27 00:00:00' + to_microseconds(epoch_us(ts) % 7200000000)"


@query(
    "facts_autumn_hour",
    f"SELECT cast(user_id AS VARCHAR) AS title, count(DISTINCT {_NIGHT}) AS scans, strftime(max({_NIGHT}), '%H:%M:%S.%f') AS last_scan "
    "FROM events GROUP BY 1",
)
def facts_autumn_hour(spark, sf):
    """All scans fall into the two hours of UTC that are one hour of local time; two loads lose none."""
    from uuid import uuid4

    from shelftrack.plans.warehouse import Warehouse

    warehouse = Warehouse(spark, f"{shared_folder(spark)}/workload/{uuid4()}/warehouse")
    micros = F.unix_micros(F.col("scraped_at")) % F.lit(7_200_000_000)
    night = F.timestamp_micros(F.lit(1729987200_000_000) + micros)
    raw = raw_books(spark, sf).withColumn("scraped_at", night).withColumn("discount_price", F.lit("10,00"))
    # One link a book, whatever event type told it.
    book = F.regexp_extract("title", r"(\d+)", 1)
    raw = raw.withColumn("book_link", F.concat(F.lit("https://izdanja.rs/k/"), book))
    days = marts.build_dim_date(spark, "2024-10-28")
    early = F.col("scraped_at") <= F.lit("2024-10-27 00:50:00").cast("timestamp")
    for batch, rows in (("first", raw.filter(early)), ("second", raw)):
        warehouse.update_staging(rows, batch)
        warehouse.update_facts(days, batch)
    scans = warehouse.table("stg_books").groupBy("title").agg(F.count("*").alias("scans"), F.max("book_id").alias("book_id"))
    last = warehouse.table("fct_book_prices").select("book_id", F.date_format("max_scraped_at_utc", "HH:mm:ss.SSSSSS").alias("last_scan"))
    return scans.join(last, "book_id").select(F.regexp_extract("title", r"(\d+)", 1).alias("title"), "scans", "last_scan")


@query(
    "watermark_per_source",
    "WITH cut AS (SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-10 00:00:00' OR event_type = 'view'), "
    "marks AS (SELECT event_type, max(ts) AS mark FROM cut GROUP BY event_type) "
    f"SELECT e.event_id, e.event_type, {when_text('e.ts')} AS ts FROM events e LEFT JOIN marks m USING (event_type) "
    "WHERE m.mark IS NULL OR e.ts > m.mark",
)
def watermark_per_source(spark, sf):
    events = table(spark, sf, "events").drop("props", "value", "user_id")
    early = F.col("ts") <= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    target = events.filter(early | (F.col("event_type") == "view"))
    return shown(newer_than(events, target, "ts", by="event_type"))


@query(
    "late_rows_ignored",
    f"SELECT event_id, {when_text('ts')} AS ts FROM events WHERE ts > "
    "(SELECT max(ts) FROM events WHERE event_type = 'view' AND ts <= TIMESTAMP '2024-01-20 00:00:00')",
)
def late_rows_ignored(spark, sf):
    """Only views are loaded; older rows of other types come late and stay out."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    seen = (F.col("event_type") == "view") & (F.col("ts") <= F.lit(_CUT).cast("timestamp_ntz"))
    return shown(newer_than(events, events.filter(seen), "ts").drop("event_type"))


# Checks.

_STG_BAD = "SELECT book_id, {columns} FROM stg WHERE {where}"


@query("check_not_null", with_stg("SELECT book_id, title FROM stg WHERE category IS NULL"))
def check_not_null(spark, sf):
    return checks.check_not_null(stored_models(spark, sf)["stg_books"], "category").select("book_id", "title")


@query("check_unique", "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def check_unique(spark, sf):
    return checks.check_unique(table(spark, sf, "lineitem"), "l_orderkey")


@query(
    "check_unique_where",
    with_star("SELECT isbn, count(*) AS n_rows FROM dim_books WHERE isbn IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
)
def check_unique_where(spark, sf):
    return checks.check_unique(stored_models(spark, sf)["dim_books"], "isbn", F.col("isbn").isNotNull())


@query(
    "check_unique_combination",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def check_unique_combination(spark, sf):
    return checks.check_unique_combination(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_accepted",
    "SELECT o_orderstatus, count(*) AS n_rows FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1",
)
def check_accepted(spark, sf):
    return checks.check_accepted(table(spark, sf, "orders"), "o_orderstatus", ["F", "O"])


@query(
    "check_relationship",
    "SELECT l_suppkey, count(*) AS n_rows FROM lineitem WHERE l_suppkey NOT IN "
    "(SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1",
)
def check_relationship(spark, sf):
    parents = table(spark, sf, "supplier").filter("s_acctbal > 0")
    return checks.check_relationship(table(spark, sf, "lineitem"), "l_suppkey", parents, "s_suppkey")


@query(
    "check_freshness",
    f"SELECT {when_text('max(ts)')} AS max_loaded_at, "
    "round(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 00:00:00') / 3.6e9, 6) AS age_hours, "
    "CASE WHEN date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 00:00:00') / 3.6e9 > 25 THEN 'error' "
    "WHEN date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 00:00:00') / 3.6e9 > 24 THEN 'warn' "
    "ELSE 'pass' END AS status FROM events",
)
def check_freshness(spark, sf):
    state = checks.check_freshness(table(spark, sf, "events"), "ts", F.lit("2024-02-01 00:00:00"))
    return shown(state.withColumn("age_hours", F.round("age_hours", 6)))


# Every author, book and publisher of these tables has its partner, so one
# side of each pair below is cut down.


def _dear_bridge(m):
    """The bridge over scans above a price only."""
    return marts.build_bridge(marts.build_int_books(m["stg_books"].filter("discount_price > 100000")))


_DEAR = ", dear AS (SELECT DISTINCT book_id, md5(author_name) AS author_id FROM exploded WHERE discount_price > 100000 AND author_name <> '') "


@query(
    "authors_without_books",
    with_star(_DEAR + "SELECT author_id FROM dim_authors WHERE author_id NOT IN (SELECT author_id FROM dear)"),
)
def authors_without_books(spark, sf):
    m = stored_models(spark, sf)
    return checks.authors_without_books(m["dim_authors"], _dear_bridge(m))


@query(
    "books_without_authors",
    with_star(_DEAR + "SELECT book_id FROM dim_books WHERE book_id NOT IN (SELECT book_id FROM dear)"),
)
def books_without_authors(spark, sf):
    m = stored_models(spark, sf)
    return checks.books_without_authors(m["dim_books"], _dear_bridge(m))


@query(
    "books_without_prices",
    with_star(
        "SELECT book_id FROM dim_books WHERE book_id NOT IN (SELECT book_id FROM fct WHERE discount_price > 10000)"
    ),
)
def books_without_prices(spark, sf):
    m = stored_models(spark, sf)
    return checks.books_without_prices(m["dim_books"], m["fct_book_prices"].filter("discount_price > 10000"))


@query(
    "publishers_without_books",
    with_star(
        "SELECT publisher_id FROM dim_publishers WHERE publisher_id NOT IN "
        "(SELECT publisher_id FROM dim_books WHERE publisher_id IS NOT NULL)"
    ),
)
def publishers_without_books(spark, sf):
    m = stored_models(spark, sf)
    return checks.publishers_without_books(m["dim_publishers"], m["dim_books"])


@query(
    "uncovered_dates",
    with_stg(
        "SELECT DISTINCT cast(cast(scraped_at AS DATE) AS VARCHAR) AS scraped_date FROM stg "
        "WHERE cast(scraped_at AS DATE) < DATE '2024-01-11' OR cast(scraped_at AS DATE) > DATE '2024-01-25'"
    ),
)
def uncovered_dates(spark, sf):
    spine = marts.build_dim_date(spark, start="2024-01-11", end="2024-01-25")
    return shown(checks.uncovered_dates(stored_models(spark, sf)["stg_books"], spine))


@query(
    "dates_past_limit",
    with_star("SELECT date_id FROM dim_date WHERE full_date > DATE '2025-12-31'"),
)
def dates_past_limit(spark, sf):
    return calendar(spark, sf).filter(checks.past_date_limit("2025-12-31")).select("date_id")


@query(
    "wrong_weekend_flag",
    with_star("SELECT date_id FROM dim_date WHERE (full_date >= DATE '2025-01-01') <> (isodow(full_date) IN (6, 7))"),
)
def wrong_weekend_flag(spark, sf):
    """The flag is replaced by one that is right by chance only."""
    days = calendar(spark, sf).withColumn("is_weekend", F.col("full_date") >= F.lit("2025-01-01").cast("date"))
    return days.filter(checks.wrong_weekend_flag()).select("date_id")


@query(
    "insane_fact_price",
    with_star(
        "SELECT book_price_daily_pk, book_id FROM fct WHERE old_price < 0 OR discount_price < 0 "
        "OR discount_price > old_price"
    ),
)
def insane_fact_price(spark, sf):
    return stored_models(spark, sf)["fct_book_prices"].filter(checks.insane_price()).select("book_price_daily_pk", "book_id")


@query(
    "unstaged_rows",
    with_stg(
        "SELECT id FROM raw WHERE md5(trim(book_link)) NOT IN (SELECT book_id FROM stg WHERE discount_price > 30000)"
    ),
)
def unstaged_rows(spark, sf):
    m = stored_models(spark, sf)
    return checks.unstaged_rows(m["raw"], m["stg_books"].filter("discount_price > 30000"))


@query("future_publication_year", with_stg("SELECT book_id, year_of_publication FROM stg WHERE year_of_publication > 2024"))
def future_publication_year(spark, sf):
    bad = stored_models(spark, sf)["stg_books"].filter(checks.future_year("2024-02-01"))
    return bad.select("book_id", "year_of_publication")


@query(
    "malformed_link",
    with_stg("SELECT book_id, book_link FROM stg WHERE NOT regexp_matches(book_link, '^https?://.+', 'i')"),
)
def malformed_link(spark, sf):
    return stored_models(spark, sf)["stg_books"].filter(checks.malformed_link()).select("book_id", "book_link")


@query(
    "malformed_isbn",
    with_raw(
        "SELECT id, isbn FROM (SELECT id, nullif(regexp_extract(description, "
        "'(?:ISBN|ИСБН)\\s*[: ]?\\s*([0-9-]+[0-9X])', 1, 'i'), '') AS isbn FROM raw) WHERE isbn IS NOT NULL AND NOT "
        "regexp_matches(regexp_replace(isbn, '[-\\s]', '', 'g'), '^([0-9]{9}[0-9Xx]|[0-9]{13})$')"
    ),
)
def malformed_isbn(spark, sf):
    """Numbers as found in the text, before staging drops the bad ones."""
    from shelftrack.functions import extract_isbn

    found = raw_books(spark, sf).select("id", extract_isbn("description").alias("isbn"))
    return found.filter(checks.malformed_isbn())


@query("non_positive_pages", with_stg("SELECT book_id, page_numbers FROM stg WHERE page_numbers <= 0"))
def non_positive_pages(spark, sf):
    return stored_models(spark, sf)["stg_books"].filter(checks.no_pages()).select("book_id", "page_numbers")


@query(
    "discount_above_old",
    with_stg(
        f"SELECT book_id, {shown_price('old_price')} AS old_price, {shown_price('discount_price')} AS discount_price "
        "FROM stg WHERE discount_price > old_price"
    ),
)
def discount_above_old(spark, sf):
    bad = stored_models(spark, sf)["stg_books"].filter(checks.discount_above_old())
    return shown(bad.select("book_id", "old_price", "discount_price"))


_OUTLIERS = with_stg(
        ", stats AS (SELECT avg(cast(old_price AS DOUBLE)) AS ao, stddev_samp(cast(old_price AS DOUBLE)) AS so, "
        "avg(cast(discount_price AS DOUBLE)) AS ad, stddev_samp(cast(discount_price AS DOUBLE)) AS sd FROM stg) "
        f"SELECT book_id, {shown_price('old_price')} AS old_price, {shown_price('discount_price')} AS discount_price "
        "FROM stg, stats WHERE (so > 0 AND old_price > ao + 5 * so) OR (sd > 0 AND discount_price > ad + 5 * sd)"
    )


@query("price_outliers", _OUTLIERS)
def price_outliers(spark, sf):
    bad = upper_outliers(stored_models(spark, sf)["stg_books"], ["old_price", "discount_price"])
    return shown(bad.select("book_id", "old_price", "discount_price"))


@query("price_outliers_by_day", _OUTLIERS)
def price_outliers_by_day(spark, sf):
    """Three loads, after each the moments of the days it touched: the same rows as by one pass over all."""
    from uuid import uuid4

    from shelftrack.plans.warehouse import Warehouse

    warehouse = Warehouse(spark, f"{shared_folder(spark)}/workload/{uuid4()}/warehouse")
    raw = raw_books(spark, sf)
    for batch, cut in (("first", "2024-01-08 12:00:00"), ("second", "2024-01-20 22:30:00"), ("third", "2100-01-01 00:00:00")):
        warehouse.update_staging(raw.filter(F.col("scraped_at") <= F.lit(cut).cast("timestamp")), batch, F.lit("2024-02-01 00:00:00").cast("timestamp"))
        warehouse.update_price_moments(batch)
    return shown(warehouse.price_outliers().select("book_id", "old_price", "discount_price"))


def _suite_sql() -> str:
    """Counts of every rule, written out one by one."""
    tables = {
        "raw": "raw", "stg_books": "stg", "int_books": "ints", "dim_date": "dim_date", "dim_authors": "dim_authors",
        "dim_publishers": "dim_publishers", "dim_books": "dim_books", "brg_book_author": "brg",
        "fct_book_prices": "fct",
    }
    parts = []

    def add(name: str, select: str) -> None:
        parts.append(f"SELECT '{name}' AS \"check\", ({select}) AS n_violations")

    for name, columns in suite.NOT_NULL.items():
        for column in columns:
            add(f"not_null_{name}_{column}", f"SELECT count(*) FROM {tables[name]} WHERE {column} IS NULL")
    for name, column in suite.UNIQUE:
        add(
            f"unique_{name}_{column}",
            f"SELECT count(*) FROM (SELECT {column} FROM {tables[name]} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1)",
        )
    for name, column, values in suite.ACCEPTED:
        listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
        add(
            f"accepted_values_{name}_{column}",
            f"SELECT count(DISTINCT {column}) FROM {tables[name]} WHERE {column} NOT IN ({listed})",
        )
    for name, column, parent, key in suite.RELATIONSHIPS:
        add(
            f"relationships_{name}_{column}_{parent}",
            f"SELECT count(*) FROM {tables[name]} c WHERE {column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {tables[parent]} p WHERE p.{key} = c.{column})",
        )
    add(
        "unique_combination_brg_book_author_book_id_author_id",
        "SELECT count(*) FROM (SELECT 1 FROM brg GROUP BY book_id, author_id HAVING count(*) > 1)",
    )
    anti = "SELECT count(*) FROM {a} a WHERE NOT EXISTS (SELECT 1 FROM {b} b WHERE b.{k} = a.{k})"
    add("authors_without_books", anti.format(a="dim_authors", b="brg", k="author_id"))
    add("books_without_authors", anti.format(a="dim_books", b="brg", k="book_id"))
    add("books_without_prices", anti.format(a="dim_books", b="fct", k="book_id"))
    add("publishers_without_books", anti.format(a="dim_publishers", b="dim_books", k="publisher_id"))
    add(
        "uncovered_dates",
        "SELECT count(DISTINCT cast(scraped_at AS DATE)) FROM stg WHERE cast(scraped_at AS DATE) NOT IN "
        "(SELECT full_date FROM dim_date)",
    )
    add("dates_past_limit", "SELECT count(*) FROM dim_date WHERE full_date > DATE '2030-12-31'")
    add("wrong_weekend_flag", "SELECT count(*) FROM dim_date WHERE is_weekend <> (isodow(full_date) IN (6, 7))")
    add(
        "insane_fact_price",
        "SELECT count(*) FROM fct WHERE old_price < 0 OR discount_price < 0 OR discount_price > old_price",
    )
    add(
        "unstaged_rows",
        "SELECT count(*) FROM raw r WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE s.book_id = md5(trim(r.book_link)))",
    )
    add("future_publication_year", "SELECT count(*) FROM stg WHERE year_of_publication > 2024")
    add("malformed_link", "SELECT count(*) FROM stg WHERE NOT regexp_matches(book_link, '^https?://.+', 'i')")
    add(
        "malformed_isbn",
        "SELECT count(*) FROM stg WHERE isbn IS NOT NULL AND NOT "
        "regexp_matches(isbn, '^([0-9]{9}[0-9Xx]|[0-9]{13})$')",
    )
    add("non_positive_pages", "SELECT count(*) FROM stg WHERE page_numbers <= 0")
    add("discount_above_old", "SELECT count(*) FROM stg WHERE discount_price > old_price")
    add(
        "price_outliers",
        "SELECT count(*) FROM stg, stats WHERE (so > 0 AND old_price > ao + 5 * so) "
        "OR (sd > 0 AND discount_price > ad + 5 * sd)",
    )
    extra = (
        ", ints AS (SELECT * REPLACE (publisher AS publisher), publisher AS publisher_name FROM exploded), "
        "stats AS (SELECT avg(cast(old_price AS DOUBLE)) AS ao, stddev_samp(cast(old_price AS DOUBLE)) AS so, "
        "avg(cast(discount_price AS DOUBLE)) AS ad, stddev_samp(cast(discount_price AS DOUBLE)) AS sd FROM stg) "
    )
    union = " UNION ALL ".join(parts)
    return with_star(f"{extra} SELECT \"check\", n_violations, n_violations = 0 AS passed FROM ({union})")


@query("run_checks", _suite_sql())
def run_checks(spark, sf):
    """All 76 rules over the stored models."""
    return checks.run_checks(stored_models(spark, sf), suite.warehouse_checks("2024-02-01"))


@query(
    "source_checks",
    with_raw(
        "SELECT 'not_null_raw_discount_price' AS \"check\", count(*) AS n_violations, count(*) = 0 AS passed FROM raw "
        "WHERE discount_price IS NULL "
        + "".join(
            f"UNION ALL SELECT 'not_null_raw_{c}', count(*), count(*) = 0 FROM raw WHERE {c} IS NULL "
            for c in ("id", "title", "book_link", "publisher", "scraped_at")
        )
        + "UNION ALL SELECT 'unique_raw_id', count(*), count(*) = 0 FROM "
        "(SELECT id FROM raw GROUP BY id HAVING count(*) > 1) "
        "UNION ALL SELECT 'accepted_values_raw_currency', count(DISTINCT currency), count(DISTINCT currency) = 0 "
        "FROM raw WHERE currency <> 'RSD'"
    ),
)
def source_checks(spark, sf):
    return checks.run_checks({"raw": raw_books(spark, sf)}, suite.source_checks())

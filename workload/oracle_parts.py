"""SQL building blocks for the reference results.

The texts of the raw table are made from numbers (``book_tables``), so what must
be read back from them - price, author, publisher, script, pages, year - follows
from those numbers and the case of the text. Nothing is parsed here but the year
inside runs of digits, with the contract's own pattern.
"""

from __future__ import annotations

from shelftrack import fixed_values as fixed
from workload.book_tables import CENTS, DIGITS, PRICES, RAW_BOOKS

ZONE = "Europe/Belgrade"
TIME_TEXT = "'%Y-%m-%d %H:%M:%S.%f'"


def when_text(column: str) -> str:
    return f"strftime({column}, {TIME_TEXT})"


def local(column: str) -> str:
    return f"({column} AT TIME ZONE 'UTC' AT TIME ZONE '{ZONE}')"


def shown_price(column: str) -> str:
    return f"round(cast({column} AS DOUBLE), 4)"


def mean_of_cents(cents: str) -> str:
    """The mean of whole cents in currency units, rounded half up to four places, in whole numbers."""
    return f"((200 * sum({cents}) + count({cents})) // (2 * count({cents}))) / 10000.0"


def price(column: str) -> str:
    """The price that ``old_price`` or ``discount_price`` of ``told`` stands for."""
    cents, shift = {"old_price": ("old_cents", 0), "discount_price": ("new_cents", 2)}[column]
    # Without decimals: two forms of whole prices, and one digit behind a comma, which is no decimal.
    return (
        f"CASE (event_id + {shift}) % 9 WHEN 3 THEN NULL WHEN 5 THEN NULL "
        f"WHEN 2 THEN cast({cents} // 100 AS DECIMAL(18, 2)) WHEN 4 THEN cast({cents} // 100 AS DECIMAL(18, 2)) "
        f"WHEN 6 THEN cast({cents} // 100 * 10 + {cents} % 10 AS DECIMAL(18, 2)) "
        f"ELSE cast(cast({cents} AS DECIMAL(16, 0)) * 0.01 AS DECIMAL(18, 2)) END"
    )


AUTHOR = (
    f"CASE user_id % 8 WHEN 0 THEN '{fixed.UNKNOWN_AUTHOR}' WHEN 1 THEN '{fixed.UNKNOWN_AUTHOR}' WHEN 2 THEN '{fixed.UNKNOWN_AUTHOR}' "
    "WHEN 3 THEN 'Ana Anić, Bora Borić ' || cast(user_id % 5 AS VARCHAR) WHEN 4 THEN 'Ana Anić ,Vuk Vukić,' "
    "ELSE 'Pisac ' || cast(user_id % 40 AS VARCHAR) END"
)
_FIVE_DIGITS = "lpad(cast(user_id % 100000 AS VARCHAR), 5, '0')"
_THREE_DIGITS = "lpad(cast(user_id % 1000 AS VARCHAR), 3, '0')"
ISBN_FOUND = (
    f"CASE event_id % 7 WHEN 0 THEN '978-86-0' || {_THREE_DIGITS} || '-123-4' WHEN 1 THEN '86-70' || {_FIVE_DIGITS} || '-2X' "
    f"WHEN 4 THEN '8670' || {_FIVE_DIGITS} || 'x' WHEN 5 THEN '978' END"
)
ISBN_VALID = f"CASE event_id % 7 WHEN 0 THEN '978860' || {_THREE_DIGITS} || '1234' WHEN 4 THEN '8670' || {_FIVE_DIGITS} || 'x' END"
PUBLISHER_LINE = (
    "CASE event_id % 7 WHEN 0 THEN 'Primer KNJIGA-' || cast(user_id % 9 AS VARCHAR) || ' Strana: ' "
    "|| cast(event_id % 900 AS VARCHAR) || ' Povez: broš' WHEN 4 THEN 'Test DOO' "
    "WHEN 6 THEN 'Naslov ' || cast(user_id % 3 AS VARCHAR) || ' strana: 5' END"
)
PUBLISHER_CUT = (
    "CASE event_id % 7 WHEN 0 THEN 'Primer KNJIGA-' || cast(user_id % 9 AS VARCHAR) WHEN 4 THEN 'Test DOO' "
    "WHEN 6 THEN 'Naslov ' || cast(user_id % 3 AS VARCHAR) END"
)
HOUSE = "'O''Kuća-' || upper(event_type[1]) || event_type[2:] || ' D.O.O. Šabac'"
PUBLISHER = (
    "CASE WHEN user_id % 4 <> 0 THEN " + HOUSE + " WHEN event_id % 7 = 0 THEN 'Primer Knjiga-' || cast(user_id % 9 AS VARCHAR) "
    "WHEN event_id % 7 = 4 THEN 'Test Doo' WHEN event_id % 7 = 6 THEN 'Naslov ' || cast(user_id % 3 AS VARCHAR) ELSE " + HOUSE + " END"
)
SCRIPT = (
    f"CASE event_id % 7 WHEN 0 THEN '{fixed.LATIN_SCRIPT}' WHEN 5 THEN '{fixed.LATIN_SCRIPT}' "
    f"WHEN 1 THEN '{fixed.CYRILLIC_SCRIPT}' WHEN 6 THEN '{fixed.CYRILLIC_SCRIPT}' END"
)
PAGES = (
    "cast(CASE event_id % 7 WHEN 0 THEN event_id % 900 WHEN 1 THEN event_id % 500 WHEN 2 THEN event_id % 77 "
    "WHEN 6 THEN event_id % 5 END AS INTEGER)"
)


def _year_in(digits: str) -> str:
    return f"try_cast(nullif(regexp_extract({digits}, '{fixed.YEAR_PATTERN}', 1), '') AS INTEGER)"


YEAR = (
    "CASE event_id % 7 WHEN 0 THEN CASE WHEN event_id % 240 BETWEEN 5 AND 234 THEN cast(1795 + event_id % 240 AS INTEGER) END "
    f"WHEN 1 THEN {_year_in(f"'70' || {_FIVE_DIGITS}")} WHEN 2 THEN 1800 WHEN 4 THEN {_year_in(f"'8670' || {_FIVE_DIGITS}")} "
    f"WHEN 5 THEN {_year_in("'4' || cast(20190000 + event_id AS VARCHAR)")} END"
)


def key(*columns: str) -> str:
    parts = [f"coalesce(cast({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


RAW = (
    f"cents AS (SELECT {', '.join(CENTS)} FROM events), "
    f"digits AS (SELECT {', '.join(DIGITS)} FROM cents), "
    f"prices AS (SELECT {', '.join(PRICES)} FROM digits), "
    f"raw AS (SELECT {', '.join(RAW_BOOKS)} FROM prices), "
    "told AS (SELECT raw.*, event_id, user_id, event_type, old_cents, new_cents FROM raw JOIN cents ON id = cast(event_id AS VARCHAR))"
)
STG = f"""{RAW},
stg_all AS (SELECT
  md5(trim(book_link)) AS book_id, trim(title) AS title, {AUTHOR} AS author,
  trim(book_link) AS book_link, trim(category) AS category, {PUBLISHER} AS publisher,
  {price('old_price')} AS old_price, {price('discount_price')} AS discount_price,
  'RSD' AS currency, {ISBN_VALID} AS isbn, {local('scraped_at')} AS scraped_at,
  {local("TIMESTAMP '2024-02-01 00:00:00'")} AS updated_at,
  {SCRIPT} AS script_type, {PAGES} AS page_numbers,
  {YEAR} AS year_of_publication FROM told),
stg AS (SELECT * FROM stg_all WHERE old_price IS NOT NULL OR discount_price IS NOT NULL)"""
CALENDAR = """today AS (SELECT cast(max(ts) AS DATE) AS d FROM events),
days AS (SELECT cast(unnest(generate_series(cast(date_trunc('month', d - INTERVAL 1 MONTH) AS TIMESTAMP),
  cast(d + INTERVAL 2 YEAR AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS full_date FROM today),
dim_date AS (SELECT cast(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id, full_date,
  cast(day(full_date) AS INTEGER) AS day_of_month, cast(month(full_date) AS INTEGER) AS month_of_year,
  cast(year(full_date) AS INTEGER) AS year, cast(quarter(full_date) AS INTEGER) AS quarter_of_year,
  dayname(full_date) AS day_name, cast(isodow(full_date) AS INTEGER) AS day_of_week_iso,
  isodow(full_date) IN (6, 7) AS is_weekend FROM days)"""
AUTHORS = """exploded AS (SELECT *, trim(unnest(string_split(author, ','))) AS author_name FROM stg),
dim_authors AS (SELECT md5(author_name) AS author_id, author_name FROM
  (SELECT DISTINCT author_name FROM exploded WHERE author_name <> '')),
brg AS (SELECT DISTINCT e.book_id, a.author_id FROM exploded e JOIN dim_authors a USING (author_name))"""
PUBLISHERS = """dim_publishers AS (SELECT md5(publisher) AS publisher_id, publisher AS publisher_name FROM
  (SELECT DISTINCT publisher FROM stg WHERE publisher <> ''))"""
BOOKS = """dim_books AS (SELECT s.book_id, p.publisher_id, s.title, s.category, s.isbn, s.script_type, s.page_numbers,
  s.year_of_publication, s.scraped_at AS last_scraped_at, s.updated_at AS dbt_last_processed_at
  FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY scraped_at DESC) AS rn FROM stg) s
  LEFT JOIN dim_publishers p ON s.publisher = p.publisher_name WHERE rn = 1)"""
FACT = f"""fct AS (SELECT {key('s.book_id', 'cast(s.scraped_at AS DATE)')} AS book_price_daily_pk, s.book_id, d.date_id,
  p.publisher_id, s.currency, s.old_price, s.discount_price, s.scraped_at AS max_scraped_at
  FROM (SELECT *, row_number() OVER (PARTITION BY book_id, cast(scraped_at AS DATE)
        ORDER BY scraped_at DESC) AS rn FROM stg) s
  LEFT JOIN dim_date d ON cast(s.scraped_at AS DATE) = d.full_date
  LEFT JOIN dim_publishers p ON s.publisher = p.publisher_name WHERE rn = 1)"""
STAR = ",\n".join([STG, CALENDAR, AUTHORS, PUBLISHERS, BOOKS, FACT])


def with_raw(select: str) -> str:
    return f"WITH {RAW} {select}"


def with_stg(select: str) -> str:
    return f"WITH {STG} {select}"


def with_star(select: str) -> str:
    return f"WITH {STAR} {select}"

"""Book scans told from the ``events`` table.

The given tables hold no book data, so an event is read as one scan of a
book: the user is the book, the event type the publisher, the value the
price. The expressions below are plain SQL that Spark and the reference
database both read, so both sides start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftrack import prepare
from shelftrack.plans import marts
from shelftrack.plans.staging import build_stg_books, one_per_scan
from shelftrack.plans.warehouse import Warehouse
from shelftrack.sources.tables import is_table, shared_folder

CENTS = [
    "event_id",
    "user_id",
    "event_type",
    "ts",
    "cast(round(value * 5000) as bigint) AS old_cents",
    "cast(round(value * (CASE WHEN event_id % 23 = 0 THEN 6100 ELSE 3700 END)) as bigint) AS new_cents",
]


def _digits(name: str) -> list[str]:
    return [
        f"cast(floor({name}_cents / 100) as bigint) AS {name}_whole",
        f"lpad(cast({name}_cents % 100 as string), 2, '0') AS {name}_part",
        f"cast({name}_cents % 10 as string) AS {name}_digit",
    ]


def _thousands(name: str) -> list[str]:
    return [
        f"cast({name}_whole as string) AS {name}_plain",
        f"CASE WHEN {name}_whole >= 1000 THEN cast(cast(floor({name}_whole / 1000) as bigint) as string) || '.' "
        f"|| lpad(cast({name}_whole % 1000 as string), 3, '0') ELSE cast({name}_whole as string) END AS {name}_grouped",
        f"{name}_part",
        f"{name}_digit",
    ]


_EVENT = ["event_id", "user_id", "event_type", "ts"]
DIGITS = _EVENT + _digits("old") + _digits("new")
PRICES = _EVENT + _thousands("old") + _thousands("new")


def _price_text(name: str, shift: int) -> str:
    return (
        f"CASE (event_id + {shift}) % 9 "
        f"WHEN 0 THEN {name}_grouped || ',' || {name}_part || ' RSD' "
        f"WHEN 1 THEN replace({name}_grouped, '.', ',') || '.' || {name}_part "
        f"WHEN 2 THEN {name}_plain || ' din.' "
        f"WHEN 3 THEN 'None' "
        f"WHEN 4 THEN 'RSD ' || {name}_grouped "
        f"WHEN 5 THEN 'na upit' "
        f"WHEN 6 THEN {name}_grouped || ',' || {name}_digit "
        f"ELSE {name}_grouped || ',' || {name}_part END"
    )


RAW_BOOKS = [
    "cast(event_id as string) AS id",
    "'  Knjiga ' || cast(user_id as string) || ' ' AS title",
    "CASE user_id % 8 WHEN 0 THEN cast(NULL as string) WHEN 1 THEN '   ' WHEN 2 THEN 'None' "
    "WHEN 3 THEN 'Ana Anić, Bora Borić ' || cast(user_id % 5 as string) WHEN 4 THEN ' Ana Anić ,Vuk Vukić, ' "
    "ELSE 'Pisac ' || cast(user_id % 40 as string) END AS author",
    "CASE user_id % 4 WHEN 0 THEN ' https://www.mikroknjiga.rs/store/knjiga?id=' || cast(user_id as string) "
    "WHEN 1 THEN 'HTTP://knjige.' || event_type || '.rs/' || cast(user_id as string) || '  ' "
    "WHEN 2 THEN 'https://izdanja.rs/k/' || cast(user_id as string) "
    "ELSE 'knjige/' || cast(user_id as string) END AS book_link",
    "CASE WHEN user_id % 6 = 0 THEN NULL ELSE ' Oblast ' || cast(user_id % 6 as string) END AS category",
    _price_text("old", 0) + " AS old_price",
    _price_text("new", 2) + " AS discount_price",
    "'RSD' AS currency",
    "' o''kuća-' || event_type || ' d.o.o. ŠABAC' AS publisher",
    "CASE event_id % 7 "
    "WHEN 0 THEN 'Roman.' || chr(10) || 'Izdavač: Primer KNJIGA-' || cast(user_id % 9 as string) || ' Strana: ' "
    "|| cast(event_id % 900 as string) || ' Povez: broš' || chr(10) || 'Pismo: Latinica' || chr(10) "
    "|| 'ISBN: 978-86-0' || lpad(cast(user_id % 1000 as string), 3, '0') || '-123-4 Godina izdanja: ' "
    "|| cast(1795 + event_id % 240 as string) "
    "WHEN 1 THEN 'исбн 86-70' || lpad(cast(user_id % 100000 as string), 5, '0') || '-2X' || chr(10) "
    "|| 'Број страна / ' || cast(event_id % 500 as string) || ' /' || chr(10) || 'Писмо: ћирилица' "
    "WHEN 2 THEN 'Strana u boji: 16 Broj strana: ' || cast(event_id % 77 as string) || ', format 1800x900' "
    "WHEN 3 THEN cast(NULL as string) "
    "WHEN 4 THEN 'broj strana: 99 isbn 8670' || lpad(cast(user_id % 100000 as string), 5, '0') "
    "|| 'x IZDAVAČ: Test DOO' || chr(10) || 'ostalo' "
    "WHEN 5 THEN 'ISBN 978 pismo LATINICA i ćirilica, šifra 4' || cast(20190000 + event_id as string) "
    "ELSE 'Страна: ' || cast(event_id % 5 as string) || ' ĆIRILICA, izdavač: Naslov ' || cast(user_id % 3 as string) "
    "|| ' strana: 5' END AS description",
    "ts AS scraped_at",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_FILE_ROWS = 100_000


def spread(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The rows dealt out evenly, in parts of at most ``_FILE_ROWS``, equally many for every core.

    A file of few bytes can hold millions of events, and a task takes no less than a row group:
    what is made of them would be made by as many tasks as the file has groups.
    """
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores * max(1, -(-rows.count() // (cores * _FILE_ROWS))))


def raw_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table, typed and stored as the loader leaves it; written once per session."""
    path = f"{shared_folder(prepare(spark))}/{spark.sparkContext.applicationId}/raw{sf_dir.replace('/', '-')}"
    if not is_table(spark, path):
        scans = spread(spark, table(spark, sf_dir, "events").drop("props"))
        for step in (CENTS, DIGITS, PRICES, RAW_BOOKS):
            scans = scans.selectExpr(*step)
        scans = scans.withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
        scans.write.parquet(path)
    return spark.read.parquet(path)


def last_day(events: DataFrame, column: str = "ts") -> Column:
    """The day of the newest row: the run date of these tables."""
    return events.agg(F.to_date(F.max(column))).scalar()


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return marts.build_dim_date(spark, as_of=last_day(events))


_AS_OF = "2024-02-01 00:00:00"


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging from raw text."""
    return one_per_scan(build_stg_books(raw_books(spark, sf_dir), F.lit(_AS_OF).cast("timestamp")))


def models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The marts, to be computed from the stored staging table."""
    stored = stored_models(spark, sf_dir)
    stg, dim_date = stored["stg_books"], calendar(spark, sf_dir)
    int_books = marts.build_int_books(stg)
    return {
        "stg_books": stg,
        "int_books": int_books,
        "dim_date": dim_date,
        "dim_authors": marts.build_dim_authors(int_books),
        "dim_publishers": marts.build_dim_publishers(stg),
        "dim_books": marts.build_dim_books(stg),
        "brg_book_author": marts.build_bridge(int_books),
        "fct_book_prices": marts.build_fct_prices(stg, dim_date),
    }


_stored: dict[tuple[str, str], dict[str, DataFrame]] = {}


def stored_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The models as the warehouse stores them; written once per session."""
    known = _stored.get((spark.sparkContext.applicationId, sf_dir))
    if known is not None:
        return known
    root = f"{shared_folder(prepare(spark))}/{spark.sparkContext.applicationId}/warehouse{sf_dir.replace('/', '-')}"
    warehouse = Warehouse(spark, root)
    raw = raw_books(spark, sf_dir)
    # The last tables to be written are the dimensions.
    if not is_table(spark, warehouse.path("brg_book_author")):
        warehouse.refresh(raw, calendar(spark, sf_dir), F.lit(_AS_OF).cast("timestamp"))
    names = ("stg_books", "dim_date", "dim_authors", "dim_publishers", "dim_books", "brg_book_author", "fct_book_prices")
    stored = {name: warehouse.table(name) for name in names}
    stored |= {"raw": raw, "int_books": marts.build_int_books(stored["stg_books"])}
    _stored[spark.sparkContext.applicationId, sf_dir] = stored
    return stored


def rounded_mean(name: str) -> Column:
    """An exact decimal mean, rounded half up to four places."""
    return F.round(F.col(name), 4).cast("double").alias(name)


def shown(df: DataFrame) -> DataFrame:
    """Columns as the comparison wants them: days and times as text, prices as doubles."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "date":
            column = column.cast("string")
        elif kind.startswith("decimal"):
            column = F.round(column.cast("double"), 4)
        columns.append(column.alias(name))
    return df.select(*columns)

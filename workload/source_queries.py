"""Sources and sinks: landed files, run statistics, pages and the stream.

Landed files are written from the ``events`` table, one source per event
type, into a fresh folder of the shared checkpoint area.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack import schemas
from shelftrack.plans.warehouse import Warehouse
from shelftrack.sources import landing, pages, raw_table, run_stats, tables
from shelftrack.sources.page_rules import PageRules
from shelftrack.sources.page_tree import Field
from shelftrack.streaming import landing_stream, state_upsert, streaming_upsert
from workload import oracle_parts as sql
from workload.book_tables import calendar, raw_books, shown, table
from workload.model_queries import _FCT_SHOWN
from workload.registry import query

_SOURCES = ("click", "error", "purchase", "signup", "view")
_SOURCE_OF_RAW = "regexp_extract(publisher, 'ku[^-]*-([a-z]+) ', 1)"


def _fresh(spark, name: str) -> str:
    return f"{tables.shared_folder(spark)}/workload/{uuid4()}/{name}"


def _records(spark, sf):
    """Raw rows as records that are still to be landed, with their source."""
    records = raw_books(spark, sf).withColumn("source", F.regexp_extract("publisher", r"ku\S*?-([a-z]+) ", 1))
    return records.withColumn("scraped_at", F.concat(F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))


def _landed(spark, sf, change=None) -> str:
    root = _fresh(spark, "landing")
    records = _records(spark, sf)
    landing.write_landing(records if change is None else change(records), root)
    return f"{root}/{fixed.LANDING_FOLDER}"


def _cell(column: str) -> str:
    return f"CASE WHEN trim({column}) IN ('', 'None') THEN NULL ELSE trim({column}) END"


_LANDED_COLUMNS = ", ".join(
    f"{_cell(c)} AS {c}" for c in fixed.RECORD_FIELDS
) + ", strftime(scraped_at, '%Y-%m-%d %H:%M:%S') || ' UTC' AS scraped_at"
_LANDED = f"landed AS (SELECT {_LANDED_COLUMNS}, {_SOURCE_OF_RAW} AS source FROM raw)"


@query("read_landing", sql.with_raw(f", {_LANDED} SELECT * FROM landed"))
def read_landing(spark, sf):
    return landing.read_landing(spark, _landed(spark, sf), _SOURCES).drop("file", "surplus", "line")


@query(
    "read_landing_mixed_headers",
    sql.with_raw(f", {_LANDED} SELECT * FROM landed WHERE source <> 'view'"),
)
def mixed_headers(spark, sf):
    """One source lands its columns in reverse order, another lacks one and is skipped."""
    root = _fresh(spark, "landing")
    records = _records(spark, sf)
    columns = list(fixed.REQUIRED_COLUMNS)
    for source, names in (("click", columns[::-1]), ("view", [c for c in columns if c != "category"])):
        batch = records.filter(F.col("source") == source).select(*names)
        batch.write.option("header", "true").option("escape", '"').csv(f"{root}/{fixed.LANDING_FOLDER}/{source}")
    landing.write_landing(records.filter(~F.col("source").isin("click", "view")), root)
    return landing.read_landing(spark, f"{root}/{fixed.LANDING_FOLDER}", _SOURCES).drop("file", "surplus", "line")


@query("skipped_files", "SELECT DISTINCT event_type AS source, 'category' AS missing FROM events WHERE event_type = 'view'")
def skipped(spark, sf):
    root = _fresh(spark, "landing")
    records = _records(spark, sf)
    lacking = [c for c in fixed.REQUIRED_COLUMNS if c != "category"]
    folder = f"{root}/{fixed.LANDING_FOLDER}"
    records.filter("source = 'view'").select(*lacking).write.option("header", "true").csv(f"{folder}/view")
    landing.write_landing(records.filter("source <> 'view'"), root)
    found = landing.skipped_files(landing.scan_landing(spark, folder, _SOURCES))
    return found.select("source", F.explode("missing").alias("missing")).distinct()


@query("strip_all", sql.with_raw("SELECT id, regexp_replace(title, '^\\s+|\\s+$', '', 'g') AS title, regexp_replace(author, '^\\s+|\\s+$', '', 'g') AS author, user_link FROM (SELECT *, regexp_replace(book_link, '^\\s+|\\s+$', '', 'g') AS user_link FROM raw)"))
def strip_all(spark, sf):
    rows = raw_books(spark, sf).select("id", "title", "author", F.col("book_link").alias("user_link"))
    return landing.strip_all(rows)


@query("project_required", sql.with_raw("SELECT title, author, book_link, category, old_price, discount_price, currency, publisher, description, strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at FROM raw"))
def project_required(spark, sf):
    rows = raw_books(spark, sf).withColumn("scraped_at", F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss"))
    return landing.project_required(rows)


def _half_bad(records):
    """One source forgets all its titles; another writes a currency that is too long."""
    untitled = F.when(F.col("source") != "signup", F.col("title"))
    currency = F.when(F.col("source") == "error", "dinar").otherwise(F.col("currency"))
    return records.withColumn("title", untitled).withColumn("currency", currency)


_ACCEPTED = (
    f"SELECT title, author, book_link, category, old_price, discount_price, currency, publisher, description, scraped_at "
    f"FROM landed WHERE source NOT IN ('signup', 'error')"
)


@query("append_raw", sql.with_raw(f", {_LANDED} SELECT * REPLACE (left(scraped_at, 19) AS scraped_at) FROM ({_ACCEPTED})"))
def append_raw(spark, sf):
    path = _fresh(spark, "raw")
    scanned = landing.scan_landing(spark, _landed(spark, sf, _half_bad), _SOURCES)
    raw_table.append_raw(spark, scanned, path, "first")
    # The same batch again replaces itself.
    raw_table.append_raw(spark, scanned, path, "first")
    stored = spark.read.parquet(path)
    return stored.withColumn("scraped_at", F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss")).select(*fixed.REQUIRED_COLUMNS)


_WITHOUT_SIGNUPS = (
    "SELECT title, author, book_link, category, old_price, discount_price, currency, publisher, description, left(scraped_at, 19) AS scraped_at, "
    "source = 'signup' AS refused FROM landed"
)


@query("append_raw_repeated", sql.with_raw(f", {_LANDED} {_WITHOUT_SIGNUPS} WHERE source <> 'signup' UNION ALL SELECT * REPLACE (NULL AS title) FROM ({_WITHOUT_SIGNUPS} WHERE source = 'signup')"))
def append_raw_repeated(spark, sf):
    """A batch is loaded again after the files of one source have lost their titles: of that source nothing stays but refused rows."""
    path = _fresh(spark, "raw")
    for change in (None, lambda records: records.withColumn("title", F.when(F.col("source") != "signup", F.col("title")))):
        scanned = landing.scan_landing(spark, _landed(spark, sf, change), _SOURCES)
        raw_table.append_raw(spark, scanned, path, "first", f"{path}-refused")
    stored = raw_table.read_batch(spark, path, "first").withColumn("refused", F.lit(False))
    stored = stored.withColumn("scraped_at", F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss"))
    refused = spark.read.parquet(f"{path}-refused").withColumn("refused", F.lit(True)).withColumn("scraped_at", F.substring("scraped_at", 1, 19))
    columns = [*fixed.REQUIRED_COLUMNS, "refused"]
    return stored.select(*columns).unionByName(refused.select(*columns))


@query(
    "load_metrics",
    "SELECT event_type AS source, count(*) AS n_rows, CASE WHEN event_type IN ('signup', 'error') THEN count(*) ELSE 0 END AS bad_rows, "
    "CASE event_type WHEN 'signup' THEN 'title is null' WHEN 'error' THEN 'currency is too long' END AS reason "
    "FROM events GROUP BY 1",
)
def load_metrics(spark, sf):
    scanned = landing.scan_landing(spark, _landed(spark, sf, _half_bad), _SOURCES)
    per_file = raw_table.load_metrics(scanned)
    return per_file.groupBy("source").agg(
        F.sum("rows").alias("n_rows"), F.sum("bad_rows").alias("bad_rows"), F.min("reason").alias("reason")
    )


@query(
    "malformed_files",
    "SELECT event_type AS source, count(*) AS n_rows, "
    "CASE event_type WHEN 'view' THEN 'more fields than the header' END AS reason FROM events GROUP BY 1 "
    "UNION ALL SELECT 'empty', 0, NULL UNION ALL SELECT 'header', 0, NULL",
)
def malformed_files(spark, sf):
    """One source writes a field too many in every row, two more land a file without rows."""
    root = _fresh(spark, "landing")
    records = _records(spark, sf)
    landing.write_landing(records.filter("source <> 'view'"), root)
    folder = f"{root}/{fixed.LANDING_FOLDER}"
    cells = [F.concat(F.lit('"'), F.coalesce(F.replace(c, F.lit('"'), F.lit('""')), F.lit("")), F.lit('"')) for c in fixed.REQUIRED_COLUMNS]
    # Lines as they are: no quoting, and a separator that no text has. Every file begins with the header.
    lines = records.filter("source = 'view'").select(F.concat_ws(",", *cells, F.lit("surplus")).alias(",".join(fixed.REQUIRED_COLUMNS)))
    plain = {"quote": "\0", "sep": "\1"}
    lines.write.options(**plain, header=True).csv(f"{folder}/view")
    nothing = lines.limit(0).coalesce(1)
    nothing.write.options(**plain, header=True).csv(f"{folder}/header")
    nothing.write.options(**plain).csv(f"{folder}/empty")
    metrics = raw_table.load_metrics(landing.scan_landing(spark, folder, (*_SOURCES, "empty", "header")))
    return metrics.groupBy("source").agg(F.sum("rows").alias("n_rows"), F.min("reason").alias("reason"))


@query("loaded_total", "SELECT count(*) AS rows_loaded FROM events WHERE event_type NOT IN ('signup', 'error')")
def loaded_total(spark, sf):
    landed = landing.read_landing(spark, _landed(spark, sf, _half_bad), _SOURCES)
    return raw_table.loaded_total(raw_table.load_metrics(landed)).select("rows_loaded")


@query("refused_rows", "SELECT event_type AS source, count(*) AS n_rows FROM events WHERE event_type IN ('signup', 'error') GROUP BY 1")
def refused_rows(spark, sf):
    landed = landing.read_landing(spark, _landed(spark, sf, _half_bad), _SOURCES)
    refused = raw_table.split_by_constraint(landed, raw_table.load_metrics(landed))[1]
    return refused.groupBy("source").agg(F.count("*").alias("n_rows"))


@query("write_landing", "SELECT event_type AS source, count(*) AS n_rows FROM events GROUP BY 1")
def write_landing(spark, sf):
    written = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(_landed(spark, sf))
    return written.groupBy("source").agg(F.count("*").alias("n_rows"))


@query(
    "landed_files",
    "SELECT event_type AS source, true AS has_bytes FROM events GROUP BY 1",
)
def landed_files(spark, sf):
    files = landing.landed_files(spark, _landed(spark, sf), _SOURCES)
    return files.groupBy("source").agg((F.sum("length") > 0).alias("has_bytes"))


@query("missing_sources", "SELECT name AS source FROM (VALUES ('view'), ('nobody')) t(name) WHERE name NOT IN (SELECT event_type FROM events)")
def missing_sources(spark, sf):
    expected = ("view", "nobody")
    files = landing.landed_files(spark, _landed(spark, sf), expected)
    return landing.missing_sources(spark, files, expected)


@query("stamp_scraped_at", "SELECT page_id, '2024-02-01 10:30:00 UTC' AS scraped_at FROM pages")
def stamp_scraped_at(spark, sf):
    return landing.stamp_scraped_at(table(spark, sf, "pages").select("page_id"), "2024-02-01 10:30:00")


# Run statistics.

_RUNS = (
    "SELECT event_type AS spider_name, cast(count(*) AS BIGINT) AS item_scraped_count, "
    "cast(count(*) FILTER (WHERE value > 10) AS BIGINT) AS response_received_count, cast(0 AS BIGINT) AS request_count, "
    "min(ts) AS start_time, max(ts) AS finish_time, round(date_diff('microsecond', min(ts), max(ts)) / 1e6, 6) AS duration "
    "FROM events GROUP BY 1"
)


def _run_stats(spark, sf):
    items = table(spark, sf, "events").withColumn("answered", F.col("value") > 10)
    return run_stats.run_stats(items, "event_type", "ts", responses="answered")


@query(
    "run_stats",
    f"SELECT * REPLACE ({sql.when_text('start_time')} AS start_time, {sql.when_text('finish_time')} AS finish_time) FROM ({_RUNS})",
)
def stats(spark, sf):
    return shown(_run_stats(spark, sf).withColumn("duration", F.round("duration", 6)))


@query(
    "counters_to_stats",
    "SELECT cast(user_id AS VARCHAR) AS spider_name, CASE WHEN value > 5 THEN cast(floor(value) AS BIGINT) ELSE 0 END AS item_scraped_count, "
    "cast(0 AS BIGINT) AS response_received_count, cast(event_id AS BIGINT) AS request_count, "
    f"CASE WHEN event_type <> 'error' THEN {sql.when_text('ts')} END AS start_time, {sql.when_text('ts + INTERVAL 90 SECOND')} AS finish_time, "
    "CASE WHEN event_type <> 'error' THEN cast(90 AS DOUBLE) END AS duration FROM events",
)
def counters(spark, sf):
    reported = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("spider_name"),
        F.when(F.col("value") > 5, F.floor("value")).alias("item_scraped_count"),
        F.lit(None).cast("int").alias("response_received_count"),
        F.col("event_id").alias("request_count"),
        F.when(F.col("event_type") != "error", F.col("ts").cast("string")).otherwise("None").alias("start_time"),
        (F.col("ts") + F.expr("interval 90 seconds")).cast("string").alias("finish_time"),
    )
    return shown(run_stats.counters_to_stats(reported))


@query(
    "write_stats_json",
    "SELECT spider_name AS source, spider_name AS spider, item_scraped_count AS items_scraped, response_received_count AS responses_received, "
    "request_count AS requests_made, duration AS duration_seconds, 'finished' AS completion_reason, '1.0' AS project_version "
    f"FROM ({_RUNS})",
)
def write_stats_json(spark, sf):
    from shelftrack.schemas import stats_document_schema

    root = _fresh(spark, "run-stats")
    run_stats.write_stats_json(run_stats.stats_document(_run_stats(spark, sf)), root)
    documents = spark.read.schema(stats_document_schema()).json(f"{root}/{fixed.STATS_FOLDER}")
    with_source = documents.withColumn("source", F.regexp_extract(F.input_file_name(), "source=([^/]+)", 1))
    return with_source.select(
        "source",
        "spider",
        "stats.items_scraped",
        "stats.responses_received",
        "stats.requests_made",
        F.round("stats.duration_seconds", 6).alias("duration_seconds"),
        "stats.completion_reason",
        "metadata.project_version",
    )


@query(
    "stats_json_text",
    "SELECT spider_name AS source, '{\"spider\":\"' || spider_name || '\",\"stats\":{\"items_scraped\":' || item_scraped_count || "
    "',\"responses_received\":' || response_received_count || ',\"requests_made\":0,\"completion_reason\":\"finished\"},' || "
    "'\"metadata\":{\"timestamp\":\"2024-02-01T00:00:00.000000\",\"project_version\":\"1.0\"}}' AS document "
    f"FROM ({_RUNS})",
)
def stats_json_text(spark, sf):
    """Without times: JSON leaves out what is NULL."""
    stats = _run_stats(spark, sf)
    for name in ("start_time", "finish_time", "duration"):
        stats = stats.withColumn(name, F.lit(None).cast(stats.schema[name].dataType))
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return run_stats.stats_json(run_stats.stats_document(stats, stamp=stamp))


@query(
    "append_stats_table",
    f"SELECT spider_name, item_scraped_count, {sql.when_text('start_time')} AS start_time, duration, "
    f"'2024-02-01 02:00:00.000000' AS run_timestamp FROM ({_RUNS}) UNION ALL "
    f"SELECT spider_name, item_scraped_count, {sql.when_text('start_time')}, duration, '2024-02-02 02:00:00.000000' FROM ({_RUNS})",
)
def append_stats_table(spark, sf):
    path = _fresh(spark, "monitoring")
    stats = _run_stats(spark, sf).withColumn("duration", F.round("duration", 6))
    for run in ("2024-02-01 02:00:00", "2024-02-02 02:00:00"):
        run_stats.append_stats_table(stats, path, F.lit(run).cast("timestamp"))
    stored = tables.scan(spark, path)
    return shown(stored.select("spider_name", "item_scraped_count", "start_time", "duration", "run_timestamp"))


@query("save_model_table", "SELECT l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1")
def save_model_table(spark, sf):
    sums = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity"))
    return tables.save_model(sums, "supplied", "table", _fresh(spark, "supplied"))


@query("save_model_view", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0")
def save_model_view(spark, sf):
    tables.save_model(table(spark, sf, "customer").filter("c_acctbal < 0"), "debtors")
    return tables.scan(spark, "debtors").select("c_custkey", "c_name")


def _columns_sql(name: str, columns, kind: str, rows: str) -> list[str]:
    return [f"SELECT '{name}' AS tab, '{c}' AS col, '{kind}' AS kind, ({rows}) AS n_rows" for c in columns]


_ALL_EVENTS, _ALL_TYPES = "SELECT count(*) FROM events", "SELECT count(DISTINCT event_type) FROM events"
_DECLARED = [
    *_columns_sql("record", fixed.RECORD_FIELDS, "string", _ALL_EVENTS),
    *_columns_sql("raw", ("id", *fixed.RECORD_FIELDS), "string", _ALL_EVENTS),
    *_columns_sql("raw", ("scraped_at",), "timestamp", _ALL_EVENTS),
    *_columns_sql("stats", ("id", "spider_name"), "string", _ALL_TYPES),
    *_columns_sql("stats", ("item_scraped_count", "response_received_count", "request_count"), "bigint", _ALL_TYPES),
    *_columns_sql("stats", ("start_time", "finish_time", "run_timestamp"), "timestamp", _ALL_TYPES),
    *_columns_sql("stats", ("duration",), "double", _ALL_TYPES),
]


@query("declared_schemas", " UNION ALL ".join(_DECLARED))
def declared_schemas(spark, sf):
    """The three declared schemas against tables as they are written: each declared column with its stored type and the table's rows."""
    scanned = landing.scan_landing(spark, _landed(spark, sf), _SOURCES)
    raw, monitoring = _fresh(spark, "raw"), _fresh(spark, "monitoring")
    raw_table.append_raw(spark, scanned, raw, "first")
    run_stats.append_stats_table(_run_stats(spark, sf), monitoring, F.lit("2024-02-01 02:00:00").cast("timestamp"))
    stored = {"record": landing.records(scanned), "raw": raw_table.read_batch(spark, raw, "first"), "stats": tables.scan(spark, monitoring)}
    declared = {"record": schemas.book_schema(), "raw": schemas.raw_schema(), "stats": schemas.stats_schema()}
    found = []
    for name, df in stored.items():
        columns = [F.struct(F.lit(f.name).alias("col"), F.lit(df.schema[f.name].dataType.simpleString()).alias("kind")) for f in declared[name]]
        rows = df.agg(F.count("*").alias("n_rows"))
        found.append(rows.select(F.lit(name).alias("tab"), F.explode(F.array(*columns)).alias("c"), "n_rows").select("tab", "c.*", "n_rows"))
    return landing.append_batches(found)


# Pages.

_RULES = PageRules(
    hosts=("example.com",),
    scope=".//article",
    fields={
        "title": Field("./h1"),
        "author": Field(".//div[@class='ad']", page=True),
        "book_link": Field(".//nav//li/a", take="@href", page=True, element=2),
        "category": Field(".//nav//li", take="string", nth=3, page=True),
        "old_price": Field(".//span[@class='price']", page=True),
        "description": Field(".//head/title", take="string", nth=0, page=True),
    },
    links=(("detail", ".//nav//li", Field("./a", take="@href")), ("next", ".", Field(".//a", take="@href", css_class="next"))),
)
_ROOT_URL = "regexp_extract(url, '^[a-z]+://[^/]+')"
_TEXT = "replace({}, '&amp;', '&')"


@query(
    "extract_books",
    f"SELECT page_id, {_TEXT.format('regexp_extract(html, $$<h1>([^<]*)</h1>$$, 1)')} AS title, "
    f"{_TEXT.format('regexp_extract(html, $$<div class=.ad.>([^<]*)</div>$$, 1)')} AS author, "
    f"{_ROOT_URL} || regexp_extract_all(html, '<li><a href=\"([^\"]*)\"', 1)[2] AS book_link, "
    "regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a>', 1)[3] AS category, NULL AS old_price, "
    "NULL AS discount_price, 'RSD' AS currency, string_split(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '.')[-2] AS publisher, "
    f"{_TEXT.format('regexp_extract(html, $$<title>([^<]*)</title>$$, 1)')} AS description FROM pages",
)
def extract_books(spark, sf):
    return pages.extract_books(table(spark, sf, "pages"), _RULES).drop("url")


@query(
    "extract_links",
    f"SELECT DISTINCT page_id, {_ROOT_URL} || unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS link FROM pages",
)
def extract_links(spark, sf):
    return pages.extract_links(table(spark, sf, "pages"))


@query(
    "follow_links",
    f"SELECT DISTINCT 'detail' AS kind, {_ROOT_URL} || unnest(regexp_extract_all(html, '<li><a href=\"([^\"]*)\"', 1)) AS link FROM pages",
)
def follow_links(spark, sf):
    return pages.follow_links(table(spark, sf, "pages"), _RULES)


@query(
    "allowed_domain",
    "SELECT page_id FROM pages WHERE regexp_matches(url, '^[a-z]+://([^/?#:]*[.])?(example[.]com|m[.]therou[.]example[.]net)([/?#:]|$)')",
)
def allowed_domain(spark, sf):
    return pages.allowed_domain(table(spark, sf, "pages"), ["example.com", "m.therou.example.net"]).select("page_id")


@query(
    "enrich_from_detail",
    "WITH detail AS (SELECT url, min(lang) AS lang FROM (SELECT url, regexp_extract(html, 'lang=\"([a-z]+)\"', 1) AS lang FROM pages) "
    "WHERE lang <> 'en' GROUP BY url) SELECT page_id, url AS book_link, lang AS category, 'in ' || lang AS description FROM pages JOIN detail USING (url)",
)
def enrich_from_detail(spark, sf):
    all_pages = table(spark, sf, "pages")
    listed = all_pages.select("page_id", F.col("url").alias("book_link"))
    lang = F.regexp_extract("html", 'lang="([a-z]+)"', 1)
    detail = all_pages.select(F.col("url").alias("book_link"), lang.alias("category")).filter("category <> 'en'")
    return pages.enrich_from_detail(listed, detail.withColumn("description", F.concat(F.lit("in "), "category")))


# The stream.


@query("streaming_upsert", sql.with_star(f"SELECT {_FCT_SHOWN} FROM fct"))
def stream(spark, sf):
    """Landed files as a stream into staging and facts: equal to one full refresh."""
    root = _fresh(spark, "stream")
    precise = raw_books(spark, sf).withColumn("source", F.regexp_extract("publisher", r"ku\S*?-([a-z]+) ", 1))
    records = precise.withColumn("scraped_at", F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    landing.write_landing(records, root)
    warehouse = Warehouse(spark, f"{root}/warehouse")
    days = tables.save_model(calendar(spark, sf), "stream_calendar", "table", f"{root}/dim_date")
    scanned = landing_stream(spark, f"{root}/{fixed.LANDING_FOLDER}", _SOURCES, settle=0)
    streaming_upsert(scanned, warehouse, days, f"{root}/checkpoint").awaitTermination()
    return shown(warehouse.table("fct_book_prices").drop("price_day", "max_scraped_at_utc", "source"))


_EVENT = "event_id, user_id, event_type, value, ts, day"
_PIECE_ROWS = 250_000


def _streamed(spark, sf, pieces, late):
    """Events written piece by piece, read as a stream of one piece a micro-batch into a table of the newest a user and day."""
    root = _fresh(spark, "events-stream")
    rows = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("day", F.to_date("ts"))
    rows = rows.select(*_EVENT.split(", "))
    # Every piece gets as many files, few enough that the smallest fills them.
    least = min(rows.select(*[F.count(F.when(piece, 1)) for piece in pieces]).first())
    files = max(1, least // _PIECE_ROWS)
    for piece in pieces:
        rows.filter(piece).repartition(files).write.mode("append").parquet(f"{root}/landed")
    given = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/landed")
    state_upsert(given, f"{root}/daily", ["user_id", "day"], "ts", "day", f"{root}/checkpoint", late, "event_id").awaitTermination()
    return shown(tables.read_table(spark, f"{root}/daily")).select(*_EVENT.split(", "))


_NEWEST = (
    f"SELECT event_id, user_id, event_type, value, {sql.when_text('ts')} AS ts, cast(cast(ts AS DATE) AS VARCHAR) AS day FROM {{rows}} "
    "QUALIFY row_number() OVER (PARTITION BY user_id, cast(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1"
)


@query("stream_state_upsert", _NEWEST.format(rows="events"))
def stream_state_upsert(spark, sf):
    """Four micro-batches, each with rows of all days and many that came before: equal to one full load."""
    pieces = [F.col("event_id") % 4 >= 2, F.col("event_id") % 4 <= 1, F.col("event_id") % 3 == 0, F.col("user_id") % 2 == 0]
    return _streamed(spark, sf, pieces, "60 days")


_EARLY = "(ts < TIMESTAMP '2024-01-20' AND event_type <> 'view')"


@query(
    "stream_late_rows",
    f"WITH early AS (SELECT * FROM events WHERE {_EARLY}), mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 5 DAY AS bound FROM early), "
    f"kept AS (SELECT * FROM early UNION ALL SELECT * FROM events WHERE NOT {_EARLY} AND ts > (SELECT bound FROM mark)) " + _NEWEST.format(rows="kept"),
)
def stream_late_rows(spark, sf):
    """One type's rows come in the end; those more than five days behind the newest of two micro-batches before are ignored."""
    early = (F.col("ts") < F.lit("2024-01-20").cast("timestamp")) & (F.col("event_type") != "view")
    return _streamed(spark, sf, [early, early & (F.col("event_id") % 9 == 0), ~early], "5 days")

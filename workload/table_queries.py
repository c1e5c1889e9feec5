"""Filters, joins, aggregates, windows and sorts over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelftrack import functions as fn
from shelftrack.operators import (
    attach_group_max, duplicate_keys, first_per_key, group_stats, high_watermark, latest_per_key,
    latest_per_key_per_day, left_join_dim, missing_in, per_source_cap, present_in, price_statistics,
    skew_join, top_k, upper_outliers,
)
from shelftrack.plans.staging import keep_priced
from shelftrack.sources.landing import append_batches
from workload import oracle_parts as sql
from workload.book_tables import raw_books, rounded_mean, shown, table
from workload.registry import query

# Money as whole cents in the reference, as exact decimals in Spark: means round alike.
_PRICE_CENTS = "cast(round(l_extendedprice * 100) AS BIGINT)"


def _money(name: str):
    return F.col(name).cast("decimal(18,2)")


# Filters.


@query(
    "keep_priced",
    sql.with_raw(
        f"SELECT id FROM told WHERE {sql.price('old_price')} IS NOT NULL OR {sql.price('discount_price')} IS NOT NULL"
    ),
)
def priced(spark, sf):
    parsed = raw_books(spark, sf).select(
        "id", fn.parse_price("old_price").alias("old_price"), fn.parse_price("discount_price").alias("discount_price")
    )
    return keep_priced(parsed).select("id")


@query("not_blank", sql.with_raw("SELECT id, author FROM raw WHERE author IS NOT NULL AND trim(author) <> ''"))
def not_blank(spark, sf):
    return raw_books(spark, sf).filter(fn.not_blank(F.trim("author"))).select("id", "author")


@query("newer_than_watermark", "SELECT o_orderkey FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1999-01-01')")
def newer_than_watermark(spark, sf):
    from shelftrack.operators.upsert import newer_than

    orders = table(spark, sf, "orders")
    loaded = orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    return newer_than(orders, loaded, "o_orderdate").select("o_orderkey")


@query("weekend_orders", "SELECT o_orderkey FROM orders WHERE isodow(o_orderdate) IN (6, 7)")
def weekend_orders(spark, sf):
    return table(spark, sf, "orders").filter((F.weekday("o_orderdate") + 1).isin(6, 7)).select("o_orderkey")


@query("contains_lower", "SELECT doc_id FROM documents WHERE lower(text) LIKE '%licen%' OR lower(text) LIKE '%für%'")
def contains_lower(spark, sf):
    text = F.lower("text")
    return table(spark, sf, "documents").filter(text.contains("licen") | text.contains("für")).select("doc_id")


@query(
    "regex_filter",
    "SELECT doc_id FROM documents WHERE regexp_matches(text, '(1[89][0-9]{2}|20[0-2][0-9]|202[0-5])') "
    "AND NOT regexp_matches(text, '^https?://', 'i')",
)
def regex_filter(spark, sf):
    text = F.col("text")
    kept = text.rlike(r"(1[89]\d{2}|20[0-2]\d|202[0-5])") & ~text.rlike("(?iu)^https?://")
    return table(spark, sf, "documents").filter(kept).select("doc_id")


@query(
    "range_filter",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity <= 0 OR (l_discount > 0.05 AND l_tax >= l_discount) "
    "OR l_shipdate > TIMESTAMP '2001-01-01'",
)
def range_filter(spark, sf):
    late = F.col("l_shipdate") > F.lit("2001-01-01").cast("timestamp_ntz")
    kept = (F.col("l_quantity") <= 0) | ((F.col("l_discount") > 0.05) & (F.col("l_tax") >= F.col("l_discount"))) | late
    return table(spark, sf, "lineitem").filter(kept).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "null_selection",
    sql.with_raw("SELECT id, author IS NULL AS no_author FROM raw WHERE category IS NOT NULL AND (author IS NULL OR description IS NULL)"),
)
def null_selection(spark, sf):
    kept = F.col("category").isNotNull() & (F.col("author").isNull() | F.col("description").isNull())
    return raw_books(spark, sf).filter(kept).select("id", F.col("author").isNull().alias("no_author"))


# Joins.


@query(
    "left_join_dim",
    "SELECT l_orderkey, l_linenumber, l_partkey, s.s_name FROM lineitem LEFT JOIN "
    "(SELECT * FROM supplier WHERE s_acctbal > 0) s ON l_suppkey = s.s_suppkey",
)
def left_join(spark, sf):
    dim = table(spark, sf, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    joined = left_join_dim(table(spark, sf, "lineitem"), dim, "l_suppkey")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "s_name")


@query(
    "inner_join_dims",
    "SELECT n.n_name, p.p_brand, count(*) AS n_rows FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
    "JOIN nation n ON s_nationkey = n_nationkey JOIN part p ON l_partkey = p_partkey GROUP BY 1, 2",
)
def inner_join_dims(spark, sf):
    """Rows are counted per key pair before the names are joined."""
    counted = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    joined = counted.join(supplier, "l_suppkey").join(nation, "s_nationkey").join(part, "l_partkey")
    return joined.groupBy("n_name", "p_brand").agg(F.sum("n").alias("n_rows"))


_LAST_OF_DAY = (
    "SELECT user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn "
    "FROM events WHERE cast(ts AS DATE) = DATE '{day}') WHERE rn = 1"
)


@query(
    "snapshot_self_join",
    f"SELECT n.user_id, round(n.value - o.value, 6) AS change FROM ({_LAST_OF_DAY.format(day='2024-01-30')}) n "
    f"JOIN ({_LAST_OF_DAY.format(day='2024-01-16')}) o USING (user_id)",
)
def snapshot_self_join(spark, sf):
    def on_day(day, name):
        events = table(spark, sf, "events").filter(F.to_date("ts") == F.lit(day).cast("date"))
        last = latest_per_key(events, ["user_id"], "ts", ["event_id"])
        return last.select("user_id", F.col("value").alias(name))

    both = on_day("2024-01-30", "now").join(on_day("2024-01-16", "before"), "user_id")
    return both.select("user_id", F.round(F.col("now") - F.col("before"), 6).alias("change"))


@query(
    "explode_and_count",
    "SELECT word, count(DISTINCT p_partkey) AS parts FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word "
    "FROM part) GROUP BY word",
)
def explode_and_count(spark, sf):
    words = table(spark, sf, "part").select("p_partkey", F.explode(fn.split_list("p_name", " ")).alias("word"))
    return words.groupBy("word").agg(F.count_distinct("p_partkey").alias("parts"))


@query(
    "missing_in",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def orphans(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey")
    return missing_in(customers, "c_custkey", table(spark, sf, "orders").filter("o_orderstatus = 'P'"), "o_custkey")


@query(
    "missing_by_computed_key",
    "SELECT page_id FROM pages WHERE md5(trim(split_part(url, '?', 1))) NOT IN "
    "(SELECT md5(trim(url)) FROM pages)",
)
def missing_by_computed_key(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    bare = pages.select("page_id", fn.book_key(F.split_part("url", F.lit("?"), F.lit(1))).alias("key"))
    return missing_in(bare, "key", pages, fn.book_key("url")).select("page_id")


@query(
    "present_in",
    "SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)",
)
def present(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey")
    return present_in(parts, "p_partkey", table(spark, sf, "lineitem").filter("l_quantity >= 49"), "l_partkey")


@query(
    "skew_join",
    "SELECT e.event_id, e.event_type, w.top FROM events e JOIN (SELECT event_type, max(value) AS top FROM events "
    "WHERE event_type <> 'view' GROUP BY 1) w USING (event_type)",
)
def skewed(spark, sf):
    """Five event types hold all rows: every key is hot and cut into slices."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    best = events.filter("event_type <> 'view'").groupBy("event_type").agg(F.max("value").alias("top"))
    return skew_join(events.drop("value"), best, ["event_type"], rows_per_slice=500)


@query(
    "first_match_or_null",
    "SELECT doc_id, nullif(regexp_extract(text, '(1[89][0-9]{2}|20[0-2][0-9])', 1), '') AS year_text FROM documents",
)
def first_match_or_null(spark, sf):
    found = fn.first_match("text", r"(1[89]\d{2}|20[0-2]\d)")
    return table(spark, sf, "documents").select("doc_id", found.alias("year_text"))


@query(
    "scalar_subquery_filter",
    "SELECT event_id FROM events WHERE cast(ts AS DATE) = (SELECT max(cast(ts AS DATE)) FROM events)",
)
def scalar_subquery_filter(spark, sf):
    events = table(spark, sf, "events")
    last = events.agg(F.max(F.to_date("ts"))).scalar()
    return events.filter(F.to_date("ts") == last).select("event_id")


# Aggregates.


@query("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus, cast(cast(l_shipdate AS DATE) AS VARCHAR) AS day FROM lineitem")
def distinct_values(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("day"))
    return shown(rows.distinct())


@query("count_distinct", "SELECT event_type, count(DISTINCT user_id) AS books FROM events GROUP BY 1")
def count_distinct(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("books"))


@query(
    "group_stats",
    f"SELECT l_suppkey, count(DISTINCT l_partkey) AS distinct_count, {sql.mean_of_cents(_PRICE_CENTS)} AS average_value, "
    "min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value FROM lineitem GROUP BY 1",
)
def stats(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", _money("l_extendedprice").alias("price"))
    found = group_stats(rows, ["l_suppkey"], "l_partkey", "price")
    return shown(found.withColumn("average_value", rounded_mean("average_value")))


@query(
    "first_per_key",
    "SELECT o_custkey, cast(cast(min(o_orderdate) AS DATE) AS VARCHAR) AS first_seen FROM orders GROUP BY 1",
)
def first_seen(spark, sf):
    return shown(first_per_key(table(spark, sf, "orders"), "o_custkey", F.to_date("o_orderdate"), "first_seen"))


@query("high_watermark", f"SELECT {sql.when_text('max(ts)')} AS watermark FROM events")
def watermark(spark, sf):
    return shown(high_watermark(table(spark, sf, "events"), "ts"))


@query(
    "high_watermark_per_source",
    f"SELECT event_type, {sql.when_text('max(ts)')} AS watermark FROM events GROUP BY 1",
)
def watermarks(spark, sf):
    return shown(high_watermark(table(spark, sf, "events"), "ts", by="event_type"))


@query(
    "price_statistics",
    "SELECT round(avg(l_extendedprice), 4) AS avg_l_extendedprice, round(avg(l_tax), 6) AS avg_l_tax, "
    "round(stddev_samp(l_extendedprice), 4) AS stddev_l_extendedprice, round(stddev_samp(l_tax), 6) AS stddev_l_tax "
    "FROM lineitem",
)
def statistics(spark, sf):
    found = price_statistics(table(spark, sf, "lineitem"), ["l_extendedprice", "l_tax"])
    return found.select(*[F.round(c, 6 if c.endswith("tax") else 4).alias(c) for c in found.columns])


@query(
    "upper_outliers",
    "SELECT event_id, value FROM events WHERE value > (SELECT avg(value) + 5 * stddev_samp(value) FROM events)",
)
def outliers(spark, sf):
    return upper_outliers(table(spark, sf, "events"), ["value"]).select("event_id", "value")


@query("duplicate_keys", "SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicates(spark, sf):
    return duplicate_keys(table(spark, sf, "orders"), ["o_custkey"])


# Windows.


@query(
    "latest_per_key",
    f"SELECT event_id, user_id, {sql.when_text('ts')} AS ts FROM (SELECT *, row_number() OVER "
    "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
)
def latest(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return shown(latest_per_key(events, ["user_id"], "ts", ["event_id"]))


@query(
    "latest_per_key_per_day",
    "SELECT l_partkey, cast(cast(l_shipdate AS DATE) AS VARCHAR) AS day, l_orderkey, l_linenumber FROM (SELECT *, "
    "row_number() OVER (PARTITION BY l_partkey, l_shipdate ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) "
    "AS rn FROM lineitem) WHERE rn = 1",
)
def latest_daily(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_shipdate", F.to_date("l_shipdate").alias("day")
    )
    last = latest_per_key_per_day(rows, ["l_partkey"], "l_shipdate", F.col("day"), ["l_orderkey", "l_linenumber"])
    return shown(last.drop("l_shipdate"))


@query(
    "attach_group_max",
    f"SELECT event_id, user_id, {sql.when_text('max(ts) OVER (PARTITION BY user_id, cast(ts AS DATE))')} AS last_of_day "
    "FROM events",
)
def group_max(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", F.to_date("ts").alias("day"))
    found = attach_group_max(events, ["user_id", "day"], "ts", "last_of_day")
    return shown(found.select("event_id", "user_id", "last_of_day"))


@query(
    "per_source_cap",
    "SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) "
    "WHERE rn <= 2",
)
def cap(spark, sf):
    return per_source_cap(table(spark, sf, "documents").select("doc_id", "source"), 2, ["doc_id"])


@query(
    "per_source_cap_large",
    "SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn "
    "FROM events) WHERE rn <= 1500",
)
def large_cap(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return per_source_cap(events, 1500, ["ts", "event_id"], "event_type").drop("ts")


# Sorts and top-k.


@query("sort_by_aggregate", f"SELECT l_suppkey, {sql.mean_of_cents(_PRICE_CENTS)} AS average FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1")
def sort_by_aggregate(spark, sf):
    means = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg(_money("l_extendedprice")).alias("average"))
    means = means.withColumn("average", rounded_mean("average"))
    return means.orderBy(F.col("average").desc_nulls_first(), "l_suppkey")


@query("sort_by_several_keys", "SELECT p_partkey, p_brand, p_name FROM part ORDER BY p_brand DESC NULLS FIRST, p_name, p_partkey")
def sort_by_several_keys(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    return parts.orderBy(F.col("p_brand").desc_nulls_first(), F.col("p_name").asc_nulls_last(), "p_partkey")


@query(
    "top_k",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC NULLS FIRST, "
    "l_orderkey, l_linenumber, l_partkey LIMIT 100",
)
def top(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return top_k(rows, "l_extendedprice", 100, ["l_orderkey", "l_linenumber", "l_partkey"])


# Set operations.


@query(
    "append_batches",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier "
    "UNION ALL SELECT p_partkey, p_name FROM part",
)
def append(spark, sf):
    return append_batches(
        [
            table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
            table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")),
            table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
        ]
    )


@query(
    "source_difference",
    "SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE n_chars > 8000)",
)
def source_difference(spark, sf):
    documents = table(spark, sf, "documents")
    return missing_in(documents.select("source").distinct(), "source", documents.filter("n_chars > 8000"), "source")


@query(
    "first_seen_recently",
    "SELECT o_custkey, cast(first AS VARCHAR) AS first_seen FROM (SELECT o_custkey, cast(min(o_orderdate) AS DATE) AS first "
    "FROM orders GROUP BY 1) WHERE first >= DATE '1995-02-22'",
)
def first_seen_recently(spark, sf):
    first = first_per_key(table(spark, sf, "orders"), "o_custkey", F.to_date("o_orderdate"), "first_seen")
    cutoff = F.date_sub(F.lit("1995-03-01").cast("date"), 7)
    return shown(first.filter(F.col("first_seen") >= cutoff))


@query(
    "daily_price_per_publisher",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS distinct_count, round(avg(price), 4) AS average_value, "
    "round(min(price), 4) AS min_value, round(max(price), 4) AS max_value FROM (SELECT *, l_extendedprice * (1 - l_discount) AS price, "
    "row_number() OVER (PARTITION BY l_partkey, l_shipdate ORDER BY l_orderkey DESC, l_linenumber DESC) AS rn FROM lineitem) "
    "WHERE rn = 1 GROUP BY 1",
)
def daily_price_per_publisher(spark, sf):
    """Last price of every part and day, then statistics per supplier."""
    rows = table(spark, sf, "lineitem").select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price"),
        F.to_date("l_shipdate").alias("day"),
    )
    last = latest_per_key_per_day(rows, ["l_partkey"], "l_shipdate", F.col("day"), ["l_orderkey", "l_linenumber"])
    found = group_stats(last, ["l_suppkey"], "l_partkey", "price")
    return found.select("l_suppkey", "distinct_count", *[F.round(c, 4).alias(c) for c in ("average_value", "min_value", "max_value")])

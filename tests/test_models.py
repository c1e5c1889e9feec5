"""Models, analyses, checks and the stored warehouse."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.plans import analytics, checks, marts, suite
from shelftrack.plans.staging import build_stg_books
from shelftrack.plans.warehouse import Warehouse, build_models
from shelftrack.schemas import raw_schema, stg_books_schema
from shelftrack.sources import landing
from shelftrack.sources.tables import loads, read_table, stored_rows
from shelftrack.streaming import landing_stream, load_stream, state_upsert, streaming_upsert

AS_OF = "2024-01-05"


def raw_row(n, link, when, price="100,00", author="Ana, Vuk", publisher="kuća", description=None, old=None):
    return (str(n), f"T{link}", author, f"http://a.rs/{link}", None, old, price, "RSD", publisher, description, when)


SCANS = [
    raw_row(1, "x", datetime(2024, 1, 1, 8)),
    raw_row(2, "x", datetime(2024, 1, 1, 22, 30), "90,00"),
    raw_row(3, "x", datetime(2024, 1, 1, 23, 30), "80,00"),
    raw_row(4, "y", datetime(2024, 1, 2, 8), "50,00", None),
    raw_row(5, "y", datetime(2024, 1, 4, 8), "70,00", "Vuk", "druga", "ISBN 978-86-0000-123-4 strana"),
    raw_row(6, "x", datetime(2024, 1, 4, 9), "130,00"),
    raw_row(7, "z", datetime(2024, 1, 4, 9), "None"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(SCANS, raw_schema())


@pytest.fixture
def models(spark, raw):
    return build_models(raw, marts.build_dim_date(spark, AS_OF))


def test_stg_schema(raw):
    stg = build_stg_books(raw)
    wanted = [(f.name, f.dataType) for f in stg_books_schema()]
    assert [(f.name, f.dataType) for f in stg.schema] == wanted
    assert stg.count() == 6


def test_star(models, rows):
    assert rows(models["dim_publishers"], "publisher_name") == [("Druga",), ("Kuća",)]
    assert rows(models["dim_authors"], "author_name") == [("Ana",), ("Nepoznat Autor",), ("Vuk",)]
    # Two scans of a book by two authors leave two pairs.
    pairs = models["brg_book_author"].groupBy("book_id").count()
    assert rows(pairs, "count") == [(2,), (2,)]
    fact = models["fct_book_prices"]
    assert rows(fact, "date_id", "discount_price") == [
        (20240101, Decimal("90.0000")), (20240102, Decimal("50.0000")), (20240102, Decimal("80.0000")),
        (20240104, Decimal("130.0000")), (20240104, Decimal("70.0000")),
    ]
    latest = models["dim_books"].filter("title = 'Ty'").first()
    assert latest["isbn"] == "9788600001234" and latest["last_scraped_at"] == datetime(2024, 1, 4, 9)


def test_dimensions_decide_which_keys_exist(spark, models, rows):
    known = models["dim_publishers"].filter("publisher_name = 'Kuća'")
    fact = marts.build_fct_prices(models["stg_books"], models["dim_date"].filter("date_id < 20240103"), known)
    assert rows(fact.groupBy(F.col("date_id").isNull().alias("d"), F.col("publisher_id").isNull().alias("p")).count()) == [
        (False, False, 3), (True, False, 1), (True, True, 1)
    ]
    authors = models["dim_authors"].filter("author_name = 'Vuk'")
    assert marts.build_bridge(models["int_books"], authors).count() == 2


def test_book_without_author_keeps_a_row(spark, models, rows):
    stg = models["stg_books"].withColumn("author", F.lit(None).cast("string"))
    assert marts.build_int_books(stg).count() == stg.count()


def test_calendar(spark):
    days = marts.build_dim_date(spark, "2024-03-31")
    ends = days.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert tuple(ends) == (date(2024, 2, 1), date(2026, 3, 31), 790)


def test_analyses(models, rows):
    m = models
    stats = analytics.avg_price_per_publisher(m["fct_book_prices"], m["dim_publishers"]).collect()
    assert [(r["publisher_name"], r["distinct_books_count"], float(r["average_discount_price"])) for r in stats] == [
        ("Kuća", 2, 87.5), ("Druga", 1, 70.0)
    ]
    args = (m["fct_book_prices"], m["dim_date"], m["dim_books"], m["dim_publishers"])
    new = analytics.newly_added_books(*args, as_of="2024-01-09")
    assert rows(new, "title", "first_seen_date") == [("Ty", date(2024, 1, 2))]
    assert analytics.price_change(*args, as_of=AS_OF, days=2).count() == 0
    changes = analytics.price_change(*args, as_of=AS_OF, days=2, latest_from="fact", with_percentage=True)
    assert rows(changes, "title", "absolute_change") == [("Tx", Decimal("50.0000")), ("Ty", Decimal("20.0000"))]
    assert float(changes.first()["percentage_change"]) == 62.5
    assert "book_id" not in changes.columns
    assert analytics.price_change(*args, as_of=AS_OF, days=2, latest_from="fact", k=1).count() == 1


def test_suite_on_good_data(models):
    every = suite.warehouse_checks(AS_OF)
    assert len(every) == 76
    got = {r["check"]: r["n_violations"] for r in checks.run_checks(models, every).collect()}
    assert len(got) == 76
    failing = {name for name, n in got.items() if n}
    # The unpriced book is not staged.
    assert failing == {"unstaged_rows"}
    assert len(suite.source_checks()) == 8


BAD = {
    "not_null": (lambda s: checks.check_not_null(s.createDataFrame([(1,), (None,)], "a int"), "a"), 1),
    "unique": (lambda s: checks.check_unique(s.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "a int"), "a"), 1),
    "unique_where": (
        lambda s: checks.check_unique(s.createDataFrame([(1, 0), (1, 1)], "a int, b int"), "a", F.col("b") == 1), 0
    ),
    "unique_combination": (
        lambda s: checks.check_unique_combination(s.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int"), ["a", "b"]), 1
    ),
    "accepted": (lambda s: checks.check_accepted(s.createDataFrame([("x",), ("y",), ("y",), (None,)], "a string"), "a", ["x"]), 1),
    "accepted_null": (lambda s: checks.check_accepted(s.createDataFrame([(None,)], "a string"), "a", ["x"]), 0),
    "relationship": (
        lambda s: checks.check_relationship(
            s.createDataFrame([(1,), (3,), (3,), (None,)], "a int"), "a", s.createDataFrame([(1,), (2,)], "b int"), "b"
        ), 1,
    ),
    "future_year": (
        lambda s: s.createDataFrame([(2024,), (2025,), (None,)], "year_of_publication int").filter(checks.future_year("2024-06-01")), 1
    ),
    "isbn": (
        lambda s: s.createDataFrame([("123456789X",), ("12",), (None,), ("978-86-0000-123-4",)], "isbn string").filter(checks.malformed_isbn()), 1
    ),
    "link": (lambda s: s.createDataFrame([("http://a",), ("a",), (None,)], "book_link string").filter(checks.malformed_link()), 1),
    "pages": (lambda s: s.createDataFrame([(0,), (-1,), (5,), (None,)], "page_numbers int").filter(checks.no_pages()), 2),
    "prices": (
        lambda s: s.createDataFrame([(1.0, 2.0), (-1.0, None), (2.0, 1.0), (None, 1.0)], "old_price double, discount_price double")
        .filter(checks.insane_price()), 2,
    ),
}


@pytest.mark.parametrize("name", list(BAD))
def test_checks_find_what_is_wrong(spark, name):
    find, expected = BAD[name]
    assert find(spark).count() == expected


def test_relationship_counts_rows_in_the_suite(spark):
    tables = {"c": spark.createDataFrame([(3,), (3,), (None,)], "a int"), "p": spark.createDataFrame([(1,)], "b int")}
    got = checks.run_checks(tables, [checks.relationship("c", "a", "p", "b"), checks.not_null("c", "a")])
    assert {r["check"]: r["n_violations"] for r in got.collect()} == {"relationships_c_a_p": 2, "not_null_c_a": 1}


def test_unstaged_rows(models, rows):
    assert rows(checks.unstaged_rows(models["raw"], models["stg_books"])) == [("7",)]
    assert checks.unstaged_rows(models["raw"], models["stg_books"], priced_only=True).count() == 0


@pytest.mark.parametrize("hours, status", [(23, "pass"), (24.5, "warn"), (26, "error")])
def test_freshness(spark, hours, status):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (None,)], "ts timestamp")
    as_of = F.timestamp_seconds(F.lit(1704067200 + hours * 3600))
    row = checks.check_freshness(df, "ts", as_of).first()
    assert (row["age_hours"], row["status"]) == (hours, status)
    assert checks.check_freshness(df.limit(0), "ts", as_of).first()["status"] == "error"


def _facts(rows, df):
    return rows(df, "book_id", "date_id", "discount_price", "max_scraped_at")


def test_daily_batches_equal_full_refresh(spark, raw, rows, tmp_path):
    calendar = marts.build_dim_date(spark, AS_OF)
    whole = Warehouse(spark, str(tmp_path / "whole"))
    whole.refresh(raw, calendar)
    steps = Warehouse(spark, str(tmp_path / "steps"))
    for n, cut in enumerate(("2024-01-01 22:45", "2024-01-03", "2024-01-04 08:30", "2024-01-05")):
        seen = raw.filter(F.col("scraped_at") <= F.lit(cut).cast("timestamp"))
        steps.update_staging(seen, f"b{n}")
        steps.update_facts(calendar, f"b{n}")
    steps.rebuild_dimensions(calendar)
    assert _facts(rows, steps.table("fct_book_prices")) == _facts(rows, whole.table("fct_book_prices"))
    for name, key in (("stg_books", "book_id"), ("dim_books", "book_id"), ("brg_book_author", "author_id")):
        assert rows(steps.table(name), key) == rows(whole.table(name), key)


def test_autumn_hour_is_not_lost(spark, rows, tmp_path):
    """Local time repeats an hour; key, order and watermark are the instant, in staging and in the fact."""
    calendar = marts.build_dim_date(spark, "2024-10-28")
    scans = [raw_row(1, "x", datetime(2024, 10, 27, 0, 10), "10,00"), raw_row(2, "x", datetime(2024, 10, 27, 1, 10), "77,00")]
    scans += [raw_row(3, "y", datetime(2024, 10, 27, 0, 50), "20,00"), raw_row(4, "z", datetime(2024, 10, 27, 1, 5), "30,00")]
    first, second = (spark.createDataFrame(part, raw_schema()) for part in (scans[::2], scans))
    steps, whole = Warehouse(spark, str(tmp_path / "steps")), Warehouse(spark, str(tmp_path / "whole"))
    for n, seen in enumerate((first, second)):
        steps.update_staging(seen, f"b{n}")
        steps.update_facts(calendar, f"b{n}")
    whole.refresh(second, calendar)
    assert steps.table("stg_books").count() == 4
    assert _facts(rows, steps.table("fct_book_prices")) == _facts(rows, whole.table("fct_book_prices"))
    assert rows(steps.table("fct_book_prices"), "discount_price") == [(Decimal(20),), (Decimal(30),), (Decimal(77),)]


def test_late_source_is_kept_with_its_own_watermark(spark, rows, tmp_path):
    """Names are compared as they came, not as staging cleans them."""
    calendar = marts.build_dim_date(spark, AS_OF)
    early = [raw_row(1, "x", datetime(2024, 1, 2), publisher="laguna"), raw_row(3, "x", datetime(2024, 1, 3), publisher="laguna")]
    late = [raw_row(2, "y", datetime(2024, 1, 1), publisher="kuća knjige")]
    frame = lambda r: spark.createDataFrame(r, raw_schema())
    steps, whole = Warehouse(spark, str(tmp_path / "steps")), Warehouse(spark, str(tmp_path / "whole"))
    for n, seen in enumerate((frame(early), frame(early + late))):
        steps.update_staging(seen, f"b{n}", by="publisher")
        steps.update_facts(calendar, f"b{n}", per_source=True)
    whole.refresh(frame(early + late), calendar)
    assert steps.table("stg_books").count() == 3
    assert _facts(rows, steps.table("fct_book_prices")) == _facts(rows, whole.table("fct_book_prices"))
    from shelftrack.operators import newer_than

    again = newer_than(frame(early).withColumn("source", F.col("publisher")), steps.table("stg_books"), "scraped_at", "scraped_at_utc", "source")
    assert again.count() == 0


def _land(spark, root, scans):
    df = spark.createDataFrame(scans, raw_schema()).withColumn("source", F.lit("laguna"))
    stamped = df.withColumn("scraped_at", F.concat(F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
    landing.write_landing(stamped.coalesce(1), root)


def _stream(spark, root, warehouse, **options):
    scanned = landing_stream(spark, f"{root}/{fixed.LANDING_FOLDER}", settle=0)
    calendar = marts.build_dim_date(spark, AS_OF)
    streaming_upsert(scanned, warehouse, calendar, f"{warehouse.root}/ledger", **options).awaitTermination()


def test_stream_equals_batch_in_any_order(spark, raw, rows, tmp_path):
    root = str(tmp_path)
    streamed = Warehouse(spark, f"{root}/streamed")
    for scans in (SCANS[4:], SCANS[1:3], SCANS[3:4], SCANS[:1]):
        _land(spark, root, scans)
        _stream(spark, root, streamed)
    whole = Warehouse(spark, f"{root}/whole")
    whole.refresh(raw, marts.build_dim_date(spark, AS_OF))
    assert streamed.table("raw").count() == len(SCANS)
    assert _facts(rows, streamed.table("fct_book_prices")) == _facts(rows, whole.table("fct_book_prices"))


def test_stream_may_ignore_late_rows(spark, rows, tmp_path):
    root = str(tmp_path)
    streamed = Warehouse(spark, f"{root}/streamed")
    for scans in (SCANS[3:6], SCANS[:3]):
        _land(spark, root, scans)
        _stream(spark, root, streamed, ignore_late=True)
    assert rows(streamed.table("fct_book_prices"), "date_id") == [(20240102,), (20240104,), (20240104,)]


def test_load_stream_reads_a_file_once(spark, tmp_path):
    root = str(tmp_path)
    _land(spark, root, SCANS[:2])
    for _ in range(2):
        scanned = landing_stream(spark, f"{root}/{fixed.LANDING_FOLDER}", settle=0)
        load_stream(scanned, f"{root}/raw", f"{root}/ledger").awaitTermination()
    assert spark.read.parquet(f"{root}/raw").count() == 2


def test_state_goes_on_where_it_was(spark, rows, tmp_path):
    """Repeated rows write nothing, also after a restart; ties, times out of order, rows without a time and late ones."""
    landed, table = str(tmp_path / "landed"), str(tmp_path / "table")
    schema = "k string, ts timestamp, v int, day date"

    def arrive(*items):
        given = [(k, ts, v, ts and ts.date()) for k, ts, v in items]
        spark.createDataFrame(given, schema).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        state_upsert(stream, table, ["k", "day"], "ts", "day", str(tmp_path / "checkpoint"), "3 days", "v").awaitTermination()
        return rows(read_table(spark, table), "k", "day", "v")

    at = lambda d, h=0: datetime(2024, 1, d, h)
    first = [("a", at(5, 1), 1), ("a", at(5, 3), 2), ("a", at(4), 3), ("b", at(5), 4), ("b", None, 9), (None, at(5), 5)]
    day = lambda d: date(2024, 1, d)
    base = [("a", day(4), 3), ("a", day(5), 2), ("b", day(5), 4), (None, day(5), 5)]
    assert arrive(*first) == sorted(base, key=repr)
    written = stored_rows(spark, table).count()
    assert arrive(*first) == sorted(base, key=repr) and stored_rows(spark, table).count() == written
    # Older than what is known, a tie with a larger number, one with a smaller, a new key behind the newest time.
    got = arrive(("a", at(5, 2), 8), ("b", at(5), 6), (None, at(5), 1), ("c", at(3), 7))
    now = [("a", day(4), 3), ("a", day(5), 2), ("b", day(5), 6), ("c", day(3), 7), (None, day(5), 5)]
    assert got == sorted(now, key=repr)
    # The newest time moves on; from the next micro-batch on rows three days behind it are late.
    now.append(("d", day(20), 1))
    assert arrive(("d", at(20), 1)) == sorted(now, key=repr)
    assert arrive(("a", at(5, 9), 99), ("e", at(10), 99), ("d", at(20, 5), 2)) == sorted([*now[:-1], ("d", day(20), 2)], key=repr)
    assert loads(spark, table).count() >= 4


def test_state_of_a_bucket_is_one_value():
    """Two thousand keys need one read, one write and one timer; half of them end together."""
    import numpy as np
    import pandas as pd
    from shelftrack.streaming.state_stream import Newest

    class Handle:
        value, timers, writes = None, set(), 0

        def getValueState(self, *_):
            return self

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value, self.writes = value, self.writes + 1

        def clear(self):
            self.value = None

        def registerTimer(self, at):
            self.timers = self.timers | {at}

        def deleteTimer(self, at):
            self.timers = self.timers - {at}

    class Mark:
        at = 0

        def getCurrentWatermarkInMs(self):
            return self.at

    handle, mark, newest, n = Handle(), Mark(), Newest(), 2000
    newest.init(handle)

    def give(keys, stamps, ties=0):
        part = pd.DataFrame({"v": keys, "newest_bucket": 0, "newest_key": [str(k) for k in keys], "newest_stamp": stamps, "newest_tie": ties})
        return [sorted(out["v"]) for out in newest.handleInputRows((0,), iter([part.astype({"newest_stamp": "int64", "newest_tie": "int64"})] * 2), mark)]

    keys = np.arange(n)
    assert give(keys, (keys + 1) * 1000) == [list(range(n))]
    assert handle.writes == 1 and handle.timers == {n // 2 + 1}
    assert give(keys, (keys + 1) * 1000) == [] and handle.writes == 1
    assert give([5, 7, n], [5999, 8000, 1], [9, 1, 0]) == [[7, n]]
    mark.at = max(handle.timers)
    handle.timers = set()
    list(newest.handleExpiredTimer((0,), mark, None))
    known, timer = newest._read()
    assert len(known) == n // 2 and handle.timers == {timer}
    mark.at, handle.timers = n + 1, set()
    list(newest.handleExpiredTimer((0,), mark, None))
    assert handle.value is None and handle.timers == set()


def test_batch_facts_come_from_stored_rows(spark, raw, tmp_path, monkeypatch):
    from shelftrack.plans import marts

    seen, build = [], marts.build_fct_prices
    monkeypatch.setattr(marts, "build_fct_prices", lambda stg, *a, **k: seen.append(stg.inputFiles()) or build(stg, *a, **k))
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.apply_batch(raw, marts.build_dim_date(spark, AS_OF), "first")
    assert seen[0] and all("stg_books" in file for file in seen[0])


def test_watermarks_of_sources_leave_rows_where_they_lie(spark):
    from shelftrack.operators.upsert import newer_than

    rows = spark.range(100).selectExpr("id", "id % 5 AS source", "timestamp_seconds(id) AS ts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = newer_than(rows, rows.filter("id < 50"), "ts", by="source")
        assert "BroadcastHashJoin" in fresh._jdf.queryExecution().executedPlan().toString() and fresh.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_rows_of_one_file_are_dealt_out(spark, tmp_path):
    from workload.book_tables import spread

    spark.range(5000).coalesce(1).write.parquet(str(tmp_path / "rows"))
    parts = spread(spark, spark.read.parquet(str(tmp_path / "rows"))).rdd.glom().map(len).collect()
    assert len(parts) == spark.sparkContext.defaultParallelism and max(parts) <= 2 * 5000 / len(parts)

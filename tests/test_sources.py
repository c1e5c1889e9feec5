"""Landing, raw table, run statistics and pages."""

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.schemas import book_schema, landed_schema, raw_schema, stats_schema, stg_books_schema
from shelftrack.sources import landing, landing_source, pages, raw_table, run_stats
from shelftrack.sources.page_rules import SOURCE_RULES

HEADER = ",".join(fixed.REQUIRED_COLUMNS)
GOOD = ' Prva ,"Ana, Vuk",http://a.rs/1,Roman,"1.299,00","999,00",RSD,laguna,"prvi red\ndrugi ""red""",2024-01-01 08:00:00 UTC'


@pytest.fixture
def landed(tmp_path):
    files = {
        "laguna/good.csv": f"{HEADER}\n{GOOD}\nDruga,None,http://a.rs/2,,NaN,500,,laguna,,2024-01-01 08:00:00 UTC\n",
        "laguna/other order.csv": "scraped_at,title,author,book_link,category,old_price,discount_price,currency,publisher,description,extra\n"
        "2024-01-02 08:00:00 UTC,Treća,,http://a.rs/3,,,700,RSD,laguna,opis,x\n",
        "mikrok/lacking.csv": "title,author\nx,y\n",
        "mikrok/no_title.csv": f"{HEADER}\n,a,http://b.rs/1,,,5,RSD,mikrok,,2024-01-01 08:00:00 UTC\n"
        "Dobra,a,http://b.rs/2,,,5,RSD,mikrok,,2024-01-01 08:00:00 UTC\n",
        "mikrok/bad_time.csv": f"{HEADER}\nDobra,a,http://b.rs/2,,,5,RSD,mikrok,,juče\n",
        "prometej/empty.csv": "",
        "other/ignored.csv": f"{HEADER}\n{GOOD}\n",
    }
    for name, text in files.items():
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_read_landing(spark, landed):
    got = {r["title"]: r for r in landing.read_landing(spark, landed).collect() if r["title"]}
    assert set(got) == {"Prva", "Druga", "Treća", "Dobra"}
    assert got["Prva"]["description"] == 'prvi red\ndrugi "red"'
    assert got["Prva"]["author"] == "Ana, Vuk" and got["Prva"]["source"] == "laguna"
    assert got["Druga"]["author"] is None and got["Druga"]["old_price"] is None
    assert got["Treća"]["discount_price"] == "700" and got["Treća"]["publisher"] == "laguna"


def test_skipped_files_and_missing_sources(spark, landed):
    scanned = landing.scan_landing(spark, landed)
    skipped = landing.skipped_files(scanned).collect()
    assert [r["file"].rsplit("/", 1)[-1] for r in skipped] == ["lacking.csv"]
    assert set(skipped[0]["missing"]) == set(fixed.REQUIRED_COLUMNS) - {"title", "author"}
    metrics = {r["file"].rsplit("/", 1)[-1]: r["rows"] for r in raw_table.load_metrics(scanned).collect()}
    assert metrics == {"good.csv": 2, "other order.csv": 1, "no_title.csv": 2, "bad_time.csv": 1, "empty.csv": 0}
    files = landing.landed_files(spark, landed, ("laguna", "mikrok"))
    assert [r[0] for r in landing.missing_sources(spark, files).collect()] == ["prometej"]


def test_one_scan_reads_each_file_once(spark, landed):
    plan = landing.read_landing(spark, landed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and "FileScan" not in plan
    lines = landing.read_landing(spark, landed).filter("source = 'laguna'").select("file", "line").collect()
    assert sorted((r["file"].rsplit("/", 1)[-1], r["line"]) for r in lines) == [("good.csv", 1), ("good.csv", 2), ("other order.csv", 1)]


def test_odd_files(spark, tmp_path, monkeypatch):
    folder = tmp_path / "source=laguna"
    (folder / "_temporary").mkdir(parents=True)
    (folder / "_temporary" / "part.csv").write_text(f"{HEADER}\n{GOOD}\n")
    quoted = ",".join(f'"{c}"' for c in fixed.REQUIRED_COLUMNS)
    (folder / "quoted.csv").write_bytes(b"\xef\xbb\xbf" + f"{quoted}\r\n\r\nx,y\r\n".encode() + b"bad \xff byte\r\n")
    (folder / "wide.csv").write_text(f"{HEADER}\n{GOOD},\n{GOOD}\n" + "".join(f"n{i}\n" for i in range(5000)))
    (folder / "long.csv").write_text(f'{HEADER}\n"{"z" * 300_000}\n"\n')
    (folder / "none.txt").write_text("x")
    got = landing.read_landing(spark, f"file://{tmp_path}").collect()
    by = lambda name: sorted((r for r in got if r["file"].endswith(name)), key=lambda r: r["line"])
    assert len(got) == 2 + 5002 + 1
    assert [(r["title"], r["author"]) for r in by("quoted.csv")] == [("x", "y"), ("bad \ufffd byte", None)]
    wide = by("wide.csv")
    assert [r["surplus"] for r in wide[:3]] == [True, False, False] and [r["line"] for r in wide] == list(range(1, 5003))
    assert wide[-1]["title"] == "n4999" and len(by("long.csv")[0]["title"]) == 300_000
    # However many shares a folder has, each file falls to one of them.
    monkeypatch.setattr(landing_source, "_SHARE_BYTES", 1)
    options = {"path": str(tmp_path), "sources": "laguna", "required": ",".join(fixed.REQUIRED_COLUMNS)}
    reader = landing_source.LandingReader(options)
    assert len(reader.partitions()) == 3
    assert sum(batch.num_rows for share in reader.partitions() for batch in reader.read(share)) == len(got) + 3


def test_stream_offsets(tmp_path):
    options = {"path": str(tmp_path), "sources": "a,b", "required": "title", "settle": "0"}
    reader = landing_source.LandingStreamReader(options)
    assert reader.latestOffset() == reader.initialOffset()
    seen = []
    start = reader.initialOffset()
    for n, name in enumerate(("a/1.csv", "b/1.csv", "a/2.csv")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(f"title\n{name}\n")
        os.utime(tmp_path / name, ns=(10**9 * (n + 1), 10**9 * (n + 1)))
        if n == 1:
            continue
        end = reader.latestOffset()
        for _ in range(2):  # a repeated micro-batch holds the same files
            again = [r["title"] for s in reader.partitions(start, end) for b in reader.read(s) for r in b.to_pylist() if r["line"]]
        seen.append(sorted(again))
        start = end
    assert seen == [["a/1.csv"], ["a/2.csv", "b/1.csv"]]
    (tmp_path / "a/new.csv").write_text("title\nx\n")
    assert landing_source.LandingStreamReader(options | {"settle": "3600"}).latestOffset() == start


def test_nothing_landed(spark, tmp_path):
    assert landing.read_landing(spark, str(tmp_path)).count() == 0
    assert landing.landed_files(spark, str(tmp_path)).count() == 0


def test_whole_files_are_refused(spark, landed, tmp_path, rows):
    rows_in = landing.scan_landing(spark, landed)
    metrics = raw_table.append_raw(spark, rows_in, str(tmp_path / "raw"), "b1", str(tmp_path / "refused"))
    assert rows(spark.read.parquet(str(tmp_path / "raw")), "title") == [("Druga",), ("Prva",), ("Treća",)]
    assert rows(spark.read.parquet(str(tmp_path / "refused")), "reason") == [
        ("scraped_at is no time",), ("title is null",), ("title is null",)
    ]
    total = raw_table.loaded_total(metrics).first()
    assert (total["files_loaded"], total["rows_loaded"], total["files_refused"]) == (3, 3, 2)
    stored = spark.read.parquet(str(tmp_path / "raw"))
    assert stored.filter("title = 'Druga'").first()["currency"] == "RSD"
    assert stored.filter("title = 'Prva'").first()["scraped_at"] == datetime(2024, 1, 1, 8)
    assert stored.select("id").distinct().count() == 3
    # Loading the batch again leaves three rows with the same ids.
    ids = rows(stored, "id")
    raw_table.append_raw(spark, rows_in.repartition(5), str(tmp_path / "raw"), "b1")
    assert rows(spark.read.parquet(str(tmp_path / "raw")), "id") == ids


def test_a_repeated_batch_replaces_all_it_stored(spark, tmp_path, rows):
    folder = tmp_path / "laguna"
    folder.mkdir()
    raw, refused = str(tmp_path / "raw"), str(tmp_path / "refused")
    (folder / "1.csv").write_text(f"{HEADER}\nA,a,http://a.rs/1,,,5,RSD,laguna,,2024-01-01 08:00:00 UTC\n")
    (folder / "2.csv").write_text(f"{HEADER}\nB,a,http://a.rs/2,,,5,RSD,laguna,,2024-01-02 08:00:00 UTC\n")
    load = lambda batch: raw_table.append_raw(spark, landing.scan_landing(spark, str(tmp_path)), raw, batch, refused)
    load("b0")
    load("b1")
    (folder / "2.csv").write_text(f"{HEADER}\n,a,http://a.rs/2,,,5,RSD,laguna,,2024-01-02 08:00:00 UTC\n")
    load("b1")
    assert rows(raw_table.read_batch(spark, raw, "b1"), "title", "scrape_day") == [("A", date(2024, 1, 1))]
    assert rows(spark.read.parquet(raw), "batch", "title") == [("b0", "A"), ("b0", "B"), ("b1", "A")]
    assert rows(spark.read.parquet(refused), "reason", "batch") == [("title is null", "b1")]
    (folder / "2.csv").unlink()
    (folder / "1.csv").write_text(f"{HEADER}\nA,a,,,,5,RSD,laguna,,2024-01-01 08:00:00 UTC\n")
    load("b1")
    assert raw_table.read_batch(spark, raw, "b1") is None
    assert rows(spark.read.parquet(refused), "reason") == [("book_link is null",)]
    (folder / "1.csv").unlink()
    assert load("b1").count() == 0 and spark.read.parquet(refused).count() == 0


def test_a_batch_is_parsed_once(spark, tmp_path):
    count = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    folder = tmp_path / "laguna"
    folder.mkdir()
    (folder / "1.csv").write_text(f"{HEADER}\n{GOOD}\n,,,,,,,,,\n")
    scanned = landing.scan_landing(spark, str(tmp_path))
    raw_table.append_raw(spark, scanned.mapInArrow(seen, scanned.schema), str(tmp_path / "raw"), "b", str(tmp_path / "refused"))
    assert count.value == 3


def test_write_landing_round_trip(spark, tmp_path):
    record = {c: None for c in fixed.RECORD_FIELDS} | {"title": 'A "x", b', "book_link": "l", "publisher": "p"}
    df = spark.createDataFrame([tuple(record.values())], book_schema()).drop("description")
    df = df.withColumn("description", F.array(F.lit("jedan"), F.lit("dva"))).withColumn("source", F.lit("laguna"))
    landing.write_landing(landing.stamp_scraped_at(df, "2024-01-01 00:00:00"), str(tmp_path))
    back = landing.read_landing(spark, str(tmp_path / fixed.LANDING_FOLDER)).first()
    assert back["title"] == 'A "x", b' and back["description"] == "jedan\ndva"
    assert back["scraped_at"] == "2024-01-01 00:00:00 UTC" and back["source"] == "laguna"


def test_schemas():
    assert book_schema().names == list(fixed.RECORD_FIELDS)
    assert landed_schema().names == list(fixed.REQUIRED_COLUMNS)
    assert len(raw_schema()) == 11 and len(stats_schema()) == 9 and len(stg_books_schema()) == 15


def test_stats_document(spark):
    counters = spark.createDataFrame(
        [("laguna", 3, None, 7, "2024-01-01 00:00:00", "2024-01-01 00:00:02.5"), ("x", None, None, None, "None", "")],
        "spider_name string, item_scraped_count int, response_received_count int, request_count int, start_time string, finish_time string",
    )
    stats = run_stats.counters_to_stats(counters)
    got = {r["spider_name"]: r for r in stats.collect()}
    assert (got["laguna"]["duration"], got["laguna"]["response_received_count"]) == (2.5, 0)
    assert (got["x"]["duration"], got["x"]["item_scraped_count"]) == (None, 0)
    text = run_stats.stats_json(run_stats.stats_document(stats)).filter("source = 'laguna'").first()["document"]
    document = json.loads(text)
    assert document["stats"]["items_scraped"] == 3 and document["metadata"]["project_version"] == "1.0"


BOOK_PAGES = {
    "laguna": """<html><body id="knjiga_page"><h1 class="naslov">a</h1><h1 class="naslov">b</h1><h1 class="naslov">Most &amp; put</h1>
        <div><h2><a>Ivo <b>x</b></a></h2></div><a class="komentar-podatak" href="n1_knjiga.html">k</a>
        <p><span class="naslov_podatka">Žanr</span><h3><a>Drama</a></h3></p>
        <div class="cena"><span class="naslov">Cena:</span> 1.299,00 RSD<br><span class="naslov">Popust:</span> 999,00 RSD</div>
        <div id="podaci-korica"><div>ISBN <i>1</i></div><div>Strana: 5</div></div></body></html>""",
    "prometej": """<div id="content"><h1 class="product_title entry-title">Naslov</h1>
        <div class="book-cover small"><a href="http://prometej.rs/k/1">x</a></div><span class="posted_in"><a>Esej</a></span>
        <del>500</del><span class="sale-price amount">400</span><span class="sale-price amount">300</span>
        <div class="large-6 columns">Opis <br>knjige</div>""",
}


def _page(spark, url, html):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_extract_known_sources(spark):
    page = _page(spark, "https://www.laguna.rs/x", BOOK_PAGES["laguna"])
    book = pages.extract_books(page, SOURCE_RULES["laguna"]).first()
    assert book["title"] == "Most & put" and book["author"] == "Ivo " and book["category"] == "Drama"
    assert book["book_link"] == "https://www.laguna.rs/n1_knjiga.html" and book["publisher"] == "laguna"
    assert (book["old_price"].strip(), book["discount_price"].strip()) == ("1.299,00 RSD", "999,00 RSD")
    assert book["description"] == "ISBN 1\nStrana: 5" and book["currency"] == "RSD"
    page = _page(spark, "https://prometej.rs/x", BOOK_PAGES["prometej"])
    book = pages.extract_books(page, SOURCE_RULES["prometej"]).first()
    assert (book["title"], book["author"], book["category"]) == ("Naslov", "", "Esej")
    assert (book["old_price"], book["discount_price"], book["description"]) == ("500", "400", "Opis knjige")


def test_list_and_detail_pages(spark):
    listed = """<table><tr class="style_normal"><td><a href="knjiga.php?k=7"><span style="font-size:15px;">Spark</span></a>
        <i>Neko</i><strike>900</strike><font color="#ff00ff"><b>800</b></font></td>
        <tr class="style_normal"><td><span style="font-size:15px;">Bez veze</span></td></table><a href="?p=2">Naredna »</a>"""
    detail = """<div class="prikaz"><div><a>Sve</a><a>Računari</a></div></div><div class="prikaz_k2"><span class="prikaz_opis">O <b>njoj</b></span></div>"""
    rules = SOURCE_RULES["mikrok"]
    page = _page(spark, "https://www.mikroknjiga.rs/store/index.php", listed)
    books = pages.extract_books(page, rules).filter("book_link is not null")
    details = pages.select_fields(
        _page(spark, "https://www.mikroknjiga.rs/store/knjiga.php?k=7", detail), rules.detail_scope, rules.detail_fields
    ).select(F.col("url").alias("book_link"), F.get("description", F.lit(0)).alias("description"), F.get("category", F.lit(0)).alias("category"))
    row = pages.enrich_from_detail(books, details).first()
    assert (row["title"], row["author"], row["old_price"], row["discount_price"]) == ("Spark", "Neko", "900", "800")
    assert (row["description"], row["category"], row["publisher"]) == ("O njoj", "Računari", "mikroknjiga")
    links = pages.follow_links(page, rules).collect()
    assert [(r["kind"], r["link"]) for r in links] == [("next", "https://www.mikroknjiga.rs/store/index.php?p=2")]


def test_every_product_of_a_list_is_followed(spark):
    html = """<div class="large-6 medium-4 columns product-listing"><div class="book-meta"><a href="/k/1">a</a><a href="/k/2">b</a></div></div>
        <div class="large-6 medium-4 columns product-listing"><div class="book-meta"><a href="/k/2">c</a></div></div>
        <a class="next page-numbers" href="/prodavnica/page/2">dalje</a><a href="/o-nama">x</a>"""
    links = pages.follow_links(_page(spark, "https://prometej.rs/prodavnica/", html), SOURCE_RULES["prometej"])
    assert sorted((r["kind"], r["link"]) for r in links.collect()) == [
        ("detail", "https://prometej.rs/k/1"), ("detail", "https://prometej.rs/k/2"),
        ("next", "https://prometej.rs/prodavnica/page/2"),
    ]


def test_empty_page(spark):
    assert pages.extract_books(_page(spark, "http://a.rs", None), SOURCE_RULES["laguna"]).count() == 0

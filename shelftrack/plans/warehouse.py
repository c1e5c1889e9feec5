"""The whole warehouse: from raw rows to marts, stored and kept current."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftrack.functions.text import not_blank, split_list
from shelftrack.operators.aggregates import merged_statistics, moments, upper_outliers
from shelftrack.operators.ranking import latest_per_key
from shelftrack.operators.upsert import full_refresh, newer_than, upsert_table
from shelftrack.plans import marts
from shelftrack.plans.staging import STG_KEYS, build_stg_books, one_per_scan
from shelftrack.sources.tables import add_load, batch_rows, is_counted, is_known, is_table, read_table, save_model, stored_rows


PRICES = ("old_price", "discount_price")


def build_models(raw: DataFrame, dim_date: DataFrame, as_of: Column | None = None) -> dict[str, DataFrame]:
    """All models as lazy frames over a raw table, nothing stored."""
    stg = one_per_scan(build_stg_books(raw, as_of))
    int_books = marts.build_int_books(stg)
    return {
        "raw": raw,
        "stg_books": stg,
        "int_books": int_books,
        "dim_date": dim_date,
        "dim_authors": marts.build_dim_authors(int_books),
        "dim_publishers": marts.build_dim_publishers(stg),
        "dim_books": marts.build_dim_books(stg),
        "brg_book_author": marts.build_bridge(int_books),
        "fct_book_prices": marts.build_fct_prices(stg, dim_date),
    }


@dataclass(frozen=True)
class Warehouse:
    """Stored tables under one root folder."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def table(self, name: str) -> DataFrame | None:
        path = self.path(name)
        return read_table(self.spark, path) if is_table(self.spark, path) else None

    def rows(self, name: str) -> DataFrame | None:
        """All rows a table was ever given since its last refresh; enough for a watermark."""
        path = self.path(name)
        return stored_rows(self.spark, path) if is_table(self.spark, path) else None

    def update_staging(
        self, raw: DataFrame, batch: str, as_of: Column | None = None, by: str | None = None
    ) -> DataFrame:
        """Stage the raw rows above the watermark.

        The watermark is a UTC instant on both sides. ``by`` is a raw column,
        such as the publisher, that gets a watermark per value; staging keeps
        the unchanged value as its source.
        """
        target, source = self.rows("stg_books"), by or "publisher"
        day = "scrape_day" if "scrape_day" in raw.columns else None
        given = raw.withColumn("source", F.col(source)) if by else raw
        fresh = newer_than(
            given, target, "scraped_at", "scraped_at_utc", "source" if by else None, None if by else "scrape_day", day
        )
        staged = one_per_scan(build_stg_books(fresh, as_of, keep_instant=True, source=source))
        return upsert_table(self.spark, self.path("stg_books"), staged, STG_KEYS, "scrape_day", batch)

    def update_facts(self, dim_date: DataFrame, batch: str, per_source: bool = False) -> DataFrame | None:
        """Add the staged rows above the fact's own watermark; without staging there is none.

        The watermark is the instant, over all or ``per_source``. The later scan
        of a book and day stays, so rows that are offered again do no harm.
        """
        staged = self.table("stg_books")
        if staged is None:
            return None
        fresh = newer_than(
            staged, self.rows("fct_book_prices"), "scraped_at_utc", "max_scraped_at_utc", "source" if per_source else None,
            None if per_source else "price_day",
        )
        daily = marts.build_fct_prices(fresh, dim_date, keep_day=True)
        return upsert_table(
            self.spark, self.path("fct_book_prices"), daily, marts.FCT_KEYS, "price_day", batch,
            newest_by="max_scraped_at_utc",
        )

    def apply_batch(
        self, raw: DataFrame, dim_date: DataFrame, batch: str, as_of: Column | None = None
    ) -> DataFrame:
        """Stage a batch of raw rows and its facts without a watermark.

        For loads that see every row once, such as a stream: rows are measured
        against the stored row of their own key, not against a global time, so
        batches may come in any order and nothing is dropped as late. The facts are
        told from the rows as they were stored, so that texts are read once.
        """
        staged = one_per_scan(build_stg_books(raw, as_of, keep_instant=True))
        upsert_table(self.spark, self.path("stg_books"), staged, STG_KEYS, "scrape_day", batch)
        if is_counted(self.spark, self.path("stg_books"), batch):
            staged = batch_rows(self.spark, self.path("stg_books"), batch)
        daily = marts.build_fct_prices(staged, dim_date, keep_day=True)
        return upsert_table(
            self.spark, self.path("fct_book_prices"), daily, marts.FCT_KEYS, "price_day", batch,
            newest_by="max_scraped_at_utc",
        )

    def update_price_moments(self, batch: str, columns: tuple[str, ...] = PRICES) -> DataFrame:
        """Counts, means and squares of the prices of each day; of staging only the days that the batch touched are read."""
        days = batch_rows(self.spark, self.path("stg_books"), batch).select("scrape_day").distinct()
        # At most a row a day, so Spark prunes the other days before it reads.
        touched = self.table("stg_books").join(F.broadcast(days), "scrape_day", "left_semi")
        return upsert_table(self.spark, self.path("price_moments"), moments(touched, columns, "scrape_day"), ["scrape_day"], None, batch)

    def price_outliers(self, columns: tuple[str, ...] = PRICES) -> DataFrame:
        """Staged rows with a price far above the mean of all days, whose statistics come from the stored moments."""
        stats = merged_statistics(self.table("price_moments"), columns)
        return upper_outliers(self.table("stg_books"), columns, stats=stats)

    def update_dimensions(self, batch: str) -> None:
        """Count what the batch's staged rows add to the support of every author, publisher and pair, and what those they replace take away.

        To be called after the batch is staged. Only its own rows and those of the same keys before it
        are read, of the days it touches.
        """
        staged, path = self.path("stg_books"), self.path("dimension_support")
        if is_known(self.spark, path, batch):
            return
        new = batch_rows(self.spark, staged, batch)
        days = F.broadcast(new.select("scrape_day").distinct())  # at most a row a day
        old = read_table(self.spark, staged, before=batch).join(days, "scrape_day", "left_semi").join(new.select(*STG_KEYS), list(STG_KEYS), "left_semi")
        signed = new.withColumn("n", F.lit(1).cast("long")).unionByName(old.withColumn("n", F.lit(-1).cast("long")))
        authors = signed.select(F.lit("author").alias("kind"), "book_id", F.explode_outer(split_list("author")).alias("name"), "n")
        publishers = signed.select(F.lit("publisher").alias("kind"), F.lit(None).cast("string").alias("book_id"), F.col("publisher").alias("name"), "n")
        counted = authors.unionByName(publishers).filter(not_blank("name")).groupBy("kind", "book_id", "name").agg(F.sum("n").alias("n"))
        latest = latest_per_key(new, ["book_id"], "scraped_at_utc")
        upsert_table(self.spark, self.path("latest_scans"), latest, ["book_id"], None, batch, "scraped_at_utc")
        # Last, as it is what makes the batch known.
        add_load(counted.filter("n <> 0"), path, batch, ["book_id", "name"])

    def dimensions(self) -> dict[str, DataFrame]:
        """Authors, publishers, pairs and books as ``update_dimensions`` has counted them; what no row supports any more is gone."""
        support = stored_rows(self.spark, self.path("dimension_support"))
        support = support.groupBy("kind", "book_id", "name").agg(F.sum("n").alias("n")).filter("n > 0")
        pairs = support.filter("kind = 'author'").select("book_id", F.col("name").alias("author_name"))
        return {
            "dim_authors": marts.build_dim_authors(pairs),
            "dim_publishers": marts.build_dim_publishers(support.filter("kind = 'publisher'").select(F.col("name").alias("publisher"))),
            "brg_book_author": marts.build_bridge(pairs),
            "dim_books": marts.build_dim_books(read_table(self.spark, self.path("latest_scans"))),
        }

    def rebuild_dimensions(self, dim_date: DataFrame) -> dict[str, DataFrame]:
        """Rewrite the small tables from staging; facts and staging stay."""
        stg = self.table("stg_books")
        int_books = save_model(marts.build_int_books(stg), "int_books")
        models = {
            "dim_date": dim_date,
            "dim_authors": marts.build_dim_authors(int_books),
            "dim_publishers": marts.build_dim_publishers(stg),
            "dim_books": marts.build_dim_books(stg),
            "brg_book_author": marts.build_bridge(int_books),
        }
        return {name: save_model(df, name, "table", self.path(name)) for name, df in models.items()}

    def refresh(self, raw: DataFrame, dim_date: DataFrame, as_of: Column | None = None) -> None:
        """Everything from scratch, no watermark."""
        staged = one_per_scan(build_stg_books(raw, as_of, keep_instant=True))
        stg = full_refresh(self.spark, staged, self.path("stg_books"), "scrape_day", STG_KEYS)
        facts = marts.build_fct_prices(stg, dim_date, keep_day=True)
        full_refresh(self.spark, facts, self.path("fct_book_prices"), "price_day", marts.FCT_KEYS, "max_scraped_at_utc")
        self.rebuild_dimensions(dim_date)

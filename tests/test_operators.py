"""Joins, ranking, upserts and watermarks against plain Python."""

import importlib
import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelftrack import operators as op
from shelftrack.sources import tables
from shelftrack.sources.tables import read_table, stored_rows


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, rows, how):
    rng = random.Random(7)
    # One key holds a third of the rows, some keys are NULL, some have no partner.
    keys = [0] * 400 + [None] * 50 + [rng.randrange(1, 60) for _ in range(750)]
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int").repartition(7)
    right = spark.createDataFrame([(k, f"n{k}") for k in range(0, 60, 2)] + [(None, "null")], "k int, n string")
    got = op.skew_join(left, right, ["k"], how, rows_per_slice=20, max_hot=3)
    assert rows(got) == rows(left.join(right, "k", how))


def test_skew_join_spreads_a_hot_key(spark):
    """No task of the join gets much more than its share of a key that holds every row."""
    # Clustered: all rows of the key lie in one partition, as landed rows do.
    left = spark.range(0, 8000, 1, 1).select(F.lit(1).alias("k"), "id")
    right = spark.createDataFrame([(1, "x")], "k int, n string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = op.skew_join(left, right, ["k"], rows_per_slice=1000)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 8000
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) <= 4000


def test_attach_group_max(spark, rows):
    data = [(i % 3 and i % 17, i * 7 % 101) for i in range(500)]
    df = spark.createDataFrame(data, "g int, v int").repartition(5)
    best = {}
    for g, v in data:
        best[g] = max(best.get(g, -1), v)
    got = op.attach_group_max(df, ["g"], "v", "m")
    assert rows(got, "g", "v", "m") == sorted([(g, v, best[g]) for g, v in data], key=repr)


def test_latest_per_day(spark, rows):
    base = [("a", "2024-01-01 08:00"), ("a", "2024-01-01 22:30"), ("a", "2024-01-01 23:30"), ("b", "2024-07-01 22:30")]
    df = spark.createDataFrame(base, "k string, t string").withColumn("t", F.col("t").cast("timestamp"))
    from shelftrack.functions import local_day

    local = op.latest_per_key_per_day(df, ["k"], "t", local_day("t"))
    assert [r[1].hour for r in rows(local)] == [22, 23, 22]
    assert op.latest_per_key_per_day(df, ["k"], "t").count() == 2


def test_latest_uses_tiebreak(spark, rows):
    df = spark.createDataFrame([("a", 1, 3), ("a", 1, 9), ("a", 0, 10)], "k string, t int, x int")
    assert rows(op.latest_per_key(df, ["k"], "t", ["x"])) == [("a", 1, 9)]


def test_latest_reduces_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = op.latest_per_key(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("n", [2, 1200])
def test_per_source_cap(spark, n):
    data = [("hot", i) for i in range(3000)] + [("cold", i) for i in range(5)]
    df = spark.createDataFrame(data, "source string, i int").repartition(6)
    got = op.per_source_cap(df, n, ["i"]).collect()
    assert Counter(r["source"] for r in got) == {"hot": n, "cold": min(n, 5)}
    assert max(r["i"] for r in got if r["source"] == "hot") == n - 1


def test_missing_and_present(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (2,), (None,)], "r int")
    assert rows(op.missing_in(left, "k", right, "r")) == [(1,), (None,)]
    assert rows(op.present_in(left, "k", right, "r")) == [(2,)]


def test_date_spine(spark, rows):
    got = rows(op.date_spine(spark, "2024-02-27", "2024-03-01"))
    assert [d[0] for d in got] == [date(2024, 2, 27) + timedelta(days=i) for i in range(4)]


def test_upper_outliers(spark, rows):
    df = spark.createDataFrame([(i, 1.0 + i % 2, 5.0) for i in range(100)] + [(100, 1000.0, 5.0), (101, None, None)], "i int, a double, b double")
    assert rows(op.upper_outliers(df, ["a", "b"]), "i") == [(100,)]
    assert op.upper_outliers(df.filter("i < 0"), ["a"]).count() == 0


@pytest.mark.parametrize("n", [1, 40, 300, 5000])
def test_sample_per_source(spark, rows, n):
    """The smallest hashes of each source, also of one whose hashes are all large and of a NULL one."""
    df = spark.range(4000).select(F.when(F.col("id") % 10 > 0, "big").when(F.col("id") % 20 == 0, "small").alias("source"), F.col("id").alias("i"))
    large = spark.range(20000).select(F.lit("large").alias("source"), (F.col("id") + 10000).alias("i"))
    df = df.unionByName(large.filter(F.xxhash64("i") > 6 * 10**18))
    ranked = Window.partitionBy("source").orderBy(F.xxhash64("i"), "i")
    wanted = df.withColumn("r", F.row_number().over(ranked)).filter(F.col("r") <= n)
    assert rows(op.sample_per_source(df, n, "i"), "source", "i") == rows(wanted, "source", "i")


def test_watermark(spark, rows):
    t = lambda h: datetime(2024, 1, 1, h)
    new = spark.createDataFrame([("s", t(1)), ("s", t(3)), ("u", t(2)), ("w", t(1))], "src string, ts timestamp")
    target = spark.createDataFrame([("s", t(2)), ("u", t(1))], "src string, ts timestamp")
    assert rows(op.newer_than(new, target, "ts")) == [("s", t(3))]
    assert rows(op.newer_than(new, target, "ts", by="src")) == [("s", t(3)), ("u", t(2)), ("w", t(1))]
    assert op.newer_than(new, target.limit(0), "ts").count() == 4
    assert op.newer_than(new, None, "ts").count() == 4


def test_upsert_rules(spark, rows):
    """One newer row, one new key, one late row, two rows of one key."""
    schema = "k string, ts timestamp, v int"
    t = lambda d, h=0: datetime(2024, 1, d, h)
    target = spark.createDataFrame([("a", t(1), 1), ("b", t(2), 2), ("c", t(3), 3)], schema)
    batch = [("a", t(4), 10), ("d", t(4), 11), ("b", t(1), 12), ("c", t(5), 13), ("c", t(5, 6), 14)]
    fresh = op.newer_than(spark.createDataFrame(batch, schema), target, "ts")
    merged = op.upsert(target, op.latest_per_key(fresh, ["k"], "ts"), ["k"])
    assert rows(merged, "k", "v") == [("a", 10), ("b", 2), ("c", 14), ("d", 11)]


def _days(spark, items):
    df = spark.createDataFrame(items, "k string, ts timestamp, v int")
    return op.latest_per_key(df.withColumn("day", F.to_date("ts")), ["k", "day"], "ts", ["v"])


def test_stored_upsert_in_batches_equals_full_refresh(spark, rows, tmp_path):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    items = [(f"k{rng.randrange(5)}", start + timedelta(hours=i), i) for i in range(120)]
    path = str(tmp_path / "daily")
    for n, cut in enumerate((30, 31, 77, 120)):
        stored = read_table(spark, path) if n else None
        source = spark.createDataFrame(items[:cut], "k string, ts timestamp, v int")
        fresh = op.newer_than(source, stored, "ts", partition="day" if n else None)
        new = op.latest_per_key(fresh.withColumn("day", F.to_date("ts")), ["k", "day"], "ts", ["v"])
        result = op.upsert_table(spark, path, new, ["k", "day"], "day", f"b{n}")
    assert rows(result, "k", "ts", "v") == rows(_days(spark, items), "k", "ts", "v")


def test_repeated_batches_change_nothing(spark, rows, tmp_path):
    """Any earlier batch may come again, after any later one."""
    path = str(tmp_path / "table")
    first = _days(spark, [("a", datetime(2024, 1, 1, 1), 1), ("b", datetime(2024, 1, 1, 2), 2), ("c", datetime(2024, 1, 2), 3)])
    second = _days(spark, [("a", datetime(2024, 1, 1, 5), 9), ("d", datetime(2024, 1, 1, 6), 4)])
    for new, batch in ((first, "one"), (second, "two"), (first, "one"), (second, "two"), (first, "one")):
        stored = op.upsert_table(spark, path, new, ["k", "day"], "day", batch)
    assert rows(stored, "k", "v") == [("a", 9), ("b", 2), ("c", 3), ("d", 4)]
    assert stored.columns == first.columns


def test_a_run_that_dies_leaves_the_table_as_it_was(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    first = _days(spark, [("a", datetime(2024, 1, 1, 1), 1), ("b", datetime(2024, 1, 1, 2), 2)])
    second, third = (_days(spark, [("a", datetime(2024, 1, 1, h), h)]) for h in (5, 7))
    op.upsert_table(spark, path, first, ["k", "day"], "day", "one")
    before = read_table(spark, path)
    counts = tables._count

    def dies(*arguments):
        raise RuntimeError("lost")

    # All rows are written, but the load does not count yet.
    monkeypatch.setattr(tables, "_count", dies)
    with pytest.raises(RuntimeError):
        op.upsert_table(spark, path, second, ["k", "day"], "day", "two")
    monkeypatch.setattr(tables, "_count", counts)
    failing = second.withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        op.upsert_table(spark, path, failing, ["k", "day"], "day", "two")
    assert rows(read_table(spark, path), "k", "v") == rows(before, "k", "v") == [("a", 1), ("b", 2)]
    # Another batch comes in between; the lost one is then repeated and does not undo it.
    op.upsert_table(spark, path, third, ["k", "day"], "day", "three", newest_by="ts")
    again = op.upsert_table(spark, path, second, ["k", "day"], "day", "two", newest_by="ts")
    assert rows(again, "k", "v") == [("a", 7), ("b", 2)]
    assert rows(stored_rows(spark, path), "k", "v") == [("a", 1), ("a", 5), ("a", 7), ("b", 2)]


def test_merge_on_reading_needs_no_exchange(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in range(3):
        new = _days(spark, [(f"k{i}", datetime(2024, 1, 1 + i % 4, n), n) for i in range(40)])
        stored = op.upsert_table(spark, path, new, ["k", "day"], "day", f"b{n}", "ts")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    # The few rows about loads are aggregated and broadcast; the table's rows stay where they are.
    assert "Window" in plan and "hashpartitioning(k#" not in plan and "SortMergeJoin" not in plan and "Bucketed: true" in plan
    assert {r["v"] for r in stored.collect()} == {2} and stored.count() == 40
    # A day's filter reaches the files.
    plan = stored.filter("day = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_two_loads_of_one_batch_count_once(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    for value in (1, 2):
        tables.add_load(_days(spark, [("a", datetime(2024, 1, 1), value)]), path, "one", ["k", "day"], "day")
    assert rows(read_table(spark, path), "v") == [(1,)]


def test_refresh_and_then_batches(spark, rows, tmp_path):
    """A refresh may read the table it replaces; batches before it stay known and count no more."""
    path = str(tmp_path / "table")
    first = _days(spark, [("a", datetime(2024, 1, 1), 1), ("b", datetime(2024, 1, 2), 2)])
    op.upsert_table(spark, path, first, ["k", "day"], "day", "one")
    op.full_refresh(spark, read_table(spark, path).withColumn("v", F.col("v") * 10), path)
    op.upsert_table(spark, path, first, ["k", "day"], "day", "one")
    op.upsert_table(spark, path, first.filter("k = 'b'").withColumn("v", F.lit(7)), ["k", "day"], "day", "two")
    assert rows(read_table(spark, path), "k", "v") == [("a", 10), ("b", 7)]
    assert rows(stored_rows(spark, path), "v") == [(10,), (20,), (7,)]


def test_table_without_days_or_keys(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    df = spark.createDataFrame([(1, None, [1.5])], "`a b` int, d date, list array<double>")
    for _ in range(2):
        tables.replace_table(df, path)
    assert rows(read_table(spark, path)) == [(1, None, [1.5])] and read_table(spark, path).columns == df.columns
    days = str(tmp_path / "days")
    op.upsert_table(spark, days, spark.createDataFrame([(1, None)], "k int, day date"), ["k"], "day", "one")
    op.upsert_table(spark, days, spark.createDataFrame([(1, None)], "k int, day date"), ["k"], "day", "two")
    assert rows(read_table(spark, days)) == [(1, None)]


def test_interrupted_save_keeps_the_old_table(spark, rows, tmp_path):
    from shelftrack.sources.tables import is_table, save_model

    path = str(tmp_path / "model")
    assert not is_table(spark, path)
    save_model(spark.range(3).toDF("n"), "kept_model", "table", path)
    failing = spark.range(3).select(F.when(F.col("id") > 1, F.raise_error(F.lit("lost"))).cast("long").alias("n"))
    with pytest.raises(Exception, match="lost"):
        save_model(failing, "kept_model", "table", path)
    assert rows(read_table(spark, path)) == [(0,), (1,), (2,)]


def test_unreadable_table_raises(spark, tmp_path):
    from shelftrack.sources.tables import is_table

    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("no parquet")
    assert is_table(spark, str(tmp_path / "t"))
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "t")).count()


def test_empty_batch_changes_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = _days(spark, [("a", datetime(2024, 1, 1), 1)])
    op.upsert_table(spark, path, first, ["k", "day"], "day", "one")
    after = op.upsert_table(spark, path, first.filter("v > 5"), ["k", "day"], "day", "none")
    assert rows(after, "k", "v") == [("a", 1)]


def test_merged_moments(spark):
    """Parts of very different sizes, one empty, one of a single value; large values with small spread."""
    rng = random.Random(6)
    rows = [(d, 1e9 + rng.gauss(d, 1), None if d == 2 else rng.random()) for d in range(5) for _ in range(1 + 40 * d)]
    df = spark.createDataFrame(rows, "day int, a double, b double")
    parts = op.moments(df, ["a", "b"], "day")
    got = op.merged_statistics(parts, ["a", "b"]).first()
    wanted = op.price_statistics(df, ["a", "b"]).first()
    assert got.asDict() == pytest.approx(wanted.asDict(), rel=1e-6)
    assert set(op.merged_statistics(parts.filter("day > 9"), ["a", "b"]).first()) == {None}
    one = op.merged_statistics(parts.filter("day = 0"), ["a", "b"]).first()
    assert one["avg_b"] == rows[0][2] and one["stddev_b"] is None

import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

from forecourt.operators import frontier, scoring, training
from forecourt.plans import jobs
from forecourt.schemas import FRONTIER, LISTINGS, RAW_PAGES
from forecourt.sources import runs, sample
from forecourt.sources.tables import append_table, read_table

SCHEMA = StructType([StructField("url", StringType()), StructField("price", DoubleType()), StructField("time_posted", TimestampType())])


def rows(spark, n, start=0, day="2001-07-30"):
    return spark.range(start, start + n).select(
        F.concat(F.lit("u"), "id").alias("url"), F.col("id").cast("double").alias("price"),
        (F.lit(day).cast("timestamp") - F.make_dt_interval(F.col("id") % 5)).alias("time_posted"))


def urls(df):
    return sorted(r.url for r in df.collect())


def test_a_repeated_run_adds_nothing(spark, tmp_path):
    t = str(tmp_path / "t")
    counts = {"dear": F.count_if(F.col("price") > 7)}
    first = runs.append_run(rows(spark, 10), t, "monday", SCHEMA, "time_posted", counts)
    assert first == runs.Written(10, {"dear": 2})
    again = runs.append_run(rows(spark, 99), t, "monday", SCHEMA, "time_posted", counts)
    assert again == runs.Written(10, {"dear": 2}, repeated=True)
    assert runs.append_run(rows(spark, 5, 10), t, "tuesday", SCHEMA, "time_posted").rows == 5
    got = runs.read_runs(spark, t, SCHEMA)
    assert got.columns == [*SCHEMA.names, "run", "day"] and got.count() == 15
    assert runs.read_runs(spark, t, SCHEMA, runs=["tuesday"]).count() == 5
    assert {(r.run, r.measure): r.value for r in runs.run_counts(spark, t).collect()} == {
        ("monday", "rows"): 10, ("monday", "dear"): 2, ("tuesday", "rows"): 5}


def test_a_run_without_its_mark_is_no_part_of_the_table(spark, tmp_path):
    t = str(tmp_path / "t")
    assert runs.read_runs(spark, t, SCHEMA).count() == 0
    left = f"{t}/generation=000001/run=broken"
    rows(spark, 7).withColumn("day", F.lit("2001-01-01")).write.partitionBy("day").parquet(left)
    assert runs.snapshot(spark, t).generation == 0
    runs.append_run(rows(spark, 3), t, "good", SCHEMA, "time_posted")
    assert runs.read_runs(spark, t, SCHEMA).count() == 3
    # The repeated run takes the place of what its failed attempt left.
    assert runs.append_run(rows(spark, 4, 100), t, "broken", SCHEMA, "time_posted").rows == 4
    assert urls(runs.read_runs(spark, t, SCHEMA, runs=["broken"])) == ["u100", "u101", "u102", "u103"]


def test_empty_runs_and_null_days(spark, tmp_path):
    t = str(tmp_path / "t")
    assert runs.append_run(rows(spark, 0), t, "empty", SCHEMA, "time_posted").rows == 0
    assert runs.read_runs(spark, t, SCHEMA).count() == 0
    undated = rows(spark, 2).withColumn("time_posted", F.lit(None).cast("timestamp"))
    runs.append_run(undated, t, "undated", SCHEMA, "time_posted")
    assert [(r.url, r.day) for r in runs.read_runs(spark, t, SCHEMA).orderBy("url").collect()] == [("u0", None), ("u1", None)]
    for name in ("", "a/b", "a=b", "_x", "..", "c:d"):
        with pytest.raises(ValueError):
            runs.append_run(rows(spark, 1), t, name, SCHEMA)


def test_a_replacement_is_seen_whole_or_not_at_all(spark, tmp_path):
    t = str(tmp_path / "t")
    runs.append_run(rows(spark, 6), t, "a", SCHEMA)
    runs.append_run(rows(spark, 4, 6), t, "b", SCHEMA)
    before = runs.snapshot(spark, t)
    old = runs.read_runs(spark, t, SCHEMA, at=before)
    assert runs.replace_runs(old.filter("price >= 5"), t, "clean", SCHEMA, read_at=before).rows == 5
    assert runs.read_runs(spark, t, SCHEMA).count() == 5 and old.count() == 10
    assert runs.replace_runs(rows(spark, 1), t, "clean", SCHEMA).repeated
    # Runs that the replacement stands for do not come back when they are repeated.
    assert runs.append_run(rows(spark, 6), t, "a", SCHEMA) == runs.Written(0, repeated=True)
    assert runs.append_run(rows(spark, 1, 50), t, "c", SCHEMA).rows == 1
    assert urls(runs.read_runs(spark, t, SCHEMA)) == ["u5", "u50", "u6", "u7", "u8", "u9"]
    with pytest.raises(RuntimeError, match="was written while"):
        runs.replace_runs(rows(spark, 1), t, "late", SCHEMA, read_at=before)
    assert runs.read_runs(spark, t, SCHEMA).count() == 6
    assert runs.drop_old(spark, t) == 1 and runs.read_runs(spark, t, SCHEMA).count() == 6


def test_windows_read_only_their_days(spark, tmp_path, as_of):
    listings = sample.listings(spark, "/root/testdata/sf0.001").withColumns(
        {k: F.lit(None).cast(LISTINGS[k].dataType) for k in LISTINGS.names if k not in sample.LISTING_COLUMNS})
    for unit in runs.UNITS:
        t = str(tmp_path / unit)
        recent = listings.filter(F.col("time_posted") > "2001-01-01")
        runs.append_run(recent, t, "r", LISTINGS, "time_posted", unit=unit)
        stored = runs.read_runs(spark, t, LISTINGS)
        for made in (training.fit_filtered(stored, as_of, 60), scoring.recent_listings(stored, as_of)):
            plan = plan_of(made)
            assert f"PartitionFilters: [isnotnull({unit}" in plan and f"{unit}#" in plan.split("PartitionFilters")[1].split("]")[0]
        got = scoring.recent_listings(stored, as_of)
        assert urls(got) == urls(scoring.recent_listings(listings, as_of))
        read = {f.split(f"{unit}=")[1][:10] for f in got.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
        assert read and min(read) >= "2001-06-01"


def test_latest_rows_do_not_depend_on_partitions(spark):
    t = dt.datetime(2001, 1, 1)
    same = [("u", float(p), t) for p in range(8)] + [("v", 1.0, t), ("v", 2.0, t + dt.timedelta(hours=1)), (None, 3.0, None)]
    df = spark.createDataFrame(same, "url string, price double, basic_processed_time timestamp")
    seen = {tuple(sorted(map(str, frontier.latest_listings(df.repartition(n)).collect()))) for n in (1, 3, 5, 8)}
    assert len(seen) == 1 and len(next(iter(seen))) == 3
    pulls = df.withColumn("datetime_pulled", F.lit(t) + F.make_dt_interval(F.col("price").cast("int")))
    got = {r.url: r.price for r in frontier.latest_listings(pulls).collect()}
    assert got == {"u": 7.0, "v": 2.0, None: 3.0}
    # The latest parse is looked for among all rows, whatever rows are then asked for.
    assert [r.url for r in frontier.latest_listings(df, F.col("price") == 1).collect()] == ["u"]
    pages = spark.createDataFrame([("a", t, "old", "x"), ("a", t + dt.timedelta(1), "new", "x"), ("b", t, "only", "x")], RAW_PAGES)
    assert sorted(r.raw_html for r in frontier.latest_pulls(pages).collect()) == ["new", "only"]


def test_a_url_queued_twice_is_fetched_once(spark, as_of):
    queue = spark.createDataFrame([("a", "x", as_of), ("a", "x", as_of - dt.timedelta(2)), ("b", "y", as_of - dt.timedelta(1))], FRONTIER)
    none = spark.createDataFrame([], "url string")
    assert [tuple(r) for r in frontier.harvest_batch(queue, none, 1).collect()] == [("a", "x")]
    assert sorted(tuple(r) for r in frontier.harvest_batch(queue, none, None).collect()) == [("a", "x"), ("b", "y")]


def test_jobs_repeated_under_one_name(spark, as_of, tmp_path):
    t = {n: str(tmp_path / n) for n in ("raw", "frontier", "listings", "log", "scratch")}
    sf = "/root/testdata/sf0.001"
    pages = sample.raw_pages(spark, sf).limit(40).cache()
    results = pages.select("location", F.xxhash64("url").alias("page_no"), F.concat(F.lit('<a class="posting-title" href="'), "url", F.lit('">x</a>')).alias("html"))
    append_table(spark.createDataFrame([], RAW_PAGES), t["raw"])
    append_table(spark.createDataFrame([], FRONTIER), t["frontier"])
    for _ in range(2):
        assert jobs.update_frontier(spark, results, t["raw"], t["frontier"], as_of, run="d1", scratch=t["scratch"]) == 40
    fetched = pages.select("url", "raw_html")
    for _ in range(2):
        assert jobs.harvest_pages(spark, fetched, t["frontier"], t["raw"], as_of, limit=25, run="d1") == 25
    for _ in range(2):
        assert jobs.clean_frontier(spark, t["frontier"], t["raw"], run="d1-clean") == 15
    assert runs.read_runs(spark, t["frontier"], FRONTIER).count() == 15
    words = sample.dictionary(spark, sf)
    append_table(spark.createDataFrame([], LISTINGS), t["listings"])
    # The second time the backlog is empty, and the run is there already.
    for _ in range(2):
        assert jobs.parse_pages(spark, t["raw"], words, t["listings"], as_of, run="d1", log=t["log"], scratch=t["scratch"]) == 25
    assert list((tmp_path / "scratch").iterdir()) == []
    stored = runs.read_runs(spark, t["listings"], LISTINGS)
    assert stored.count() == stored.select("url").distinct().count() == 25 and "day" in stored.columns
    notes = [r.notes for r in read_table(spark, t["log"]).orderBy("time_finished").collect()]
    assert all(n.startswith("25 listings written, no_condition=") for n in notes) and notes[1].endswith("(repeated)")

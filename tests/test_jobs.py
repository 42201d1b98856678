import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

import __spark_entry__ as contract
from forecourt.operators import extract, frontier
from forecourt.plans import catalog, jobs
from forecourt.schemas import FRONTIER, LISTINGS, MODELS, RAW_PAGES
from forecourt.sources import sample
from forecourt.sources.tables import append_table, log_run, overwrite_table, read_table
from forecourt.streaming.incremental import parse_stream


def test_append_counts_and_empty_append(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10)
    assert append_table(df, path) == 10
    assert append_table(df.filter("id < 0"), path) == 0
    assert append_table(df, path) == 10
    assert read_table(spark, path, ["id"]).count() == 20


def test_overwrite_casts_to_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    for make in ("ford", "ram"):
        df = spark.range(1).select(
            F.lit(make).alias("make"), *[F.lit("1").alias(c) for c in MODELS.fieldNames()[1:]],
            F.lit(0).alias("surplus"))
        assert overwrite_table(df, path, MODELS) == 1
    assert read_table(spark, path).schema == MODELS
    assert [r.make for r in read_table(spark, path).collect()] == ["ram"]


def test_run_log(spark, tmp_path):
    path, t = str(tmp_path / "log"), dt.datetime(2024, 1, 1, 2, 3, 4)
    log_run(spark, path, "a", t, t, "1 row")
    log_run(spark, path, "b", t, t, "2 rows")
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == [
        ("a", t, t, "1 row"), ("b", t, t, "2 rows")]


def test_parse_round_trip_and_plan(spark, sf_dir, tmp_path):
    listings = sample.listings(spark, sf_dir)
    sample.raw_pages(spark, sf_dir).write.parquet(str(tmp_path / "raw"))
    raw = read_table(spark, str(tmp_path / "raw"))
    parsed = extract.extract_fields(raw)
    same = [c for c in LISTINGS.fieldNames() if c in parsed.columns and c in listings.columns]
    left = parsed.select(same)
    right = listings.select(*[F.col(c).cast(LISTINGS[c].dataType) for c in same])
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0
    plan = plan_of(parsed)
    assert "Python" not in plan and "Exchange" not in plan
    full = plan_of(extract.parse_listings(raw, sample.dictionary(spark, sf_dir), sample.AS_OF))
    assert "Python" not in full and "NestedLoop" not in full and "Cartesian" not in full


def test_stored_parse_equals_the_lazy_one(spark, sf_dir, tmp_path):
    sample.raw_pages(spark, sf_dir).limit(300).write.parquet(str(tmp_path / "raw"))
    raw, words = read_table(spark, str(tmp_path / "raw")), sample.dictionary(spark, sf_dir)
    stored = extract.parse_stored(raw, words, sample.AS_OF, str(tmp_path / "scratch"))
    lazy = extract.parse_listings(raw, words, sample.AS_OF)
    assert stored.exceptAll(lazy).count() == 0 and lazy.exceptAll(stored).count() == 0
    plan = plan_of(stored)
    # Pages are not read again, and the stored rows stay where they are: only what was found moves.
    assert str(tmp_path / "raw") not in plan and "Python" not in plan
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_backlog_is_joined_before_pages_are_read(spark, sf_dir, tmp_path):
    sample.raw_pages(spark, sf_dir).write.parquet(str(tmp_path / "raw"))
    raw = read_table(spark, str(tmp_path / "raw"))
    batch = frontier.parse_batch(raw.filter("location = 'nation_5'").select("url"), None)
    plan = plan_of(extract.extract_fields(frontier.pages_to_parse(raw, batch)))
    assert plan.index("regexp_replace(raw_html") < plan.index("LeftSemi")


def test_malformed_page_keeps_its_row(spark, as_of):
    raw = spark.createDataFrame(
        [("https://a.org/1.html", as_of, "<script id='ld_posting_data'>{oops</script><span class='valu year'>x",
          "a"), ("https://a.org/2.html", as_of, None, "a")], RAW_PAGES)
    dictionary = spark.createDataFrame([("ford", "f150", "")], "make string, model string, short_model string")
    got = extract.parse_listings(raw, dictionary, as_of)
    assert got.schema.fieldNames() == LISTINGS.fieldNames()
    rows = got.collect()
    assert [(r.price, r.year, r.make, r.needs_ai_parsing) for r in rows] == [(None, None, None, True)] * 2


def test_pipeline_end_to_end(spark, as_of, tmp_path):
    t = {n: str(tmp_path / n) for n in ("raw", "frontier", "clean", "listings", "models", "deals", "states", "log")}
    sf = "/root/testdata/sf0.001"
    for name, schema in (("raw", RAW_PAGES), ("frontier", FRONTIER), ("listings", LISTINGS)):
        append_table(spark.createDataFrame([], schema), t[name])
    all_pages = sample.raw_pages(spark, sf)
    results = all_pages.select(
        "location", F.xxhash64("url").alias("page_no"),
        F.concat(F.lit('<a class="posting-title" href="'), "url", F.lit('">x</a>')).alias("html"))
    n = jobs.update_frontier(spark, results, t["raw"], t["frontier"], as_of, log=t["log"], host="h")
    assert n == all_pages.count()
    assert jobs.update_frontier(spark, results, t["raw"], t["frontier"], as_of) == 0
    fetched = all_pages.select("url", "raw_html")
    assert jobs.harvest_pages(spark, fetched, t["frontier"], t["raw"], as_of, limit=130) == 130
    assert jobs.harvest_pages(spark, fetched, t["frontier"], t["raw"], as_of, log=t["log"]) == n - 130
    assert jobs.clean_frontier(spark, t["frontier"], t["raw"], t["clean"]) == 0
    words = sample.dictionary(spark, sf)
    assert jobs.parse_pages(spark, t["raw"], words, t["listings"], as_of, limit=100, log=t["log"]) == 100
    assert jobs.parse_pages(spark, t["raw"], words, t["listings"], as_of) == n - 100
    assert jobs.parse_pages(spark, t["raw"], words, t["listings"], as_of) == 0
    overwrite_table(sample.states(spark, sf), t["states"])
    fitted = jobs.fit_price_models(
        spark, t["listings"], t["models"], as_of, lookback_days=3650, min_group=20, log=t["log"])
    assert fitted > 0
    scored = jobs.score_deals(
        spark, t["listings"], t["states"], t["models"], t["deals"], as_of, log=t["log"])
    expected = contract.entry(spark)
    assert scored == expected.count()
    pick = ["url", F.round("predicted_price", 1).alias("p"), "sample_size"]
    assert read_table(spark, t["deals"]).select(*pick).exceptAll(expected.select(*pick)).count() == 0
    notes = {r.task: r.notes for r in read_table(spark, t["log"]).collect()}
    assert notes["update_frontier"] == f"{n} new URLs queued on h"
    assert set(notes) == {"update_frontier", "harvest_pages", "parse_pages", "fit_price_models", "score_deals"}
    # A second parse of every page neither doubles the training rows nor the scored ones.
    later = as_of + dt.timedelta(hours=1)
    again = extract.parse_listings(read_table(spark, t["raw"]), words, later)
    assert append_table(again, t["listings"]) == n
    assert jobs.score_deals(spark, t["listings"], t["states"], t["models"], t["deals"], as_of) == scored


def test_stream_parses_each_page_once(spark, as_of, tmp_path):
    raw, out, check = (str(tmp_path / n) for n in ("raw", "out", "check"))
    words = sample.dictionary(spark, "/root/testdata/sf0.001")
    pages = sample.raw_pages(spark, "/root/testdata/sf0.001").select(
        "url", F.col("datetime_pulled").cast("timestamp"), "raw_html", "location")

    def step(df):
        df.coalesce(1).write.mode("append").parquet(raw)
        parse_stream(spark, raw, words, out, check, as_of).awaitTermination()
        return spark.read.parquet(out)

    assert step(pages.limit(30)).count() == 30
    both = step(pages.subtract(pages.limit(30)).limit(20))
    assert both.count() == 50
    assert both.select("make").filter("make IS NULL").count() == 0


def test_misfits_are_errors(spark, tmp_path):
    row = spark.range(1).select(F.lit("ford").alias("make"), *[F.lit("abc").alias(c) for c in MODELS.fieldNames()[1:]])
    with pytest.raises(Exception, match="does not fit"):
        overwrite_table(row, str(tmp_path / "t"), MODELS)


def test_contract_names():
    assert set(catalog.ORACLES) == set(catalog.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_building_queries_runs_no_job(spark, sf_dir):
    sc = spark.sparkContext
    sc.setJobGroup("building", "building queries")
    for name, build in catalog.QUERIES.items():
        if name not in catalog.STORING:
            build(spark, sf_dir)
    ran = [j for j in sc.statusTracker().getJobIdsForGroup("building")]
    sc.setJobGroup("", "")
    # Reading a parquet file's schema is a job of one task; nothing else runs.
    names = {sc.statusTracker().getStageInfo(s).numTasks for j in ran for s in sc.statusTracker().getJobInfo(j).stageIds if sc.statusTracker().getStageInfo(s)}
    assert names <= {1}

import datetime as dt

from conftest import plan_of
from pyspark.sql import functions as F

from forecourt.operators import frontier as fr

PAGES = "location string, page_no long, html string"
KEYS = "url string, location string, row_created timestamp"


def page(*urls):
    return "".join(f'<li><a href="{u}" class="cl posting-title">x</a></li>' for u in urls)


def test_listing_links_keep_own_site_only(spark):
    pages = spark.createDataFrame(
        [("bend", 0, page("https://bend.org/1?a=1&amp;b=2", "https://boise.org/2")
          + '<a class="other" href="https://bend.org/3">y</a><a class="posting-title">z</a>')], PAGES)
    assert [r.url for r in fr.listing_links(pages).collect()] == ["https://bend.org/1?a=1&b=2"]
    assert fr.listing_links(pages, None).count() == 2


def test_site_directory_last_wins(spark):
    html = ('<a href="https://x.org/">x</a><div class="geo-site-list-container">'
            '<a href="https://bend.org/1">a</a><a name="n">n</a><a href="https://bend.org/2">b</a></div>')
    got = fr.site_directory(spark.createDataFrame([(0, html)], "page_no int, html string"))
    assert [tuple(r) for r in got.collect()] == [("bend", "https://bend.org/2")]


def test_crawl_stops_at_first_stale_page(spark):
    rows = [("s", n, page(*[f"//s/{u}" for u in urls]))
            for n, urls in enumerate([["a", "b"], ["b", "c"], ["a", "c"], ["d"]])]
    rows += [("t", 0, "<p>none</p>"), ("t", 1, page("//t/x")), ("u", 0, page("//u/x"))]
    got = fr.crawl_new_links(spark.createDataFrame(rows, PAGES))
    assert sorted((r.page_no, r.url) for r in got.collect()) == [
        (0, "//s/a"), (0, "//s/b"), (0, "//u/x"), (1, "//s/b"), (1, "//s/c")]


def test_recent_urls_window_is_strict(spark):
    as_of = dt.datetime(2024, 3, 31, 15)
    raw = spark.createDataFrame(
        [("edge", dt.datetime(2024, 3, 1)), ("in", dt.datetime(2024, 3, 1, 0, 0, 1))],
        "url string, datetime_pulled timestamp")
    frontier = spark.createDataFrame([("queued",), ("queued",)], "url string")
    assert {r.url for r in fr.recent_urls(raw, frontier, as_of).collect()} == {"in", "queued"}
    assert fr.recent_urls(raw, frontier, as_of).count() == 2


def test_new_links_dedupe_and_idempotence(spark, as_of):
    links = spark.createDataFrame(
        [("b", 2, "u1"), ("a", 1, "u1"), ("a", 1, "u2"), ("a", 1, "old")],
        "location string, page_no long, url string")
    seen = spark.createDataFrame([("old",), (None,)], "url string")
    new = fr.new_links(links, seen, as_of)
    assert sorted((r.url, r.location, r.row_created) for r in new.collect()) == [
        ("u1", "a", as_of), ("u2", "a", as_of)]
    assert fr.new_links(links, seen.union(new.select("url")), as_of).count() == 0


def test_harvest_batch_order_nulls_and_plan(spark):
    t = dt.datetime(2024, 1, 1)
    queue = spark.createDataFrame(
        [("c", "x", t), ("b", "x", t), ("a", "x", t + dt.timedelta(1)), ("done", "x", t)], KEYS)
    raw = spark.createDataFrame([("done",), (None,)], "url string")
    batch = fr.harvest_batch(queue, raw, 2)
    assert [r.url for r in batch.collect()] == ["b", "c"]
    assert "TakeOrderedAndProject" in plan_of(batch)
    assert {r.url for r in fr.frontier_cleanup(queue, raw).collect()} == {"a", "b", "c"}


def test_backlog_latest_flag_and_sample(spark):
    raw = spark.createDataFrame([(u,) for u in "abcdd"], "url string")
    t = dt.datetime(2024, 1, 1)
    done = spark.createDataFrame(
        [("a", True, t), ("b", True, t), ("b", False, t + dt.timedelta(1)), ("c", None, t)],
        "url string, needs_basic_parsing boolean, basic_processed_time timestamp")
    urls = lambda df: sorted(r.url for r in df.collect())
    assert urls(fr.parse_backlog(raw, done)) == ["a", "d"]
    assert urls(fr.parse_backlog(raw, done, latest_only=False)) == ["a", "b", "d"]
    many = spark.range(500).select(F.col("id").cast("string").alias("url"))
    one = urls(fr.parse_batch(many.repartition(7), 50))
    assert len(one) == 50 and one == urls(fr.parse_batch(many.coalesce(1), 50))
    assert one != urls(fr.parse_batch(many, 50, seed=1))


def test_bucketed_tables_join_without_shuffle(spark):
    from forecourt.sources.tables import append_table, read_table

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        urls = spark.range(100).select(F.col("id").cast("string").alias("url"))
        stamp = urls.withColumns({"location": F.lit("x"), "row_created": F.current_timestamp()})
        assert append_table(stamp, "queue_b", bucket_by=("url", 4)) == 100
        assert append_table(urls.limit(40), "raw_b", bucket_by=("url", 4)) == 40
        left = fr.frontier_cleanup(read_table(spark, "queue_b"), read_table(spark, "raw_b"))
        assert left.count() == 60
        assert "Exchange" not in plan_of(left)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS queue_b")
        spark.sql("DROP TABLE IF EXISTS raw_b")

"""URL frontier: link extraction, incremental anti-joins and batch selection.

Every join here is on ``url`` and reads only the key columns, so page text never enters a
shuffle.  Repeated URLs are aggregated before the joins, which keeps a URL (or site) that
owns a large share of the rows from landing in one task.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions import html as H
from forecourt.functions.text import decode_entities
from forecourt.functions.urls import location_from_url
from forecourt.session import days, instant

# Class names that the pages use.
LISTING_LINK_CLASS = "posting-title"
SITE_LIST_CLASS = "geo-site-list-container"


def hrefs(page: Column, css_class: str | None = None) -> Column:
    """Decoded ``href`` of every anchor that has one, in page order."""
    conditions = [H.by_class(css_class)] if css_class else []
    has_href = H.has_attribute("href")
    tags = F.regexp_extract_all(page, F.lit(H.opening_tag("a", *conditions, has_href)), F.lit(0))
    return F.transform(
        F.transform(tags, lambda tag: H.attribute_source(tag, "href")), decode_entities
    )


def listing_links(
    result_pages: DataFrame, css_class: str | None = LISTING_LINK_CLASS
) -> DataFrame:
    """Listing URLs on search-result pages, without those of neighbouring sites.

    In: ``location, page_no, html``.  Out: ``location, page_no, pos, url``, one row per
    anchor whose address contains the page's location.  ``css_class=None`` takes any anchor.
    """
    return (
        result_pages.select(
            "location",
            "page_no",
            F.posexplode(hrefs(H.strip_scripts(H.strip_comments(F.col("html"))), css_class)).alias("pos", "url"),
        )
        .filter(F.col("url").contains(F.col("location")))
    )


def stored_links(result_pages: DataFrame, scratch: str, css_class: str | None = LISTING_LINK_CLASS) -> DataFrame:
    """``listing_links`` written once under ``scratch``, a shared folder, so that pages are searched once."""
    links = listing_links(result_pages, css_class)
    folder = f"{scratch.rstrip('/')}/links-{uuid.uuid4().hex}"
    links.write.parquet(folder)
    return result_pages.sparkSession.read.schema(links.schema).parquet(folder)


def site_directory(directory_pages: DataFrame) -> DataFrame:
    """Sites listed in the directory block: ``location, url``.

    In: ``page_no, html``.  If a location is listed repeatedly, the last one holds.
    """
    page = H.strip_scripts(H.strip_comments(F.col("html")))
    found = H.elements_of_any_depth(page, "div", H.by_class(SITE_LIST_CLASS))
    block = F.coalesce(F.try_element_at(found, F.lit(1)), F.lit(""))
    anchors = directory_pages.select(
        "page_no", F.posexplode(hrefs(block)).alias("pos", "url")
    )
    return (
        anchors.withColumn("location", location_from_url(F.col("url")))
        .groupBy("location")
        .agg(F.max(F.struct("page_no", "pos", "url"))["url"].alias("url"))
    )


def crawl_new_links(result_pages: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Links gathered from each site before its result pages stop bringing new ones.

    A site's pages are read in ``page_no`` order up to the first that has no link, or only
    links seen on its earlier pages.  Out: ``location, page_no, pos, url`` of pages read.
    ``links`` passes in links already extracted (``stored_links``): the pages are then only asked for their numbers.
    """
    if links is None:
        links = listing_links(result_pages)
    first_seen = links.groupBy("location", "url").agg(F.min("page_no").alias("page_no"))
    productive = first_seen.select("location", "page_no").distinct()
    stops = (
        result_pages.select("location", "page_no")
        .distinct()
        .join(productive, ["location", "page_no"], "left_anti")
        .groupBy("location")
        .agg(F.min("page_no").alias("stop_page"))
    )
    return (
        links.join(stops, "location", "left")
        .filter(F.col("stop_page").isNull() | (F.col("page_no") < F.col("stop_page")))
        .drop("stop_page")
    )


def recent_urls(
    raw: DataFrame, frontier: DataFrame, as_of: dt.datetime | str, window_days: int = 30
) -> DataFrame:
    """URLs not to queue again: pulled in the last days, or already in the frontier."""
    pulled = raw.schema["datetime_pulled"].dataType
    since = F.date_trunc("day", instant(as_of)).cast(pulled) - days(window_days)
    fresh = raw.filter(F.col("datetime_pulled") > since).select("url")
    return fresh.union(frontier.select("url")).distinct()


def new_links(
    links: DataFrame, seen: DataFrame, as_of: dt.datetime | str
) -> DataFrame:
    """Frontier rows for links not seen before: ``url, location, row_created``.

    A link found on several pages is queued once, for the page that came first.
    """
    once = links.groupBy("url").agg(
        F.min(F.struct("page_no", "location"))["location"].alias("location")
    )
    return once.join(seen.select("url").distinct(), "url", "left_anti").select(
        "url", "location", instant(as_of).alias("row_created")
    )


def not_harvested(frontier: DataFrame, raw: DataFrame) -> DataFrame:
    """Frontier rows whose URL has no raw page yet.

    Also what is left of the frontier once harvested rows are deleted.  A NULL URL among
    the raw pages does not hide the whole frontier, as ``NOT IN`` would.
    """
    return frontier.join(raw.select("url").distinct(), "url", "left_anti")


def frontier_cleanup(frontier: DataFrame, raw: DataFrame) -> DataFrame:
    return not_harvested(frontier, raw)


def harvest_batch(frontier: DataFrame, raw: DataFrame, limit: int | None = 130) -> DataFrame:
    """The next URLs to fetch: the ``limit`` oldest (equal ages by URL), or all with None.

    A URL that is queued several times is fetched once, for its oldest row.
    """
    left = not_harvested(frontier, raw).groupBy("url").agg(F.min(F.struct("row_created", "location")).alias("first"))
    left = left.select("url", "first.location", "first.row_created")
    if limit is not None:
        left = left.orderBy("row_created", "url", "location").limit(limit)
    return left.select("url", "location")


def parse_backlog(raw: DataFrame, processed: DataFrame, latest_only: bool = True) -> DataFrame:
    """URLs to parse: never parsed, or parsed but flagged for another pass.

    With ``latest_only`` the flag of a URL's most recent parse decides, so that a repeated
    parse clears it; otherwise any flagged row ever written keeps the URL in the backlog.
    """
    if latest_only:
        last = processed.groupBy("url").agg(
            F.max(F.struct("basic_processed_time", "needs_basic_parsing"))[
                "needs_basic_parsing"
            ].alias("flagged")
        )
        flagged = last.filter("flagged").select("url")
    else:
        flagged = processed.filter("needs_basic_parsing").select("url")
    parsed = processed.select("url").distinct()
    fresh = raw.select("url").distinct().join(parsed, "url", "left_anti")
    return flagged.union(fresh).distinct()


def parse_batch(backlog: DataFrame, limit: int | None = 2500, seed: int = 41) -> DataFrame:
    """A repeatable random choice of ``limit`` URLs, whatever the partitioning; None: all."""
    urls = backlog.select("url")
    if limit is None:
        return urls
    draw = F.md5(F.concat(F.lit(str(seed)), F.col("url")))
    return urls.orderBy(draw, "url").limit(limit)


def latest_listings(listings: DataFrame, only: Column | None = None) -> DataFrame:
    """Of each URL the row of its most recent parse; the table keeps every parse ever made.

    Where the table tells when a page was pulled (``datetime_pulled``), the latest pull of that parse counts.
    Rows equal in both are told apart by a hash of the whole row, so the choice does not depend on the
    partitioning.  The latest time per URL is a narrow aggregate over all parses, joined back on URL and time;
    ``only`` limits the rows joined to it, and so the files of a table laid out by day.
    """
    times = ["basic_processed_time", *(["datetime_pulled"] if "datetime_pulled" in listings.columns else [])]
    last = listings.groupBy("url").agg(F.max(F.struct(*times)).alias("_last")).select(F.col("url").alias("_url"), "_last")
    rows = listings if only is None else listings.filter(only)
    match = F.col("url").eqNullSafe(F.col("_url"))
    for t in times:
        match = match & F.col(t).eqNullSafe(F.col(f"_last.{t}"))
    met = rows.join(last, match).select(F.struct(*[F.col(f"`{c}`") for c in listings.columns]).alias("row"))
    one = met.groupBy("row.url").agg(F.max_by("row", F.xxhash64("row")).alias("row"))
    return one.select("row.*")


def latest_pulls(raw: DataFrame) -> DataFrame:
    """Of each URL the raw pages of its latest pull, found from times alone."""
    last = raw.groupBy(F.col("url").alias("_url")).agg(F.max("datetime_pulled").alias("_last"))
    match = F.col("url").eqNullSafe(F.col("_url")) & F.col("datetime_pulled").eqNullSafe(F.col("_last"))
    return raw.join(last, match, "left_semi")


def pages_to_parse(raw: DataFrame, batch: DataFrame) -> DataFrame:
    """Raw pages of a chosen batch of URLs."""
    return raw.join(batch.select("url").distinct(), "url", "left_semi")

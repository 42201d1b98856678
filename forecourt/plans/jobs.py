"""Batch jobs over stored tables, one per step of the pipeline.

Each reads tables, appends or replaces one, writes a run-log row when ``log`` is given and
returns the number of rows written.  Nothing is collected to the driver.

With ``run``, the name of this run of the job, tables are written by runs (``sources.runs``): listings by
day of posting, pages by day of pulling.  A job repeated under the same name adds nothing and reports
what it did the first time.  Tables written so are read so, whoever reads them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from forecourt.operators.extract import lacking, parse_listings, parse_stored
from forecourt.operators.frontier import (
    crawl_new_links,
    frontier_cleanup,
    harvest_batch,
    latest_listings,
    latest_pulls,
    new_links,
    pages_to_parse,
    parse_backlog,
    parse_batch,
    recent_urls,
    stored_links,
)
from forecourt.operators.regression import fit_models
from forecourt.operators.scoring import hot_deals
from forecourt.operators.summaries import cells_of_run, fit_from_cells
from forecourt.operators.training import fit_set
from forecourt.schemas import CELLS, FRONTIER, HOT_DEALS, LISTINGS, MODELS, RAW_PAGES
from forecourt.session import days, instant
from forecourt.sources.runs import Written, append_run, drop_folder, drop_old, read_runs, replace_runs, since_day, snapshot
from forecourt.sources.tables import append_table, conform, log_run, overwrite_table, read_table

__all__ = [
    "clean_frontier", "fit_price_models", "harvest_pages", "parse_pages", "refit_price_models", "score_deals",
    "summarise_run", "update_frontier",
]


def _logged(spark, log, task, started, notes, host=""):
    if log:
        suffix = f" on {host}" if host else ""
        finished = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        log_run(spark, log, task, started, finished, notes + suffix)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _read(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """A table with the columns of ``schema``; one written by runs has ``run`` and ``day`` besides."""
    if "/" in table and (now := snapshot(spark, table)).generation:
        return read_runs(spark, table, schema, at=now)
    return read_table(spark, table, schema=schema)


def _append(
    df: DataFrame, table: str, schema: StructType, run: str | None, day: str | None = None,
    counts: dict[str, Column] | None = None, bucket_by: tuple[str, int] | None = None,
) -> Written:
    if run is None:
        return Written(append_table(conform(df, schema), table, bucket_by=bucket_by))
    return append_run(df, table, run, schema, day, counts)


def _own_folder(scratch: str | None) -> str | None:
    """A folder of this run of a job below the caller's; the job removes it when its rows are written."""
    return scratch and f"{scratch.rstrip('/')}/job-{uuid.uuid4().hex}"


def _told(written: Written, what: str) -> str:
    counts = "".join(f", {k}={v}" for k, v in sorted(written.counts.items()))
    return f"{written.rows} {what}{counts}{' (repeated)' if written.repeated else ''}"


def update_frontier(
    spark: SparkSession, result_pages: DataFrame, raw: str, frontier: str, as_of,
    log: str | None = None, host: str = "", bucket_by: tuple[str, int] | None = None, run: str | None = None,
    scratch: str | None = None,
) -> int:
    """Queue links of crawled result pages that were not seen lately.

    ``scratch`` names a shared folder for the links, so that each page is searched once.
    """
    started = _now()
    seen = recent_urls(
        _read(spark, raw, RAW_PAGES).select("url", "datetime_pulled"),
        _read(spark, frontier, FRONTIER).select("url"),
        as_of,
    )
    own = _own_folder(scratch)
    links = stored_links(result_pages, own) if own else None
    fresh = new_links(crawl_new_links(result_pages, links), seen, as_of)
    written = _append(fresh, frontier, FRONTIER, run, bucket_by=bucket_by)
    if own:
        drop_folder(spark, own)
    _logged(spark, log, "update_frontier", started, _told(written, "new URLs queued"), host)
    return written.rows


def harvest_pages(
    spark: SparkSession, fetched: DataFrame, frontier: str, raw: str, as_of,
    limit: int | None = None, log: str | None = None, host: str = "",
    bucket_by: tuple[str, int] | None = None, run: str | None = None,
) -> int:
    """Store fetched pages (``url, raw_html``) of queued URLs: all, or the oldest ``limit``."""
    started = _now()
    queue = _read(spark, frontier, FRONTIER)
    pulled = _read(spark, raw, RAW_PAGES).select("url")
    batch = harvest_batch(queue, pulled, limit)
    pages = fetched.join(batch, "url").withColumn("datetime_pulled", instant(as_of))
    written = _append(pages, raw, RAW_PAGES, run, "datetime_pulled", bucket_by=bucket_by)
    _logged(spark, log, "harvest_pages", started, _told(written, "pages stored"), host)
    return written.rows


def clean_frontier(
    spark: SparkSession, frontier: str, raw: str, target: str | None = None,
    bucket_by: tuple[str, int] | None = None, run: str | None = None, log: str | None = None, host: str = "",
) -> int:
    """Take harvested URLs out of the frontier; returns how many are left.

    With ``run`` the frontier's own contents are replaced: readers see the old ones until the new ones are
    whole, and the generation before stays for readers that have begun.  Otherwise what is left goes to
    ``target``, a table of its own.
    """
    started = _now()
    pulled = _read(spark, raw, RAW_PAGES).select("url")
    if run is None:
        if target is None:
            raise ValueError("name a target table, or a run to replace the frontier in place")
        left = frontier_cleanup(_read(spark, frontier, FRONTIER), pulled).select(*FRONTIER.fieldNames())
        written = Written(overwrite_table(left, target, FRONTIER, bucket_by=bucket_by))
    else:
        now = snapshot(spark, frontier)
        left = frontier_cleanup(read_runs(spark, frontier, FRONTIER, at=now), pulled)
        written = replace_runs(left, frontier, run, FRONTIER, read_at=now)
        drop_old(spark, frontier, keep=2)
    _logged(spark, log, "clean_frontier", started, _told(written, "URLs left"), host)
    return written.rows


def parse_pages(
    spark: SparkSession, raw: str, dictionary: DataFrame, listings: str, as_of,
    limit: int | None = None, log: str | None = None, host: str = "",
    bucket_by: tuple[str, int] | None = None, run: str | None = None, scratch: str | None = None,
) -> int:
    """Parse backlog pages into the listings table: all, or a random choice of ``limit``.

    The backlog comes from url columns alone and is semi-joined to the pages before anything
    is read from their text, so the cost of parsing follows the backlog.  Bucket the page
    table on ``url`` and the join moves no page.  Of a URL that was pulled repeatedly the latest pull is
    parsed.  ``scratch`` names a shared folder for the extracted fields, so that each page is read once.
    How many listings lack a field is counted in the pass that writes them.
    """
    started = _now()
    pages = _read(spark, raw, RAW_PAGES)
    known = _read(spark, listings, LISTINGS).select("url", "needs_basic_parsing", "basic_processed_time")
    backlog = parse_backlog(pages.select("url"), known)
    chosen = latest_pulls(pages_to_parse(pages, parse_batch(backlog, limit)))
    own = _own_folder(scratch)
    rows = parse_stored(chosen, dictionary, as_of, own) if own else parse_listings(chosen, dictionary, as_of)
    written = _append(rows, listings, LISTINGS, run, "time_posted", lacking(), bucket_by)
    if own:
        drop_folder(spark, own)
    _logged(spark, log, "parse_pages", started, _told(written, "listings written"), host)
    return written.rows


def fit_price_models(
    spark: SparkSession, listings: str, models: str, as_of, log: str | None = None,
    host: str = "", constant_predictor: str = "absorb", lookback_days: int = 180, **options,
) -> int:
    """Refit every price model and replace the model table."""
    started = _now()
    rows = _read(spark, listings, LISTINGS)
    since = instant(as_of) - days(lookback_days)
    latest = latest_listings(rows, (F.col("time_posted") >= since) & since_day(rows, since))
    training = fit_set(latest, as_of, lookback_days, **options)
    n = overwrite_table(fit_models(training, constant_predictor), models, MODELS)
    _logged(spark, log, "fit_price_models", started, f"{n} models written", host)
    return n


def summarise_run(spark: SparkSession, listings: str, cells: str, run: str, log: str | None = None, host: str = "") -> int:
    """Store the cells (``operators.summaries``) of one run of the listings table, under the same name.

    Listings that the run parsed again are taken out of the cells they were in.  A run that is
    summarised already is left alone.  Runs may be summarised in any order, one at a time.
    """
    started = _now()
    done = set(snapshot(spark, cells).runs)
    now = snapshot(spark, listings)
    if run not in now.runs:
        raise ValueError(f"{listings} has no run {run!r}")
    before, added = (read_runs(spark, listings, LISTINGS, at=now, runs=names) for names in (sorted(done - {run}), [run]))
    written = append_run(cells_of_run(before, added), cells, run, CELLS, "posted", unit="month")
    _logged(spark, log, "summarise_run", started, _told(written, "cells stored"), host)
    return written.rows


def refit_price_models(
    spark: SparkSession, cells: str, models: str, as_of, log: str | None = None, host: str = "",
    lookback_days: int = 180, **options,
) -> int:
    """``fit_price_models`` from stored cells: the listings are not read."""
    started = _now()
    stored = read_runs(spark, cells, CELLS)
    n = overwrite_table(fit_from_cells(stored, as_of, lookback_days, **options), models, MODELS)
    _logged(spark, log, "refit_price_models", started, f"{n} models written", host)
    return n


def score_deals(
    spark: SparkSession, listings: str, states: str, models: str, target: str, as_of,
    log: str | None = None, host: str = "", window_days: int = 45, **filters,
) -> int:
    """Score recent listings and replace the scored table, newest first."""
    started = _now()
    rows = _read(spark, listings, LISTINGS)
    since = instant(as_of) - days(window_days)
    latest = latest_listings(rows, (F.col("time_posted") >= since) & since_day(rows, since))
    scored = hot_deals(
        latest, read_table(spark, states), read_table(spark, models), as_of, window_days=window_days, **filters,
    )
    n = overwrite_table(scored, target, HOT_DEALS)
    _logged(spark, log, "score_deals", started, f"{n} listings scored", host)
    return n

"""Expected prices for recent listings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions.pricing import predicted_price
from forecourt.schemas import HOT_DEALS
from forecourt.session import days, instant
from forecourt.sources.runs import since_day


def recent_listings(
    listings: DataFrame,
    as_of: dt.datetime | str,
    window_days: int = 45,
    price_range: tuple[float, float] = (250, 75_000),
    odometer_range: tuple[float, float] = (0, 300_000),
    year_span: tuple[int, int] = (50, 1),
) -> DataFrame:
    """Recently posted listings with plausible price, mileage and year (ranges exclusive).

    Of a table laid out by day only the files of the window are read.
    """
    posted = listings.schema["time_posted"].dataType
    price, odometer, year = F.col("price"), F.col("odometer"), F.col("year")
    this_year = F.year(instant(as_of))
    since = instant(as_of, posted) - days(window_days)
    return listings.filter(
        (F.col("time_posted") >= since) & since_day(listings, since)
        & (price > price_range[0]) & (price < price_range[1])
        & (odometer > odometer_range[0]) & (odometer < odometer_range[1])
        & (year >= this_year - year_span[0]) & (year <= this_year + year_span[1])
    )


def with_state(listings: DataFrame, states: DataFrame) -> DataFrame:
    """Add ``state``; listings from a location without one are left out."""
    lookup = states.groupBy(F.col("region").alias("location")).agg(
        F.min("state").alias("state")
    )
    return listings.join(lookup, "location")


def with_prediction(listings: DataFrame, models: DataFrame) -> DataFrame:
    """Add model columns and ``predicted_price``, NULL where there is no model."""
    c = F.col
    return listings.join(models, ["make", "model"], "left").withColumn(
        "predicted_price",
        predicted_price(
            c("odometer"), c("condition"), c("year"), c("intercept"),
            c("miles_coeff"), c("condition_coeff"), c("year_coeff"),
        ),
    )


def score_listings(
    listings: DataFrame, states: DataFrame, models: DataFrame, as_of, **filters
) -> DataFrame:
    """Recent listings with state and expected price, unordered."""
    recent = recent_listings(listings, as_of, **filters)
    return with_prediction(with_state(recent, states), models).select(*HOT_DEALS.fieldNames())


def hot_deals(
    listings: DataFrame, states: DataFrame, models: DataFrame, as_of, **filters
) -> DataFrame:
    """Scored listings, newest first; equal times are ordered by URL."""
    scored = score_listings(listings, states, models, as_of, **filters)
    return scored.orderBy(F.col("time_posted").desc(), "url")


def best_deals(scored: DataFrame) -> DataFrame:
    """Listings priced below expectation, with the discount in money and as a share."""
    discount = F.col("predicted_price") - F.col("price")
    return scored.filter(discount > 0).withColumns(
        {
            "discount": discount,
            "discount_pct": F.try_divide(discount, F.col("predicted_price")),
        }
    )


def best_deals_per_model(scored: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best deals of each make and model by discount, with ``rank`` 1 to k; equal ones by URL.

    Every task keeps its own k best of a model before anything is shuffled, so what meets in one task is k rows
    for each task, however many listings the model has.
    """
    best = Window.partitionBy("make", "model").orderBy(F.desc("discount"), "url")
    return best_deals(scored).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

"""Training set of the price models: recent complete listings, trimmed of price outliers.

Group sizes and price quantiles come from one aggregation with map-side partials and are
joined back, rather than from windows: a make and model owning a third of all listings is
then spread over all tasks instead of being one window partition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions.pricing import FIT_LOG_OFFSET, condition_flag, log_odometer
from forecourt.session import days, instant
from forecourt.sources.runs import since_day

#: Exact while a group has no more distinct prices than this.
QUANTILE_ACCURACY = 10_000
_REQUIRED = ["make", "model", "year", "odometer", "price", "condition"]


def complete_listings(listings: DataFrame) -> DataFrame:
    """Listings with nothing important missing, predictors derived."""
    keep = F.lit(True)
    for column in _REQUIRED:
        keep = keep & F.col(column).isNotNull()
    return listings.filter(keep).select(
        "make",
        "model",
        "year",
        log_odometer(F.col("odometer"), FIT_LOG_OFFSET).alias("log_odometer"),
        "price",
        condition_flag(F.col("condition")).alias("condition_mapped"),
        "time_posted",
    )


def fit_filtered(
    listings: DataFrame, as_of: dt.datetime | str, lookback_days: int = 180
) -> DataFrame:
    """Recent listings with nothing important missing, predictors derived.

    Of a table laid out by day only the files of the window are read.
    """
    posted = listings.schema["time_posted"].dataType
    since = instant(as_of, posted) - days(lookback_days)
    return complete_listings(listings.filter((F.col("time_posted") >= since) & since_day(listings, since)))


def valid_make_models(filtered: DataFrame, min_group: int = 100) -> DataFrame:
    """Makes and models with enough listings to fit."""
    return (
        filtered.groupBy("make", "model")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_group)
    )


def valid_rows(filtered: DataFrame, min_group: int = 100) -> DataFrame:
    """Listings of the makes and models with enough of them."""
    valid = valid_make_models(filtered, min_group)
    return filtered.join(valid.select("make", "model"), ["make", "model"], "left_semi")


def _quantiles(lo: float, hi: float, accuracy: int) -> list:
    cut = F.percentile_approx("price", [lo, hi], accuracy)
    return [cut[0].alias("low_quantile"), cut[1].alias("high_quantile")]


def price_quantiles(
    rows: DataFrame, lo: float = 0.05, hi: float = 0.95, accuracy: int = QUANTILE_ACCURACY
) -> DataFrame:
    """Low and high price quantile of each make, model and year."""
    return rows.groupBy("make", "model", "year").agg(*_quantiles(lo, hi, accuracy))


def price_bounds(
    filtered: DataFrame, min_group: int = 100, lo: float = 0.05, hi: float = 0.95,
    accuracy: int = QUANTILE_ACCURACY,
) -> DataFrame:
    """Price quantiles of the groups big enough to fit, in a single pass over the listings.

    Sizes are counted per year along with the quantiles, then added up over the years;
    that window sees one row per year, not the listings.
    """
    years = filtered.groupBy("make", "model", "year").agg(
        F.count("*").alias("n"), *_quantiles(lo, hi, accuracy)
    )
    size = F.sum("n").over(Window.partitionBy("make", "model"))
    return years.withColumn("n", size).filter(F.col("n") >= min_group).drop("n")


def trim_outliers(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Listings priced strictly between the quantiles of their make, model and year."""
    keys = ["make", "model", "year"]
    return (
        rows.join(bounds, keys)
        .filter(
            (F.col("price") > F.col("low_quantile")) & (F.col("price") < F.col("high_quantile"))
        )
        .select(*rows.columns)
    )


def fit_set(
    listings: DataFrame,
    as_of: dt.datetime | str,
    lookback_days: int = 180,
    min_group: int = 100,
    lo: float = 0.05,
    hi: float = 0.95,
    accuracy: int = QUANTILE_ACCURACY,
) -> DataFrame:
    """The training set.  Group size is tested before outliers are trimmed."""
    filtered = fit_filtered(listings, as_of, lookback_days)
    return trim_outliers(filtered, price_bounds(filtered, min_group, lo, hi, accuracy))

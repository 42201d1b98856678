"""Session construction and the few session facts the transforms rely on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def build_session(app: str = "forecourt", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tested under.

    On a cluster ``master`` and sizing come from ``spark-submit``; pass nothing then.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def instant(as_of: dt.datetime | dt.date | str, like: DataType | str = "timestamp") -> Column:
    """``as_of`` as a literal of the compared column's own type, so filters push down."""
    if isinstance(as_of, dt.datetime):
        text = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    else:
        text = str(as_of)
    return F.lit(text).cast(like)


def days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))

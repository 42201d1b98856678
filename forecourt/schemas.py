"""Table schemas, in column order."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


FRONTIER = _struct(url=StringType, location=StringType, row_created=TimestampType)

RAW_PAGES = _struct(
    url=StringType, datetime_pulled=TimestampType, raw_html=StringType, location=StringType
)

STATES = _struct(region=StringType, state=StringType)

LISTINGS = _struct(
    url=StringType,
    location=StringType,
    odometer=DoubleType,
    title=StringType,
    paint=StringType,
    drive=StringType,
    cylinders=StringType,
    condition=StringType,
    fuel=StringType,
    type=StringType,
    transmission=StringType,
    vin=StringType,
    name=StringType,
    post_id=StringType,
    time_posted=TimestampType,
    year=IntegerType,
    price=DoubleType,
    posting_body_text=StringType,
    title_text=StringType,
    num_images=IntegerType,
    latitude=DoubleType,
    longitude=DoubleType,
    make=StringType,
    model=StringType,
    needs_basic_parsing=BooleanType,
    basic_processed_time=TimestampType,
    needs_ai_parsing=BooleanType,
    ai_processed_time=TimestampType,
)

#: Listings of one day that have all of this in common (``operators.summaries``).
CELLS = _struct(
    posted=DateType,
    make=StringType,
    model=StringType,
    year=IntegerType,
    price=DoubleType,
    condition=IntegerType,
    n=LongType,
    mean_o=DoubleType,
    m2_o=DoubleType,
)

MODELS = _struct(
    make=StringType,
    model=StringType,
    intercept=DoubleType,
    miles_coeff=DoubleType,
    condition_coeff=DoubleType,
    year_coeff=DoubleType,
    r_squared=DoubleType,
    sample_size=LongType,
)

HOT_DEALS = StructType(
    [
        LISTINGS["url"],
        STATES["state"],
        *(
            LISTINGS[c]
            for c in (
                "location", "time_posted", "name", "make", "model", "year", "odometer",
                "title", "paint", "drive", "cylinders", "fuel", "type", "transmission",
                "condition", "price", "title_text", "latitude", "longitude",
            )
        ),
        StructField("predicted_price", DoubleType(), True),
        MODELS["r_squared"],
        MODELS["sample_size"],
    ]
)

RUN_LOG = _struct(
    task=StringType, time_started=TimestampType, time_finished=TimestampType, notes=StringType
)

"""Expressions shared by fitting and scoring."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Condition classes, and the offsets that keep the logarithm defined.  The
# two offsets differ on purpose; scores only match the published model with both kept.
GOOD_CONDITIONS = ["new", "like new", "excellent"]
FAIR_CONDITIONS = ["good", "fair", "salvage"]
FIT_LOG_OFFSET = 1
SCORE_LOG_OFFSET = 0.1


def condition_flag(condition: Column) -> Column:
    """1 for the better conditions, 0 for the lesser ones, NULL for anything else."""
    return F.when(condition.isin(GOOD_CONDITIONS), 1).when(condition.isin(FAIR_CONDITIONS), 0)


def log_odometer(odometer: Column, offset: float) -> Column:
    return F.log(odometer + F.lit(offset))


def predicted_price(
    odometer: Column, condition: Column, year: Column, intercept: Column,
    miles_coeff: Column, condition_coeff: Column, year_coeff: Column,
) -> Column:
    """Linear price model; any missing part makes the prediction NULL."""
    return (
        intercept
        + miles_coeff * log_odometer(odometer, SCORE_LOG_OFFSET)
        + condition_coeff * condition_flag(condition)
        + year_coeff * year
    )

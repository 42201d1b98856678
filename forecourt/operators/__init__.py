"""Table-to-table transforms: lazy, with reference time and thresholds as arguments."""

"""Missing values and text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the range outside which a measurement counts as absent.
VALID_LIMIT = 1e30

WHITE_SPACE = " \t\n\r\v\f\x1c\x1d\x1e\x1f\x85\xa0"


def nan_to_null(value: Column | str) -> Column:
    """Absent floats arrive as NaN; Spark would rank and average them as numbers."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(~F.isnan(value), value)


def is_valid(value: Column | str) -> Column:
    """Has a value: not null, not NaN, not infinite."""
    value = F.col(value) if isinstance(value, str) else value
    return value.between(-VALID_LIMIT, VALID_LIMIT)


def strip(text: Column | str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.trim(text, F.lit(WHITE_SPACE))

"""Timestamps without zone. None of these depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def compact_timestamp(text: Column | str) -> Column:
    """Parse ``yyyyMMddHHmmss``; empty or malformed text gives null."""
    digits = F.trim(text)
    spaced = F.regexp_replace(
        digits, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"
    )
    return F.when(digits.rlike(r"^\d{14}$"), spaced).try_cast("timestamp_ntz")


def year_month(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def _from_epoch(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH))


def utc_ntz(instant: Column | str) -> Column:
    """UTC wall-clock time of an instant such as a file's modification time."""
    return _from_epoch(F.unix_micros(instant))


def nanoseconds_to_ntz(nanos: Column | str) -> Column:
    """Microsecond timestamp from epoch nanoseconds, rounded down."""
    nanos = F.col(nanos) if isinstance(nanos, str) else nanos
    whole = nanos - F.pmod(nanos, F.lit(1000))
    return _from_epoch(F.call_function("div", whole, F.lit(1000)))

"""Timestamps and ages."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from uttersieve.functions.text import _c


def parse_utc(col) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` to a timestamp, null where malformed.

    The zone is read from the text, so the session's zone does not matter.
    """
    c = _c(col)
    parsed = F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssX"))
    return F.when(c.endswith("Z"), parsed)


def age_days(as_of, then) -> Column:
    """Whole 24-hour periods from ``then`` to ``as_of`` (not calendar days)."""
    return F.floor((F.unix_seconds(_c(as_of)) - F.unix_seconds(_c(then))) / 86400)

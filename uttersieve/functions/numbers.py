"""Numbers and number labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from uttersieve.functions.text import _c
from uttersieve.schema import MONTHS


def to_long(col) -> Column:
    """Text to a 64-bit integer, null where it is none."""
    return _c(col).try_cast("bigint")


def hundredths(col) -> Column:
    """A non-negative double in hundredths, rounded on its exact binary value,
    ties to even (what Python's ``round(x, 2)`` and ``:.2f`` do).

    The fraction below 1 is an exact multiple of 2**-60 unless it is too small
    to round up at all, so integer arithmetic decides without error.
    """
    x = _c(col)
    mask = F.lit((1 << 30) - 1)
    whole = F.floor(x)
    scaled = ((x - whole) * F.lit(float(1 << 60))).cast("bigint")
    # 100 * scaled would overflow, so multiply the two 30-bit halves
    tail = scaled.bitwiseAND(mask) * 100
    head = F.shiftright(scaled, 30) * 100 + F.shiftright(tail, 30)
    low = F.shiftright(head, 30)
    rest = F.shiftleft(head.bitwiseAND(mask), 30).bitwiseOR(tail.bitwiseAND(mask))
    half = F.lit(1 << 59)
    up = (rest > half) | ((rest == half) & (low % 2 == 1))
    return whole.cast("bigint") * 100 + low + F.when(up, 1).otherwise(0)


def round2(col) -> Column:
    """Two places, half to even on the binary value."""
    return hundredths(col) / F.lit(100.0)


def percent_text(col) -> Column:
    """A ratio as percent text with two places, e.g. ``59.70%``."""
    h = hundredths(_c(col) * 100)
    return F.when(
        h.isNotNull(),
        F.format_string("%d.%02d%%", F.floor(h / 100).cast("bigint"), h % 100),
    )


def has_digit(col) -> Column:
    return _c(col).rlike("[0-9]")


def label_digits(col) -> Column:
    """The digits of a label, read as one integer."""
    return F.regexp_replace(_c(col), "[^0-9]", "").try_cast("bigint")


def label_value(col, mode="digits") -> Column:
    """Value of an axis label such as ``12M``.

    ``digits`` multiplies the label's digits by its unit (so ``12.4M`` reads
    124 million); ``decimal`` reads the decimal point.
    """
    c = _c(col)
    unit = (
        F.when(c.contains("M"), F.lit(1_000_000))
        .when(c.contains("B"), F.lit(1_000_000_000))
        .otherwise(F.lit(1))
        .cast("bigint")
    )
    if mode == "digits":
        return label_digits(c) * unit
    number = F.regexp_extract(c, r"[0-9]+(?:\.[0-9]+)?", 0).try_cast("decimal(20,6)")
    return F.round(number * unit, 0).cast("bigint")


def month_label(col, year="2022") -> Column:
    """``YYYY.MM`` for a label naming a month, null where it names none."""
    c = _c(col)
    y = F.lit(year) if isinstance(year, str) else year
    number = F.lit(None).cast("int")
    # the last month named wins, as for any map filled in calendar order
    for i, name in enumerate(MONTHS, start=1):
        number = F.when(c.contains(name), F.lit(i)).otherwise(number)
    return F.when(
        number.isNotNull() & (F.length(y) == 4), F.format_string("%s.%02d", y, number)
    )

"""Text shapes of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date shape, open-end mark and blanks that count as blank.
LONG_DATE = "MMM dd, yyyy"
OPEN_END = "N/A"
EDGE_BLANKS = r"(?U)^\s+|\s+$"


def clean(text: Column) -> Column:
    """Lower case without blanks (of any Unicode kind) at either end."""
    return F.lower(F.regexp_replace(text, EDGE_BLANKS, ""))


def yes(text: Column) -> Column:
    """True for "yes", false for anything else and for nothing."""
    return F.coalesce(text == "yes", F.lit(False))


def long_date(day: Column) -> Column:
    """For example `Sep 15, 2020`."""
    return F.date_format(day, LONG_DATE)


def long_date_or_open(day: Column) -> Column:
    """A long date, or the mark for a term without an end."""
    return F.coalesce(long_date(day), F.lit(OPEN_END))


def money(amount: Column) -> Column:
    """Two decimals of the stored binary value, not of its shortest decimal form.

    2.675 is stored as a little less, so it gives 2.67. Exact halves go to the even cent.
    Splitting the amount into a 26-bit head and the rest makes both products exact, and so
    the side of the half on which the amount lies. Amounts of 10^12 and more, whose cents
    are few, are rounded in decimal form.
    """
    size = F.abs(amount)
    shifted = size * F.lit(134217729.0)  # 2^27 + 1
    head = shifted - (shifted - size)
    cents = F.floor(size * 100)
    over_half = (head * 100 - (cents + F.lit(0.5))) + (size - head) * 100
    up = F.when(over_half == 0, cents % 2).otherwise((over_half > 0).cast("bigint"))
    whole = cents + up
    exact = F.concat(
        F.when(F.signum(amount) < 0, F.lit("-")).otherwise(F.lit("")),
        F.format_string("%d.%02d", F.floor(whole / 100), whole % 100),
    )
    rounded = F.format_string("%.2f", F.bround(amount, 2))
    return F.when(size < F.lit(1e12), exact).otherwise(rounded)


def plain_number(number: Column) -> Column:
    """A number's digits without an exponent, with at least one decimal."""
    short = number.cast("string")
    long = F.rtrim(number.try_cast("decimal(38,12)").cast("string"), F.lit("0"))
    written = F.when(F.endswith(long, F.lit(".")), F.concat(long, F.lit("0"))).otherwise(long)
    return F.when(F.contains(short, F.lit("E")), F.coalesce(written, short)).otherwise(short)

"""Days as bits of one long per span of days.

A user's active days in a span are one row, however many days and batches they come from, and rows of
one span are merged by `bit_or`. A range of days is a mask as well, for the spans that it cuts.
"""

from datetime import date

from pyspark.sql import functions as F

SPAN_DAYS = 60
_FIRST = date(1970, 1, 1)


def _number(day):
    return F.unix_date(day)


def span_of(day):
    return F.floor(_number(day) / SPAN_DAYS).cast("bigint")


def day_bit(day):
    place = F.pmod(_number(day), F.lit(SPAN_DAYS)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def spans_between(first, last):
    """First and last span that a range of days touches."""
    return (first - _FIRST).days // SPAN_DAYS, (last - _FIRST).days // SPAN_DAYS


def days_between(days, span, first, last):
    """The bits of a span's mask that lie between two days, both included."""
    start = span * SPAN_DAYS
    low = F.greatest(F.lit((first - _FIRST).days) - start, F.lit(0))
    high = F.least(F.lit((last - _FIRST).days) - start, F.lit(SPAN_DAYS - 1))
    one = F.lit(1).cast("bigint")

    def below(place):
        """Bits of the places before one."""
        return F.call_function("shiftleft", one, place.cast("int")) - one

    inside = F.when(high >= low, below(high + 1) - below(low)).otherwise(F.lit(0).cast("bigint"))
    return days.bitwiseAND(inside)

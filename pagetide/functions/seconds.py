"""Distinct whole seconds as a 60-bit mask per minute.

Plain distinct (time, domain, bot) rows shuffle every second that a map task saw. Event times are
whole seconds, so the seconds of one minute fit in one long: rows are first folded to one long per
minute on the map side, in a hash aggregate, and only those are shuffled.
"""

from pyspark.sql import functions as F


def second_bit(time):
    second = F.pmod(F.unix_timestamp(time), F.lit(60)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), second)


def seconds_mask(time):
    return F.bit_or(second_bit(time))


def seconds_in(mask):
    return F.bit_count(mask).cast("bigint")


def distinct_seconds(rows, time, others):
    """Distinct (time, others) rows, with one shuffled row per minute instead of per second."""
    minutes = rows.groupBy(F.date_trunc("minute", time).alias("minute"), *others).agg(
        seconds_mask(F.col(time)).alias("seconds")
    )
    # All seconds of the minute, and then those that are set: both in generated code.
    every = minutes.withColumn("second", F.explode(F.sequence(F.lit(0), F.lit(59))))
    seen = every.filter(F.call_function("getbit", F.col("seconds"), F.col("second")) == 1)
    start = F.unix_timestamp("minute")
    return seen.select(F.timestamp_seconds(start + F.col("second")).alias(time), *others)

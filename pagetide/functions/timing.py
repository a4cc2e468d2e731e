"""Time columns and the report window."""

from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import functions as F

from pagetide.schemas import FEED_TIME_FORMAT, HOUR_LABEL_FORMAT


class Bounds(NamedTuple):
    """Half-open window: `start` is inside, `end` is not. Both are zone-aware UTC."""

    start: datetime
    end: datetime

    @property
    def seconds(self):
        return int((self.end - self.start).total_seconds())

    @property
    def days(self):
        """First and last day the window touches."""
        return self.start.date(), (self.end - timedelta(microseconds=1)).date()


def as_utc(moment):
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def as_day(day):
    return date.fromisoformat(day) if isinstance(day, str) else day


def report_bounds(as_of, hours=7, lag_hours=1):
    """The `hours` full hours that end `lag_hours` before the hour of `as_of`."""
    this_hour = as_utc(as_of).replace(minute=0, second=0, microsecond=0)
    end = this_hour - timedelta(hours=lag_hours)
    return Bounds(end - timedelta(hours=hours), end)


def in_window(rows, bounds, column="time"):
    if bounds is None:
        return rows
    return rows.filter(
        (F.col(column) >= F.lit(bounds.start)) & (F.col(column) < F.lit(bounds.end))
    )


def feed_time(text, formats=(FEED_TIME_FORMAT,)):
    """Whole-second timestamp; null, never an error, when no format fits."""
    tries = [F.try_to_timestamp(text, F.lit(pattern)) for pattern in formats]
    return F.date_trunc("second", F.coalesce(*tries))


def hour_of(time):
    return F.date_trunc("hour", time)


def hour_end(hour):
    return hour + F.expr("INTERVAL 1 HOUR")


def hour_label(moment):
    return F.date_format(moment, HOUR_LABEL_FORMAT)

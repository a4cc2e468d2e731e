"""Windowed reports over the time-keyed views, or over partial aggregates of them.

Grain decides what "pages created" counts. `KEYED` counts view rows: pages made in one domain in
the same second by the same kind of user are one row, and so are one user's pages in one second.
`EVENT` counts every event. Keyed reports give the same result on events, on unmerged view rows
and on merged ones.
"""

from pyspark.sql import Window, functions as F

from pagetide.functions.seconds import seconds_in
from pagetide.functions.timing import hour_of, in_window
from pagetide.operators.views import (
    DOMAIN_MINUTES,
    SPECS,
    USER_MINUTES,
    build,
    merge,
    project,
    without_values,
)
from pagetide.schemas import PAGE_CREATE

KEYED = "keyed"
EVENT = "event"

def _check_grain(grain, rows):
    """Events are told apart by all their columns; rows of a view have been merged already."""
    if grain not in (KEYED, EVENT):
        raise ValueError(f"grain is {KEYED!r} or {EVENT!r}, not {grain!r}")
    if grain == EVENT and not set(PAGE_CREATE) <= set(rows.columns):
        raise ValueError("rows of a view do not hold every event; read the event log")


def _domain_rows(rows, bounds):
    return in_window(rows, bounds).dropna(subset=list(SPECS["domain_page_stats"].key))


def hourly_domain_stats(rows, bounds=None, grain=KEYED):
    """Pages created per hour and domain. Hours without pages have no rows."""
    _check_grain(grain, rows)
    rows = _domain_rows(rows, bounds)
    if grain == EVENT:
        return rows.groupBy(hour_of(F.col("time")).alias("hour"), "domain").agg(
            F.count(F.lit(1)).alias("pages_created")
        )
    return hourly_of_minutes(merge(project(rows, DOMAIN_MINUTES), DOMAIN_MINUTES))


def hourly_of_minutes(minutes):
    """The hourly report of merged minutes; masks say how many seconds have pages."""
    return minutes.groupBy(hour_of(F.col("minute")).alias("hour"), "domain").agg(
        F.sum(seconds_in(F.col("seconds"))).alias("pages_created")
    )


def bot_domain_stats(rows, bounds=None, grain=KEYED):
    """Pages created by bots per domain."""
    _check_grain(grain, rows)
    rows = _domain_rows(rows, bounds).filter("created_by_bot")
    if grain == EVENT:
        return rows.groupBy("domain").agg(F.count(F.lit(1)).alias("created_by_bots"))
    return bots_of_minutes(merge(project(rows, DOMAIN_MINUTES), DOMAIN_MINUTES))


def bots_of_minutes(minutes):
    """The report on bots of merged minutes."""
    return minutes.filter("created_by_bot").groupBy("domain").agg(
        F.sum(seconds_in(F.col("seconds"))).alias("created_by_bots")
    )


def _user_rows(rows, grain):
    spec = SPECS["user_stat"]
    if grain == KEYED:
        return build(rows, spec)
    return rows.dropna(subset=list(spec.key)).select(*spec.columns)


def user_counts(rows, minutes=None):
    """Rows of the user view per (user_id, username), counted in hash aggregates.

    `minutes` are the merged partial aggregates of the same rows, where they are stored.

    Seconds are folded to a mask per user, name and minute, and the masks are the counts where no
    second of a user has two names. A look at the distinct names, few beside the rows, tells whether
    any user has several. If so, minutes in which a second has two names are merged row by row to
    find the name that wins.
    """
    rows = rows.dropna(subset=["time", "user_id"]).withColumn(
        "minute", F.date_trunc("minute", "time")
    )
    named = rows if minutes is None else minutes
    if minutes is None:
        minutes = merge(project(rows, USER_MINUTES), USER_MINUTES)
    pages = seconds_in(F.col("seconds"))
    names = named.select("user_id", "username").distinct()
    if names.groupBy("user_id").count().filter("count > 1").isEmpty():
        return minutes.groupBy("user_id", "username").agg(F.sum(pages).alias("pages_created"))

    both = ["user_id", "minute"]
    several = (
        minutes.groupBy(*both)
        .agg(F.sum(pages).alias("named"), seconds_in(F.bit_or("seconds")).alias("seen"))
        .filter("named > seen")
        .select(*both)
    )
    plain = minutes.join(several, both, "left_anti").select(
        "user_id", "username", pages.alias("pages")
    )
    spec = without_values("user_stat", "page_title")
    contested = build(rows.join(several, both, "left_semi"), spec).select(
        "user_id", "username", F.lit(1).cast("bigint").alias("pages")
    )
    return (
        plain.union(contested)
        .groupBy("user_id", "username")
        .agg(F.sum("pages").alias("pages_created"))
    )


def top_users(rows, bounds=None, n=20, grain=KEYED, minutes=None):
    """The `n` most active (user_id, username) pairs and their rank.

    Ties go to the lower id, then name. With `minutes`, stored partial aggregates of the window, rows
    are read only where a user has two names in one second.
    """
    _check_grain(grain, rows)
    if n <= 0:
        raise ValueError("n must be positive")
    rows = in_window(rows, bounds)
    if grain == KEYED:
        counts = user_counts(rows, minutes)
    else:
        counts = rows.dropna(subset=["time", "user_id"]).groupBy("user_id", "username").agg(
            F.count(F.lit(1)).alias("pages_created")
        )
    order = [F.desc("pages_created"), "user_id", "username"]
    top = counts.orderBy(*order).limit(n)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        "user_id",
        "username",
        "pages_created",
    )


def top_user_titles(rows, bounds=None, n=20, grain=KEYED, minutes=None):
    """The report in long form: one row per top user and page title, of any length.

    Users are counted without titles first. Only rows of the winners are then merged with their
    titles; Spark sizes the joins.
    """
    top = top_users(rows, bounds, n, grain, minutes)
    ids = top.select("user_id").distinct()
    titles = _user_rows(in_window(rows, bounds).join(ids, "user_id", "left_semi"), grain)
    named = titles.select(
        F.col("user_id").alias("title_user"), F.col("username").alias("title_name"), "page_title"
    )
    same_user = (F.col("title_user") == F.col("user_id")) & F.col("title_name").eqNullSafe(
        F.col("username")
    )
    return named.join(top, same_user).select(
        "rank", "user_id", "username", "pages_created", "page_title"
    )

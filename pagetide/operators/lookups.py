"""Lookups by key. A list of keys is a filter, a DataFrame of keys is a join.

No side is broadcast by hint: the filter of a list reaches the scan, and for a DataFrame of keys,
which may be of any size, Spark picks the join.
"""

from pyspark.sql import DataFrame, Window, functions as F

from pagetide.functions.days import days_between, spans_between
from pagetide.functions.timing import as_day
from pagetide.operators.views import with_day


def _key_frame(rows, keys, name):
    if isinstance(keys, DataFrame):
        return keys.select(F.col(keys.columns[0]).alias(name)).dropna().distinct()
    kind = rows.schema[name].dataType.simpleString()
    values = [(key,) for key in set(keys) if key is not None]
    return rows.sparkSession.createDataFrame(values, f"{name} {kind}")


def _thinned(keys, name):
    """Keys with few repeats, for a semi join, which ignores repeats.

    Leaving up to 16 copies of a key keeps the final aggregate off the join input. With it there,
    Spark could not split the other side where one key has most of the rows.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(16))
    named = keys.select(F.col(keys.columns[0]).alias(name)).dropna()
    return named.withColumn("part", part).distinct().drop("part")


def _narrowed(rows, keys, name):
    """Rows cut down by a filter that reaches the scan, where the keys are a list."""
    if isinstance(keys, DataFrame):
        return rows
    return rows.filter(F.col(name).isin([key for key in set(keys) if key is not None]))


def domains(view):
    return view.select("domain").distinct()


def pages_by_user(view, users, ordered=None):
    """Pages of the users. Unknown users have no rows.

    The answer to a list is ordered by user and page id. The answer to a DataFrame may be as large
    as the view and is not sorted unless asked for.
    """
    if ordered is None:
        ordered = not isinstance(users, DataFrame)
    if isinstance(users, DataFrame):
        found = view.join(_thinned(users, "user_id"), "user_id", "left_semi")
    else:
        found = _narrowed(view, users, "user_id")
    return found.orderBy("user_id", "page_id") if ordered else found


def domain_page_count(view, names):
    """Number of pages per domain; 0 for an unknown domain.

    Pages are counted before the join, so a domain with most of the pages joins as one row.
    """
    counts = _narrowed(view, names, "domain").groupBy("domain").agg(
        F.count(F.lit(1)).alias("page_count")
    )
    return (
        _key_frame(view, names, "domain")
        .join(counts, "domain", "left")
        .select("domain", F.coalesce("page_count", F.lit(0)).cast("bigint").alias("page_count"))
    )


def page_details(view, pages):
    """Details per page; nulls beside an unknown page id."""
    return (
        _key_frame(view, pages, "page_id")
        .join(_narrowed(view, pages, "page_id"), "page_id", "left")
        .select(*view.columns)
    )


def _days(rows, start, end):
    return with_day(rows).filter(
        F.col("day").between(F.lit(as_day(start)), F.lit(as_day(end)))
    )


def user_active_days_range(view, start, end):
    """Users active between two days, both included, with their number of active days.

    `view` is page_creations_by_time. The name is the one of the first active day.
    """
    return (
        _days(view, start, end)
        .groupBy("user_id")
        .agg(
            F.min(F.struct("day", "username")).alias("first"),
            F.count(F.lit(1)).alias("page_count"),
        )
        .select("user_id", F.col("first.username").alias("username"), "page_count")
    )


def user_active_days_of_masks(masks, view, start, end):
    """The same as `user_active_days_range`, from stored masks of days.

    `view` is read for users with several names in the range only, to find the one of their first day.
    """
    first, last = as_day(start), as_day(end)
    own = days_between(F.col("days"), F.col("span"), first, last)
    spans = F.col("span").between(*spans_between(first, last))
    cut = masks.filter(spans).withColumn("days", own).filter("days <> 0")
    # Days that two names share count once.
    joined = cut.groupBy("user_id", "span").agg(
        F.bit_or("days").alias("days"), F.min("username").alias("low"), F.max("username").alias("high"),
        F.count(F.when(F.col("username").isNull(), 1)).alias("unnamed"), F.count("username").alias("named"),
    )
    users = joined.groupBy("user_id").agg(
        F.sum(F.bit_count("days").cast("bigint")).alias("page_count"),
        F.min("low").alias("username"),
        ((F.min("low") != F.max("high")) | (F.sum("unnamed") > 0) & (F.sum("named") > 0)).alias("several"),
    )
    several = users.filter("several").select("user_id")
    found = user_active_days_range(view.join(several, "user_id", "left_semi"), start, end)
    first_names = found.select("user_id", F.col("username").alias("first_name"))
    name = F.when(F.coalesce("several", F.lit(False)), F.col("first_name")).otherwise(F.col("username"))
    return users.join(first_names, "user_id", "left").select(
        "user_id", name.alias("username"), "page_count"
    )


def active_days_of_requests(view, requests):
    """Active days for each row of `requests`: `request`, `user_id`, `start` and `end`, both included.

    Ranges are not joined with days. Each user's days are numbered in order once, and a range is the
    difference of the numbers at its two ends. Ends are looked up among the days in one pass, each
    distinct end of a user once, so however many requests ask for one user, they add no rows there.
    """
    days = view.select("user_id", "day").distinct().withColumn("is_end", F.lit(False))

    def ends(name, shift):
        return requests.select("user_id", F.date_add(F.col(name), shift).alias("day"))

    asked = ends("start", -1).union(ends("end", 0)).dropna().distinct()
    # At one day the day itself comes before an end, which includes it.
    order = Window.partitionBy("user_id").orderBy("day", "is_end")
    known = (
        days.unionByName(asked.withColumn("is_end", F.lit(True)))
        .withColumn("until", F.sum((~F.col("is_end")).cast("bigint")).over(order))
        .filter("is_end")
    )

    def until(name, day):
        at = known.select(
            F.col("user_id").alias("known_user"), F.col("day").alias("known_day"), F.col("until").alias(name)
        )
        return at, (F.col("user_id") == F.col("known_user")) & (day == F.col("known_day"))

    rows = requests.select("request", "user_id", "start", "end")
    for name, day in (("before", F.date_add(F.col("start"), -1)), ("through", F.col("end"))):
        at, same = until(name, day)
        rows = rows.join(at, same, "left").drop("known_user", "known_day")
    active = F.greatest(F.col("through") - F.col("before"), F.lit(0))
    return rows.select("request", "user_id", F.coalesce(active, F.lit(0)).alias("active_days"))


def user_pages_created_range(events, start, end):
    """Users who created pages between two days, both included, with the number of pages."""
    # Counting per name first keeps the work on all rows in a hash aggregate; picking the first
    # name needs a sort, and sees one row per user and name.
    named = (
        _days(events.dropna(subset=["time", "user_id"]), start, end)
        .groupBy("user_id", "username")
        .agg(F.min("time").alias("since"), F.count(F.lit(1)).alias("pages"))
    )
    return (
        named.groupBy("user_id")
        .agg(
            F.min(F.struct("since", "username")).alias("first"),
            F.sum("pages").alias("pages_created"),
        )
        .select("user_id", F.col("first.username").alias("username"), "pages_created")
    )

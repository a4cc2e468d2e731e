"""The seven keyed views: a key, the shown columns, and the rule that the latest row wins.

Times are whole seconds, as the normaliser makes them.
"""

from dataclasses import dataclass, replace

from pyspark.sql import functions as F

from pagetide.functions.days import day_bit, span_of
from pagetide.functions.seconds import distinct_seconds, second_bit
from pagetide.schemas import PAGE_CREATE

ORDER = ("time", "seq")


@dataclass(frozen=True)
class ViewSpec:
    name: str
    key: tuple
    columns: tuple
    is_log: bool = False
    # The column that holds a mask of bits; rows of one key are joined by `bit_or`.
    mask: str | None = None

    @property
    def values(self):
        return tuple(name for name in self.columns if name not in self.key)

    @property
    def ordering(self):
        """What decides between rows of one key: time, arrival order, then the values."""
        if self.is_log:
            return ORDER
        if self.mask or not self.values:
            return ()
        return tuple(name for name in ORDER if name not in self.key)

    @property
    def stored(self):
        """Columns a row needs to be merged again later, hidden ordering included."""
        extra = [name for name in self.ordering if name not in self.columns]
        return (*self.columns, *extra)

    @property
    def keyed_by_time(self):
        """Rows of one key share their day, so a time filter cannot revive an older row."""
        return self.is_log or bool({"time", "day", "minute"} & set(self.key))

    def with_key(self, *key):
        return replace(self, key=key)


# View names, keys and columns.
SPECS = {
    spec.name: spec
    for spec in (
        ViewSpec(
            "domain_page_stats",
            key=("time", "domain", "created_by_bot"),
            columns=("time", "domain", "created_by_bot"),
        ),
        ViewSpec(
            "user_stat",
            key=("time", "user_id"),
            columns=("time", "user_id", "username", "page_title"),
        ),
        ViewSpec("distinct_domains", key=("domain",), columns=("domain",)),
        ViewSpec(
            "pages_by_user",
            key=("user_id", "page_id"),
            columns=("user_id", "page_id", "page_title"),
        ),
        ViewSpec("domain_page_counts", key=("domain", "page_id"), columns=("domain", "page_id")),
        ViewSpec(
            "page_details_by_page_id",
            key=("page_id",),
            columns=(
                "page_id",
                "page_title",
                "domain",
                "user_id",
                "username",
                "created_by_bot",
                "time",
            ),
        ),
        ViewSpec(
            "page_creations_by_time",
            key=("day", "user_id"),
            columns=("day", "user_id", "username"),
        ),
    )
}
# End of fixed values.

# Every event as it came, for reports that count events; nothing is merged.
EVENT_LOG = "event_log"
STORES = {**SPECS, EVENT_LOG: ViewSpec(EVENT_LOG, (), PAGE_CREATE, is_log=True)}

# Partial aggregates that reports and lookups are made of without reading rows again: the seconds of
# a minute, or the days of a span, as a mask per key. Masks of all batches are joined by `bit_or`.
DOMAIN_MINUTES, USER_MINUTES, USER_DAYS = "domain_minutes", "user_minutes", "user_days"
PARTIALS = {
    spec.name: spec
    for spec in (
        ViewSpec(
            DOMAIN_MINUTES,
            key=("minute", "domain", "created_by_bot"),
            columns=("minute", "domain", "created_by_bot", "seconds"),
            mask="seconds",
        ),
        ViewSpec(
            USER_MINUTES,
            key=("minute", "user_id", "username"),
            columns=("minute", "user_id", "username", "seconds"),
            mask="seconds",
        ),
        ViewSpec(
            USER_DAYS,
            key=("span", "user_id", "username"),
            columns=("span", "user_id", "username", "days"),
            mask="days",
        ),
    )
}
_KNOWN = {**STORES, **PARTIALS}


def spec_of(view):
    return view if isinstance(view, ViewSpec) else _KNOWN[view]


def without_values(view, *names):
    """The same view with fewer shown columns; the row that wins a key stays the same.

    Columns that only break ties after the others may be left out from the end.
    """
    spec = spec_of(view)
    return replace(spec, columns=tuple(name for name in spec.columns if name not in names))


def with_day(rows):
    if "day" in rows.columns:
        return rows
    return rows.withColumn("day", F.to_date("minute" if "minute" in rows.columns else "time"))


def _has_key(spec):
    present = F.lit(True)
    for name in spec.key:
        # Partial aggregates count the rows of users without a name as well.
        if not (spec.mask and name == "username"):
            from_time = name in ("day", "minute", "span")
            present = present & F.col("time" if from_time else name).isNotNull()
    return present


def missing_from(views=None):
    """Names of the views that cannot keep an event because part of their key is null."""
    specs = [spec_of(view) for view in views or SPECS]
    return F.array_compact(
        F.array(*[F.when(~_has_key(spec), F.lit(spec.name)) for spec in specs])
    )


def project(events, view):
    """Rows of one view before merging. Rows that lack part of the key cannot be kept."""
    spec = spec_of(view)
    rows = events.filter(_has_key(spec))
    if spec.mask == "seconds":
        rows = rows.withColumns(
            {"minute": F.date_trunc("minute", "time"), "seconds": second_bit(F.col("time"))}
        )
    elif spec.mask == "days":
        day = F.to_date("time")
        rows = rows.withColumns({"span": span_of(day), "days": day_bit(day)})
    if "day" in spec.key:
        rows = with_day(rows)
    if "seq" in spec.ordering and "seq" not in rows.columns:
        rows = rows.withColumn("seq", F.lit(0).cast("bigint"))
    return rows.select(*spec.stored)


def merge(rows, view):
    """One row per key, hidden ordering columns kept.

    Every form aggregates before the shuffle, so however many rows share a key, each map task
    sends at most one of them.
    """
    spec = spec_of(view)
    if spec.is_log:
        return rows.select(*spec.stored)
    if spec.mask:
        return rows.groupBy(*spec.key).agg(F.bit_or(spec.mask).alias(spec.mask))
    if not spec.values:
        if "time" in spec.key:
            others = [name for name in spec.key if name != "time"]
            return distinct_seconds(rows, "time", others).select(*spec.key)
        return rows.select(*spec.key).distinct()
    ranked = [*spec.ordering, *[name for name in spec.values if name not in spec.ordering]]
    newest = F.max(F.struct(*ranked)).alias("newest")
    return rows.groupBy(*spec.key).agg(newest).select(*spec.key, "newest.*")


def latest(rows, view):
    spec = spec_of(view)
    return merge(rows, spec).select(*spec.columns)


def build(events, view):
    return latest(project(events, view), view)

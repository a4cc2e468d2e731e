"""The registered queries. Each takes (spark, folder of tables) and returns a DataFrame.

Times and days are returned as text, which prints the same in every SQL engine.
"""

from functools import wraps

from pyspark.sql import functions as F

from pagetide.functions.timing import Bounds, as_utc, report_bounds
from pagetide.operators import documents, lookups, reports, viewlog, views
from pagetide.operators.normalize import accepted, from_wire, parse_envelope, to_wire
from pagetide.operators.quarantine import marked, quarantined
from pagetide.operators.report_reader import read_document
from pagetide.schemas import BOT_REPORT, HOURLY_REPORT, TOP_USERS_REPORT
from pagetide.session import query_run, scratch_folder, utc
from pagetide.sources.event_table import (
    as_envelopes,
    as_frames,
    as_page_creates,
    page_creates,
    stream_events,
)
from pagetide.sources.frames import sse_frames
from pagetide.streaming import jobs

AS_OF = "2024-01-16 12:30:00"
WINDOW = report_bounds(AS_OF)
SIX_HOURS = report_bounds(AS_OF, hours=6)
FIRST_DAY, LAST_DAY = "2024-01-10", "2024-01-16"
DAY_RANGE = Bounds(as_utc(FIRST_DAY), as_utc("2024-01-17"))
USERS = [0, 7, 41, 149, 999999]
DOMAINS = ["click.example.org", "view.example.org", "missing.example.org"]
PAGES = [0, 17, 3999, 999999]
ONCE = {"availableNow": True}
# How much of the table one batch reads; views do not depend on where batches are cut.
BATCH = {"maxBytesPerTrigger": str(4 * 2**30)}
STEPS = 4
BUCKETS = 16

QUERIES = {}


def query(function):
    @wraps(function)
    def run(spark, folder):
        with query_run(spark, function.__name__):
            return function(utc(spark), folder)

    QUERIES[function.__name__] = run
    return run


def _as_text(rows, *names):
    return rows.withColumns({name: F.col(name).cast("string") for name in names})


def _events(rows):
    return _as_text(rows.drop("seq"), "time")


def _envelopes(spark, folder):
    return as_envelopes(page_creates(spark, folder))


# Normalising


@query
def normalize_page_creates(spark, folder):
    return _events(accepted(parse_envelope(_envelopes(spark, folder))))


@query
def wire_round_trip(spark, folder):
    sent = to_wire(accepted(parse_envelope(_envelopes(spark, folder))))
    return _events(accepted(from_wire(sent)))


@query
def quarantine_counts(spark, folder):
    """Damaged copies of the events: cut or trailing text, fractional times, and no user."""
    from_domain = F.col("domain").startswith
    in_text = F.col("value").contains
    events = page_creates(spark, folder)
    nobody = F.when(~from_domain("purchase."), F.col("user_id"))
    text = F.col("value")
    damaged = (
        F.when(in_text('"error.'), F.expr("substr(value, 1, length(value) - 1)"))
        .when(in_text('"signup.'), F.replace(text, F.lit('Z"'), F.lit('.500Z"')))
        .when(in_text('"click.'), F.concat(text, F.lit(" junk")))
        .when(in_text('"view.'), F.concat(text, F.lit("}} "), text))
        .otherwise(text)
    )
    messages = as_envelopes(events.withColumn("user_id", nobody)).withColumn("value", damaged)
    return (
        quarantined(marked(parse_envelope(messages)))
        .groupBy("problem")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def _landed_frames(spark, folder, line_end="\n"):
    path = scratch_folder(spark, "frames")
    frames = as_frames(_envelopes(spark, folder))
    frames = frames.withColumn("value", F.replace("value", F.lit("\n"), F.lit(line_end)))
    frames.write.format("text").option("lineSep", line_end * 2).save(path)
    return accepted(parse_envelope(sse_frames(spark, path, separator=line_end * 2)))


@query
def sse_normalized(spark, folder):
    return _events(_landed_frames(spark, folder))


@query
def sse_crlf_normalized(spark, folder):
    """The same frames from a feed whose lines end in CRLF."""
    return _events(_landed_frames(spark, folder, "\r\n"))


@query
def sse_to_views(spark, folder):
    return views.build(_landed_frames(spark, folder), "distinct_domains")


@query
def sse_redelivered(spark, folder):
    """A feed that reconnects: every third frame lands a second time, in a later file.

    The stream stops before they land again and goes on from its checkpoint.
    """
    work = scratch_folder(spark, "redelivered")
    frames = as_frames(_envelopes(spark, folder))
    again = frames.filter(F.regexp_extract("value", r"id: (\d+)", 1).cast("bigint") % 3 == 0)
    for part in (frames, again):
        part.write.mode("append").format("text").option("lineSep", "\n\n").save(f"{work}/feed")
        # Batches by size: by number of files, each would be read by the few tasks of its files.
        messages = sse_frames(spark, f"{work}/feed", True, redelivered="1 hour", **BATCH)
        _run_once(
            jobs.start_normalize_to_files(messages, f"{work}/normalized", f"{work}/check", ONCE)
        )
    normalized = jobs.normalized_files(spark, f"{work}/normalized", streaming=False)
    return _events(accepted(from_wire(normalized)))


# Views


def _view(spark, folder, view):
    return views.build(page_creates(spark, folder), view)


@query
def view_domain_page_stats(spark, folder):
    return _as_text(_view(spark, folder, "domain_page_stats"), "time")


@query
def view_user_stat(spark, folder):
    return _as_text(_view(spark, folder, "user_stat"), "time")


@query
def view_distinct_domains(spark, folder):
    return _view(spark, folder, "distinct_domains")


@query
def view_pages_by_user(spark, folder):
    return _view(spark, folder, "pages_by_user")


@query
def view_domain_page_counts(spark, folder):
    return _view(spark, folder, "domain_page_counts")


@query
def view_page_details(spark, folder):
    return _as_text(_view(spark, folder, "page_details_by_page_id"), "time")


@query
def view_page_details_per_domain(spark, folder):
    """The page view keyed so that equal page ids of different domains stay apart."""
    spec = views.SPECS["page_details_by_page_id"].with_key("domain", "page_id")
    return _as_text(_view(spark, folder, spec), "time")


@query
def view_page_creations_by_day(spark, folder):
    return _as_text(_view(spark, folder, "page_creations_by_time"), "day")


# Reports


def _window_rows(spark, folder, bounds=WINDOW):
    return page_creates(spark, folder, bounds)


@query
def hourly_domain_stats(spark, folder):
    rows = reports.hourly_domain_stats(_window_rows(spark, folder), WINDOW)
    return _as_text(rows.orderBy("hour", "domain"), "hour")


@query
def hourly_domain_stats_6h(spark, folder):
    rows = reports.hourly_domain_stats(_window_rows(spark, folder, SIX_HOURS), SIX_HOURS)
    return _as_text(rows.orderBy("hour", "domain"), "hour")


@query
def hourly_domain_stats_all(spark, folder):
    return _as_text(reports.hourly_domain_stats(page_creates(spark, folder)), "hour")


@query
def hourly_domain_events_all(spark, folder):
    rows = reports.hourly_domain_stats(page_creates(spark, folder), grain=reports.EVENT)
    return _as_text(rows, "hour")


@query
def bot_domain_stats(spark, folder):
    return reports.bot_domain_stats(_window_rows(spark, folder), WINDOW)


@query
def bot_domain_stats_all(spark, folder):
    return reports.bot_domain_stats(page_creates(spark, folder))


@query
def bot_domain_events_all(spark, folder):
    return reports.bot_domain_stats(page_creates(spark, folder), grain=reports.EVENT)


@query
def top_20_users(spark, folder):
    return reports.top_user_titles(_window_rows(spark, folder), WINDOW)


@query
def top_20_users_all(spark, folder):
    """One row per page title: over any range of time, a user's titles need not fit one row."""
    return reports.top_user_titles(page_creates(spark, folder))


@query
def top_20_users_events_all(spark, folder):
    return reports.top_users(page_creates(spark, folder), grain=reports.EVENT)


# Lookups


@query
def lookup_domains(spark, folder):
    return lookups.domains(_view(spark, folder, "distinct_domains"))


@query
def lookup_pages_by_user(spark, folder):
    return lookups.pages_by_user(_view(spark, folder, "pages_by_user"), USERS)


@query
def lookup_pages_by_customer(spark, folder):
    """The keys come from a table: pages of every user id that is also a customer key."""
    customers = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey")
    return lookups.pages_by_user(_view(spark, folder, "pages_by_user"), customers)


@query
def lookup_domain_page_count(spark, folder):
    return lookups.domain_page_count(_view(spark, folder, "domain_page_counts"), DOMAINS)


@query
def lookup_page_details(spark, folder):
    details = lookups.page_details(_view(spark, folder, "page_details_by_page_id"), PAGES)
    return _as_text(details, "time")


@query
def lookup_details_of_pages(spark, folder):
    """The keys come from a table: details, or nulls, for every id in `pages`."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id")
    details = lookups.page_details(_view(spark, folder, "page_details_by_page_id"), pages)
    return _as_text(details, "time")


@query
def user_active_days_range(spark, folder):
    view = views.build(page_creates(spark, folder, DAY_RANGE), "page_creations_by_time")
    return lookups.user_active_days_range(view, FIRST_DAY, LAST_DAY)


@query
def user_pages_created_range(spark, folder):
    events = page_creates(spark, folder, DAY_RANGE)
    return lookups.user_pages_created_range(events, FIRST_DAY, LAST_DAY)


# Stored views and published reports


def _stored(spark, folder, name, batches=1):
    root = scratch_folder(spark, "views")
    events = page_creates(spark, folder)
    parts = _cut(events) if batches == 2 else [events]
    for number, part in enumerate(parts):
        viewlog.write_batch(part, root, "first", number, [name])
    return root


def _cut(events, at="2024-01-16 07:30:00"):
    """The events in two batches, cut in the middle of the window."""
    early = F.col("time") < F.lit(as_utc(at))
    return events.filter(early), events.filter(~early)


def _published(spark, folder, view, name):
    out = scratch_folder(spark, "reports")
    rows = viewlog.scan(spark, _stored(spark, folder, view), view, WINDOW)
    documents.publish(spark, rows, rows, WINDOW, out, names=[name])
    return read_document(spark, out, name)


@query
def hourly_report_document(spark, folder):
    return _published(spark, folder, "domain_page_stats", HOURLY_REPORT)


@query
def bot_report_document(spark, folder):
    return _published(spark, folder, "domain_page_stats", BOT_REPORT)


@query
def top_users_document(spark, folder):
    return _published(spark, folder, "user_stat", TOP_USERS_REPORT)


@query
def stored_hourly_events(spark, folder):
    """Every event of the window, counted in the stored log."""
    root = _stored(spark, folder, views.EVENT_LOG, batches=2)
    rows = viewlog.scan(spark, root, views.EVENT_LOG, WINDOW)
    return _as_text(reports.hourly_domain_stats(rows, WINDOW, reports.EVENT), "hour")


@query
def stored_pages_created_range(spark, folder):
    root = _stored(spark, folder, views.EVENT_LOG, batches=2)
    events = viewlog.read(spark, root, views.EVENT_LOG, DAY_RANGE)
    return lookups.user_pages_created_range(events, FIRST_DAY, LAST_DAY)


def _in_batches(spark, folder, *names):
    """The events in four batches, the first two of which are compacted, and then replayed."""
    root = scratch_folder(spark, "views")
    batches = [
        page_creates(spark, folder).filter(part) for part in _quarters(spark, folder)
    ]
    for number, batch in enumerate(batches):
        if number == 2:
            viewlog.compact(spark, root, names)
        for again in {number, max(number - 1, 0)}:
            viewlog.write_batch(batches[again], root, "first", again, names)
    viewlog.compact(spark, root, names)
    return root


@query
def compacted_event_log(spark, folder):
    """Every event once, after two compactions with replayed batches between them."""
    root = _in_batches(spark, folder, views.EVENT_LOG)
    return _events(viewlog.read(spark, root, views.EVENT_LOG))


@query
def partial_hourly_stats(spark, folder):
    """The hourly report of all hours from the masks that four batches stored."""
    root = _in_batches(spark, folder, views.DOMAIN_MINUTES)
    minutes = viewlog.read(spark, root, views.DOMAIN_MINUTES)
    return _as_text(reports.hourly_of_minutes(minutes), "hour")


@query
def partial_bot_stats(spark, folder):
    root = _in_batches(spark, folder, views.DOMAIN_MINUTES)
    minutes = viewlog.read(spark, root, views.DOMAIN_MINUTES, WINDOW)
    return reports.bots_of_minutes(minutes)


@query
def partial_top_20_users(spark, folder):
    """Users counted from masks; rows are read for the titles of the winners."""
    root = _in_batches(spark, folder, views.USER_MINUTES, "user_stat")
    minutes = viewlog.read(spark, root, views.USER_MINUTES, WINDOW)
    rows = viewlog.scan(spark, root, "user_stat", WINDOW)
    return reports.top_user_titles(rows, WINDOW, minutes=minutes)


@query
def stored_active_days(spark, folder):
    """Active days in a range from masks of days that four batches stored."""
    root = _in_batches(spark, folder, views.USER_DAYS, "page_creations_by_time")
    masks = viewlog.read(spark, root, views.USER_DAYS)
    view = viewlog.read(spark, root, "page_creations_by_time", DAY_RANGE)
    return lookups.user_active_days_of_masks(masks, view, FIRST_DAY, LAST_DAY)


@query
def lookup_days_of_requests(spark, folder):
    """Active days of a user in a range of days, for a request per customer."""
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    start = F.date_add(F.lit("2023-12-28").cast("date"), (F.col("c_custkey") % 40).cast("int"))
    asked = customers.select(
        F.col("c_custkey").alias("request"),
        (F.col("c_custkey") % 200).alias("user_id"),
        start.alias("start"),
        F.date_add(start, (F.col("c_custkey") % 11).cast("int") - 1).alias("end"),
    )
    view = _view(spark, folder, "page_creations_by_time")
    return lookups.active_days_of_requests(view, asked)


@query
def upserted_pages_by_user(spark, folder):
    """Four batches put into buckets, each with the keys of the one before again."""
    root, name = scratch_folder(spark, "views"), "pages_by_user"
    before = F.lit(False)
    for number, part in enumerate(_quarters(spark, folder)):
        batch = page_creates(spark, folder).filter(part | before)
        viewlog.write_batch(batch, root, "first", number, [name], buckets=BUCKETS)
        before = part
    return viewlog.read(spark, root, name)


@query
def compacted_page_details(spark, folder):
    """Compacted between two batches, in place."""
    name = "page_details_by_page_id"
    root = scratch_folder(spark, "views")
    early, late = _cut(page_creates(spark, folder))
    viewlog.write_batch(early, root, "first", 0, [name])
    viewlog.compact(spark, root, [name])
    viewlog.write_batch(late, root, "first", 1, [name])
    return _as_text(viewlog.read(spark, root, name), "time")


# Streaming


def _run_once(query):
    query.awaitTermination()


def _streamed(spark, raw, *names):
    """Messages through both streaming jobs: raw to normalised files, then to the stored views."""
    work = scratch_folder(spark, "stream")
    _run_once(
        jobs.start_normalize_to_files(raw, f"{work}/normalized", f"{work}/check-a", ONCE)
    )
    _run_once(
        jobs.start_views(
            jobs.normalized_files(spark, f"{work}/normalized", **BATCH),
            f"{work}/views",
            "first",
            f"{work}/check-b",
            f"{work}/aside",
            ONCE,
            views=names or None,
        )
    )
    return f"{work}/views"


def _raw_stream(spark, folder, time="second"):
    """The table as a stream of raw messages, with times cut to a coarser unit if asked."""
    events = as_page_creates(stream_events(spark, folder, **BATCH))
    return as_envelopes(events.withColumn("time", F.date_trunc(time, "time")))


@query
def streamed_domain_page_stats(spark, folder):
    name = "domain_page_stats"
    root = _streamed(spark, _raw_stream(spark, folder), name)
    return _as_text(viewlog.read(spark, root, name), "time")


@query
def streamed_view_sizes(spark, folder):
    """All seven views kept by the stream, with the number of rows in each."""
    root = _streamed(spark, _raw_stream(spark, folder))
    sizes = [
        viewlog.read(spark, root, name)
        .agg(F.count(F.lit(1)).alias("rows_kept"))
        .select(F.lit(name).alias("view_name"), "rows_kept")
        for name in views.SPECS
    ]
    result = sizes[0]
    for size in sizes[1:]:
        result = result.union(size)
    return result


@query
def streamed_page_details(spark, folder):
    """Raw messages straight into the buckets of the page view, which a read does not merge."""
    name = "page_details_by_page_id"
    work = scratch_folder(spark, "stream")
    _run_once(
        jobs.start_views(
            _raw_stream(spark, folder), f"{work}/views", "first", f"{work}/check",
            f"{work}/aside", ONCE, views=[name], decode=parse_envelope, buckets=BUCKETS,
        )
    )
    return _as_text(viewlog.read(spark, f"{work}/views", name), "time")


def _same_hour(spark, folder, name):
    """A view over both hops from times cut to the hour, so that arrival order decides."""
    root = _streamed(spark, _raw_stream(spark, folder, "hour"), name)
    return _as_text(viewlog.read(spark, root, name), *{"time"} & set(views.SPECS[name].columns))


@query
def streamed_user_stat(spark, folder):
    return _same_hour(spark, folder, "user_stat")


@query
def streamed_pages_by_user(spark, folder):
    return _same_hour(spark, folder, "pages_by_user")


@query
def streamed_page_details_same_second(spark, folder):
    return _same_hour(spark, folder, "page_details_by_page_id")


def _quarters(spark, folder):
    """Filters that cut the table into parts of equal size, in order of time."""
    shares = [step / STEPS for step in range(1, STEPS)]
    rows = page_creates(spark, folder).select(F.unix_timestamp("time").alias("second"))
    cuts = rows.agg(F.percentile_approx("second", shares).alias("cuts")).first().cuts or []
    second = F.unix_timestamp("time")
    ends = [None, *sorted(set(cuts)), None]
    for start, end in zip(ends, ends[1:]):
        after = F.lit(True) if start is None else second >= start
        yield after if end is None else after & (second < end)


def _hourly_in_steps(spark, folder, late=None):
    """The hourly stream over the table, landed and run part by part, in order of time.

    `late` picks events that land after all others, behind the watermark.
    """
    work = scratch_folder(spark, "hourly")
    events = page_creates(spark, folder)
    parts = list(_quarters(spark, folder))
    if late is not None:
        parts = [~late & part for part in parts] + [late]
    for part in parts:
        events.filter(part).write.mode("append").parquet(f"{work}/landed")
        landed = spark.readStream.schema(events.schema).options(**BATCH).parquet(f"{work}/landed")
        _run_once(jobs.start_hourly(landed, f"{work}/hours", f"{work}/check", trigger=ONCE))
    return _as_text(spark.read.parquet(f"{work}/hours"), "hour")


@query
def hourly_stream(spark, folder):
    return _hourly_in_steps(spark, folder)


@query
def hourly_stream_late(spark, folder):
    """Page ids of one residue arrive when their hours are closed, and are not counted."""
    return _hourly_in_steps(spark, folder, F.col("page_id") % 10 == 3)


@query
def hourly_stream_corrected(spark, folder):
    """The same late events, which correct hours that were published long before."""
    work = scratch_folder(spark, "corrected")
    events = page_creates(spark, folder)
    late = F.col("page_id") % 10 == 3
    for part in [*(~late & part for part in _quarters(spark, folder)), late]:
        events.filter(part).write.mode("append").parquet(f"{work}/landed")
        landed = spark.readStream.schema(events.schema).options(**BATCH).parquet(f"{work}/landed")
        _run_once(
            jobs.start_corrected_hours(
                landed, f"{work}/minutes", "first", f"{work}/hours", f"{work}/check", ONCE
            )
        )
    return _as_text(jobs.corrected_hours(spark, f"{work}/hours"), "hour")

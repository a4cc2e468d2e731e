"""Reports and lookups from partial aggregates, many ranges, redelivered frames, corrected hours."""

import random
from datetime import date, timedelta

import pytest
from helpers import envelope, event, events_frame, tuples
from pyspark.sql import functions as F

from pagetide.functions.days import SPAN_DAYS
from pagetide.functions.timing import report_bounds
from pagetide.operators import lookups, reports, viewlog
from pagetide.operators.views import DOMAIN_MINUTES, USER_DAYS, USER_MINUTES, build
from pagetide.sources.frames import sse_frames
from pagetide.streaming import jobs

BOUNDS = report_bounds("2024-01-16 12:30:00")


def busy(n=300, names=("x", "y", None)):
    """Few seconds, so that users have several names and rows in one."""
    pick = random.Random(5)
    return [
        event(
            f"2024-01-16 0{pick.randint(3, 9)}:0{pick.randint(0, 1)}:0{pick.randint(0, 4)}",
            domain=pick.choice(["a.org", "b.org", None]),
            user_id=pick.choice([1, 2, 3, None]),
            username=pick.choice(names),
            created_by_bot=pick.choice([True, False, None]),
            page_title=f"t{i}",
            seq=i,
        )
        for i in range(n)
    ]


@pytest.fixture
def stored(spark, tmp_path):
    """The rows in four batches out of order, compacted in between, one of them twice."""

    def write(rows, *names):
        root = str(tmp_path)
        for number in range(4):
            batch = events_frame(spark, rows[number::4])
            viewlog.write_batch(batch, root, "r", number, names)
            if number == 1:
                viewlog.compact(spark, root)
                viewlog.write_batch(batch, root, "r", number, names)
        return root

    return write


@pytest.mark.parametrize("bounds", [None, BOUNDS])
def test_reports_from_partials_are_those_from_rows(spark, stored, bounds):
    rows = busy()
    root, frame = stored(rows, DOMAIN_MINUTES, USER_MINUTES, "user_stat"), events_frame(spark, rows)
    minutes = viewlog.read(spark, root, DOMAIN_MINUTES, bounds)
    assert tuples(reports.hourly_of_minutes(minutes)) == tuples(
        reports.hourly_domain_stats(frame, bounds)
    )
    assert tuples(reports.bots_of_minutes(minutes)) == tuples(reports.bot_domain_stats(frame, bounds))
    users = viewlog.read(spark, root, USER_MINUTES, bounds)
    seen = viewlog.scan(spark, root, "user_stat", bounds)
    assert tuples(reports.top_user_titles(seen, bounds, minutes=users)) == tuples(
        reports.top_user_titles(frame, bounds)
    )
    merged = build(frame.filter(F.lit(True)), "user_stat")
    counted = tuples(merged.groupBy("user_id", "username").count())
    if bounds is None:
        assert tuples(reports.user_counts(seen, users)) == counted


def days_of(rows):
    """Per user the name of each active day, the last of the day."""
    found = {}
    for row in sorted(rows, key=lambda row: (row["time"], row["seq"])):
        if row["user_id"] is not None:
            found[row["user_id"], row["time"].date()] = row["username"]
    return found


def spread(n=250):
    pick, first = random.Random(3), date(2023, 11, 1)
    return [
        event(
            f"{first + timedelta(days=pick.randint(0, 3 * SPAN_DAYS))} 0{pick.randint(0, 9)}:00:00",
            user_id=pick.choice([1, 2, 3, 4, None]),
            username=pick.choice(["x", "y", None]) if i % 3 else "x",
            seq=i,
        )
        for i in range(n)
    ] + [event("1969-12-31 05:00:00", user_id=9), event("1969-11-01 05:00:00", user_id=9)]


RANGES = [
    ("2023-11-01", "2024-06-01"), ("2023-12-01", "2024-01-31"), ("2024-01-17", "2024-01-17"),
    ("2024-01-18", "2024-01-18"), ("2024-01-10", "2024-01-25"), ("2024-02-01", "2024-01-01"),
    ("1969-10-01", "1970-01-01"), ("2030-01-01", "2030-02-01"),
]


def test_masks_of_days_count_any_range(spark, stored):
    rows = spread()
    root, known = stored(rows, USER_DAYS, "page_creations_by_time"), days_of(spread())
    masks = viewlog.read(spark, root, USER_DAYS).cache()
    view = viewlog.read(spark, root, "page_creations_by_time").cache()
    assert masks.select("span").distinct().count() > 3
    for start, end in RANGES:
        own = {}
        for (user, day), name in sorted(known.items()):
            if start <= str(day) <= end:
                own.setdefault(user, []).append(name)
        want = sorted(((user, names[0], len(names)) for user, names in own.items()), key=str)
        assert tuples(lookups.user_active_days_range(view, start, end)) == want
        assert tuples(lookups.user_active_days_of_masks(masks, view, start, end)) == want
    masks.unpersist()
    view.unpersist()


def test_many_ranges_at_once(spark):
    rows = spread()
    known, pick = days_of(rows), random.Random(1)
    asked = [(1, 1, date(2023, 12, 1), date(2023, 12, 1)), (1, 1, date(2023, 12, 1), date(2023, 12, 1)),
             (2, 77, date(2023, 1, 1), date(2025, 1, 1)), (3, None, date(2023, 1, 1), date(2025, 1, 1)),
             (4, 1, None, date(2025, 1, 1)), (5, 1, date(2023, 1, 1), None),
             (6, 1, date(2024, 1, 5), date(2024, 1, 1)), (7, 9, date(1969, 1, 1), date(1970, 1, 1))]
    for request in range(10, 200):
        start = date(2023, 10, 25) + timedelta(days=pick.randint(0, 200))
        asked.append((request, pick.randint(1, 4), start, start + timedelta(days=pick.randint(-2, 90))))
    # One user is asked for far more often than there are days.
    asked += [(1000 + n, 1, date(2023, 12, 1) + timedelta(days=n % 40), date(2024, 2, 1)) for n in range(800)]
    frame = spark.createDataFrame(asked, "request bigint, user_id bigint, start date, end date")
    view = build(events_frame(spark, rows), "page_creations_by_time")
    found = lookups.active_days_of_requests(view, frame)
    want = [
        (
            request, user,
            sum(user == u and start <= day <= end for u, day in known)
            if None not in (user, start, end) else 0,
        )
        for request, user, start, end in asked
    ]
    assert tuples(found) == sorted(want, key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert tuples(lookups.active_days_of_requests(view, frame.limit(0))) == []


FRAMES = [f"id: {i}\ndata: " + envelope(page_id=i) for i in range(5)] + [
    "data: " + envelope(page_id=90), "data: " + envelope(page_id=90), "id:\ndata: " + envelope(page_id=91),
]


def test_frames_that_come_again_are_messages_once(spark, tmp_path):
    """Frames without an id are kept, however alike they are."""
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "1").write_text("\n\n".join(FRAMES) + "\n\n")
    (feed / "2").write_text("\n\n".join([*FRAMES[2:5], "id: 9\ndata: " + envelope(page_id=9)]) + "\n\n")
    batch = sse_frames(spark, str(feed), redelivered="1 hour")
    ids = sorted(row.id or "" for row in batch.collect())
    assert ids == ["", "", "", "0", "1", "2", "3", "4", "9"]
    assert sse_frames(spark, str(feed)).count() == 12
    stream = sse_frames(spark, str(feed), streaming=True, redelivered="1 hour", maxFilesPerTrigger="1")
    for _ in range(2):
        # The second run finds nothing new: what has been delivered is remembered.
        jobs.start_normalize_to_files(
            stream, str(tmp_path / "out"), str(tmp_path / "check"), {"availableNow": True}
        ).awaitTermination()
        assert jobs.normalized_files(spark, str(tmp_path / "out"), streaming=False).count() == 9
    (feed / "3").write_text(FRAMES[0] + "\n\n")
    jobs.start_normalize_to_files(
        stream, str(tmp_path / "out"), str(tmp_path / "check"), {"availableNow": True}
    ).awaitTermination()
    assert jobs.normalized_files(spark, str(tmp_path / "out"), streaming=False).count() == 9


def test_late_events_correct_published_hours(spark, tmp_path):
    root, out = str(tmp_path / "minutes"), str(tmp_path / "hours")
    write, rows = jobs.corrected_hours_writer(root, "r", out), busy(80, names=("x",))
    rows += [event("2023-05-05 01:00:00", domain="late.org"), event(None)]
    assert jobs.corrected_hours(spark, out).collect() == []
    for number, at in enumerate(range(0, 82, 20)):
        for _ in range(2):
            # A batch that is run again changes nothing.
            write(events_frame(spark, rows[at : at + 20]), number)
            want = reports.hourly_domain_stats(events_frame(spark, rows[: at + 20]))
            assert tuples(jobs.corrected_hours(spark, out)) == tuples(want)
    days = {path.name for path in tmp_path.glob("hours/version-*/day=*")}
    assert days == {"day=2023-05-05", "day=2024-01-16"}

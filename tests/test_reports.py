import json
from pathlib import Path

import pytest
from helpers import at, event, events_frame, tuples
from hypothesis import given, settings, strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pagetide.functions.timing import Bounds, report_bounds
from pagetide.operators import documents, reports
from pagetide.operators.views import build
from pagetide.schemas import BOT_REPORT, HOURLY_REPORT, TOP_USERS_REPORT

BOUNDS = report_bounds("2024-01-16 12:30:00")


def test_bounds():
    assert BOUNDS == (at("2024-01-16 04:00:00"), at("2024-01-16 11:00:00"))
    assert report_bounds("2024-01-16 12:00:00", hours=6).start == at("2024-01-16 05:00:00")
    assert report_bounds("2024-01-16 02:59:59") == (
        at("2024-01-15 18:00:00"), at("2024-01-16 01:00:00"),
    )
    assert Bounds(at("2024-01-15 18:00:00"), at("2024-01-16 00:00:00")).days == (
        at("2024-01-15 00:00:00").date(),
    ) * 2


def hourly(frame, *args, **kwargs):
    rows = reports.hourly_domain_stats(frame, *args, **kwargs)
    return tuples(rows.select(F.col("hour").cast("string"), "domain", "pages_created"))


def test_window_edges(spark):
    frame = events_frame(
        spark,
        [event(f"2024-01-16 {t}") for t in ("03:59:59", "04:00:00", "10:59:59", "11:00:00")],
    )
    assert hourly(frame, BOUNDS) == [
        ("2024-01-16 04:00:00", "a.org", 1), ("2024-01-16 10:00:00", "a.org", 1),
    ]


def test_grains(spark):
    pair = [event("2024-01-16 05:00:00", page_id=i, created_by_bot=True) for i in (1, 2)]
    frame = events_frame(spark, [*pair, event("2024-01-16 05:00:00", page_id=3)])
    assert [row[2] for row in hourly(frame, BOUNDS)] == [2]
    assert [row[2] for row in hourly(frame, BOUNDS, reports.EVENT)] == [3]
    assert tuples(reports.bot_domain_stats(frame, BOUNDS)) == [("a.org", 1)]
    assert tuples(reports.bot_domain_stats(frame, BOUNDS, reports.EVENT)) == [("a.org", 2)]
    keyed = reports.top_users(frame, BOUNDS).first()
    by_event = reports.top_users(frame, BOUNDS, grain=reports.EVENT).first()
    assert (keyed.pages_created, by_event.pages_created) == (1, 3)
    with pytest.raises(ValueError):
        reports.hourly_domain_stats(frame, BOUNDS, "pages")


@pytest.mark.parametrize("view", ["domain_page_stats", "user_stat"])
def test_event_grain_is_refused_on_rows_of_a_view(spark, view):
    rows = build(events_frame(spark, [event("2024-01-16 05:00:00")]), view)
    count = reports.hourly_domain_stats if view == "domain_page_stats" else reports.top_users
    with pytest.raises(ValueError, match="event log"):
        count(rows, BOUNDS, grain=reports.EVENT)


def test_names_that_change_within_a_second(spark):
    """The later row of a second gives the name, whatever the masks of the minute say."""
    rows = [
        event("2024-01-16 05:00:00", username="old", seq=1),
        event("2024-01-16 05:00:00", username="new", seq=2),
        event("2024-01-16 05:00:01", username="old", seq=3),
        event("2024-01-16 05:01:00", username="old", seq=4),
        event("2024-01-16 05:01:01", username="new", seq=5),
    ]
    frame = events_frame(spark, rows)
    assert tuples(reports.user_counts(frame), "username", "pages_created") == [("new", 2), ("old", 2)]
    merged = build(frame, "user_stat").groupBy("username").count()
    assert tuples(merged) == [("new", 2), ("old", 2)]


def test_null_bot_flag_is_not_a_bot(spark):
    frame = events_frame(spark, [event("2024-01-16 05:00:00", created_by_bot=None)])
    assert tuples(reports.bot_domain_stats(frame, BOUNDS)) == []


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 130), st.sampled_from(["a", "b"]), st.booleans(), st.integers(1, 3)
        ),
        max_size=40,
    )
)
def test_second_masks_count_distinct_seconds(spark, picks):
    base = at("2024-01-16 04:58:59").timestamp()
    rows = []
    for offset, domain, bot, user in picks:
        row = event("2024-01-16 04:58:59", domain=domain, created_by_bot=bot, user_id=user)
        row["time"] = type(row["time"]).fromtimestamp(base + offset, row["time"].tzinfo)
        rows.append(row)
    frame = events_frame(spark, rows)
    keyed = hourly(frame)
    want = {}
    for time, domain, bot in {(r["time"], r["domain"], r["created_by_bot"]) for r in rows}:
        key = (time.strftime("%Y-%m-%d %H:00:00"), domain)
        want[key] = want.get(key, 0) + 1
    assert keyed == sorted(((*key, n) for key, n in want.items()), key=str)
    assert keyed == hourly(build(frame, "domain_page_stats"))
    events = hourly(frame, grain=reports.EVENT)
    assert all(k[2] <= e[2] for k, e in zip(keyed, events))
    assert sum(e[2] for e in events) == len(rows)
    totals = {}
    for _, domain, n in keyed:
        totals[domain] = totals.get(domain, 0) + n
    assert all(n <= totals[d] for d, n in tuples(reports.bot_domain_stats(frame)))


def test_renamed_user_is_two_entries(spark):
    frame = events_frame(
        spark,
        [
            event("2024-01-16 05:00:00", username="x", page_title="A"),
            event("2024-01-16 05:00:01", username="x", page_title="B"),
            event("2024-01-16 05:00:02", username="y", page_title="C"),
            event("2024-01-16 05:00:03", username=None, page_title="D"),
        ],
    )
    assert tuples(reports.top_user_titles(frame, BOUNDS)) == [
        (1, 1, "x", 2, "A"), (1, 1, "x", 2, "B"), (2, 1, None, 1, "D"), (3, 1, "y", 1, "C"),
    ]


def test_ties_go_to_the_lower_id(spark):
    frame = events_frame(
        spark, [event("2024-01-16 05:00:00", user_id=i, username=f"u{i}") for i in range(21, 0, -1)]
    )
    top = reports.top_users(frame, BOUNDS)
    assert [(row.rank, row.user_id) for row in top.collect()] == [(i, i) for i in range(1, 21)]
    with pytest.raises(ValueError):
        reports.top_users(frame, BOUNDS, n=0)


def read_text(spark, out, name):
    folder = Path(documents.report_path(spark, str(out), name))
    # The parts are one JSON value in the order of their names.
    return json.loads("".join(path.read_text() for path in sorted(folder.glob("part-*"))))


def test_published_documents(spark, tmp_path):
    bounds = report_bounds("2024-01-16 02:10:00")
    frame = events_frame(
        spark,
        [
            event("2024-01-15 23:30:00", domain="b.org", created_by_bot=True),
            event("2024-01-15 23:30:01", domain="a.org", page_title="Second"),
            event("2024-01-15 21:00:00", domain="a.org", page_title="First"),
            event("2024-01-15 21:00:00", domain="a.org", user_id=9, username="nine"),
        ],
    )
    documents.publish(spark, frame, frame, bounds, str(tmp_path))
    assert read_text(spark, tmp_path, HOURLY_REPORT) == [
        {"time_start": "21:00", "time_end": "22:00", "statistics": [{"a.org": 1}]},
        {"time_start": "23:00", "time_end": "00:00", "statistics": [{"a.org": 1}, {"b.org": 1}]},
    ]
    assert read_text(spark, tmp_path, BOT_REPORT) == {
        "time_start": "18:00",
        "time_end": "01:00",
        "statistics": [{"domain": "b.org", "created_by_bots": 1}],
    }
    span = {"time_start": "18:00", "time_end": "01:00"}
    assert read_text(spark, tmp_path, TOP_USERS_REPORT) == [
        {"user_id": 1, "username": "one", **span, "page_titles": ["First", "Second", "T"],
         "pages_created": 3},
        {"user_id": 9, "username": "nine", **span, "page_titles": ["T"], "pages_created": 1},
    ]
    assert tuples(documents.read_report(spark, str(tmp_path), HOURLY_REPORT)) == [
        ("21:00", "22:00", "a.org", 1), ("23:00", "00:00", "a.org", 1), ("23:00", "00:00", "b.org", 1),
    ]
    assert documents.read_report(spark, str(tmp_path), TOP_USERS_REPORT).count() == 4


def test_empty_window(spark, tmp_path):
    frame = events_frame(spark, [event("2020-01-01 00:00:00")])
    documents.publish(spark, frame, frame, BOUNDS, str(tmp_path))
    assert read_text(spark, tmp_path, HOURLY_REPORT) == []
    assert read_text(spark, tmp_path, TOP_USERS_REPORT) == []
    assert read_text(spark, tmp_path, BOT_REPORT) == {
        "time_start": "04:00", "time_end": "11:00", "statistics": [],
    }


def test_large_documents_are_spread_over_parts(spark, tmp_path):
    rows = [
        event(f"2024-01-16 0{5 + i % 4}:00:{i % 60:02d}", domain=f'd"{i:04d}.org', user_id=i % 9,
              username=None if i % 9 == 3 else f"u{i % 9}", created_by_bot=i % 2 == 0,
              page_title=None if i % 50 == 0 else f"T\\{i % 20}", seq=i)
        for i in range(800)
    ]
    frame = events_frame(spark, rows)
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        documents.publish(spark, frame, frame, BOUNDS, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    for name in (HOURLY_REPORT, TOP_USERS_REPORT):
        assert len(list(Path(documents.report_path(spark, str(tmp_path), name)).glob("part-*"))) > 2
    hours = read_text(spark, tmp_path, HOURLY_REPORT)
    assert [hour["time_start"] for hour in hours] == ["05:00", "06:00", "07:00", "08:00"]
    assert [domain for hour in hours for entry in hour["statistics"] for domain in entry] == sorted(
        (row["domain"] for row in rows), key=lambda d: (int(d[2:6]) % 4, d)
    )
    users = read_text(spark, tmp_path, TOP_USERS_REPORT)
    kept = build(frame, "user_stat").collect()
    for user in users:
        own = [r for r in kept if r.user_id == user["user_id"]]
        assert user.get("username") == own[0].username
        assert user["pages_created"] == len(own)
        assert user["page_titles"] == sorted(r.page_title for r in own if r.page_title is not None)
    order = [(-user["pages_created"], user["user_id"]) for user in users]
    assert order == sorted(order) and len(users) == 9


def test_publishing_again_replaces_the_report(spark, tmp_path):
    for domain in ("a.org", "b.org"):
        frame = events_frame(spark, [event("2024-01-16 05:00:00", domain=domain)])
        documents.publish(spark, frame, frame, BOUNDS, str(tmp_path), names=[HOURLY_REPORT])
        assert read_text(spark, tmp_path, HOURLY_REPORT)[0]["statistics"] == [{domain: 1}]
    assert [path.name for path in tmp_path.iterdir()] == [HOURLY_REPORT]


def test_missing_and_broken_reports(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        documents.read_report(spark, str(tmp_path), HOURLY_REPORT)
    frame = events_frame(spark, [event("2024-01-16 05:00:00")])
    documents.publish(spark, frame, frame, BOUNDS, str(tmp_path), names=[HOURLY_REPORT])
    for path in Path(documents.rows_path(spark, str(tmp_path), HOURLY_REPORT)).glob("*part-*"):
        path.unlink() if path.name.startswith(".") else path.write_text("cut")
    with pytest.raises(Exception, match="parquet|Parquet"):
        documents.read_report(spark, str(tmp_path), HOURLY_REPORT).collect()

import json
import os
import random

import pytest
from helpers import envelope, event, events_frame, tuples
from pyspark.sql import functions as F

from pagetide.operators import reports, viewlog
from pagetide.operators.normalize import accepted, from_wire, parse_envelope, to_wire
from pagetide.operators.views import EVENT_LOG, SPECS, build
from pagetide.sources.messages import file_messages
from pagetide.streaming import jobs

ONCE = {"availableNow": True}


def texts(n=48):
    pick = random.Random(3)
    made = []
    for i in range(n):
        made.append(
            envelope(
                f"2024-01-0{pick.randint(1, 2)}T0{pick.randint(0, 9)}:00:{i % 60:02d}Z",
                page_id=pick.randint(1, 12),
                page_title=f"t{i}",
                performer={"user_id": pick.randint(1, 3), "user_text": "u", "user_is_bot": i % 2 == 0},
            )
        )
    made[5] = "broken"
    made[6] = envelope("2024-01-01T00:00:00Z", performer={"user_is_bot": False})
    return made


def land(folder, lines, files):
    folder.mkdir()
    for i in range(files):
        (folder / f"{i}.txt").write_text("\n".join(lines[i::files]) + "\n")


@pytest.mark.parametrize("files", [1, 3])
def test_stream_equals_batch(spark, tmp_path, files):
    lines = texts()
    land(tmp_path / "in", lines, files)
    source = str(tmp_path / "in")
    work = str(tmp_path)
    # Arrival order: larger numbers for what sorts first, so that the values cannot stand in for it.
    def numbered(messages):
        return messages.withColumn("seq", -F.xxhash64("value"))

    first = jobs.start_normalize_to_files(
        numbered(file_messages(spark, source, True, maxFilesPerTrigger=1)),
        f"{work}/out", f"{work}/c1", ONCE,
    )
    first.awaitTermination()
    assert sum(progress["numInputRows"] > 0 for progress in first.recentProgress) == files
    jobs.start_views(
        jobs.normalized_files(spark, f"{work}/out", maxFilesPerTrigger=1),
        f"{work}/views", "r1", f"{work}/c2", f"{work}/aside", ONCE,
    ).awaitTermination()

    events = accepted(parse_envelope(numbered(file_messages(spark, source))))
    assert events.count() == len(lines) - 1
    assert events.select("seq").distinct().count() == events.count()
    assert viewlog.read(spark, f"{work}/views", EVENT_LOG).count() == events.count()
    for name in SPECS:
        assert tuples(viewlog.read(spark, f"{work}/views", name)) == tuples(build(events, name))
    aside = spark.read.parquet(f"{work}/aside")
    assert [row.problem[:6] for row in aside.collect()] == ["no_key"]
    bad = jobs.normalized_files(spark, f"{work}/out", jobs.REJECTED_TOPIC, streaming=False)
    assert [json.loads(row.value)["value"] for row in bad.collect()] == ["broken"]


def test_rows_of_one_second_keep_their_order_over_both_hops(spark, tmp_path):
    lines = [
        envelope("2024-01-01T00:00:00Z", page_id=1, page_title=title) for title in ("zz old", "aa new")
    ]
    rows = spark.createDataFrame([(lines[0], 1), (lines[1], 2)], "value string, seq bigint")
    sent = to_wire(accepted(parse_envelope(rows)))
    view = build(accepted(from_wire(sent)), "page_details_by_page_id")
    assert view.first().page_title == "aa new"


def test_every_message_is_accepted_or_kept_aside(spark, tmp_path):
    lines = [*texts(), envelope() + " junk", envelope() + envelope(), envelope() + "}} " + envelope(),
             envelope() + ',"x":{}', envelope() + "]", "null", "[1]", "5"]
    land(tmp_path / "in", lines, 2)
    source, work = file_messages(spark, str(tmp_path / "in"), True), str(tmp_path)
    jobs.start_views(
        source, f"{work}/views", "r", f"{work}/c1", f"{work}/aside", ONCE, decode=parse_envelope
    ).awaitTermination()
    jobs.start_rejects(source, f"{work}/bad", f"{work}/c2", ONCE, parse_envelope).awaitTermination()
    good = viewlog.read(spark, f"{work}/views", EVENT_LOG).count()
    bad = spark.read.parquet(f"{work}/bad")
    assert good + bad.count() == len(lines)
    assert sorted({row.value for row in bad.collect()}) == sorted({"broken", *lines[-8:]})
    aside = spark.read.parquet(f"{work}/aside")
    assert aside.filter("problem not like 'no_key%'").count() == bad.count()


def test_restart_with_new_checkpoint_and_run_changes_nothing(spark, tmp_path):
    land(tmp_path / "in", texts(), 2)
    source, root = str(tmp_path / "in"), str(tmp_path / "views")
    for run in ("r1", "r2"):
        jobs.start_views(
            file_messages(spark, source, True), root, run, str(tmp_path / run), jobs.DROP, ONCE,
            views=["page_details_by_page_id"], decode=parse_envelope,
        ).awaitTermination()
    events = accepted(parse_envelope(file_messages(spark, source)))
    name = "page_details_by_page_id"
    assert tuples(viewlog.read(spark, root, name)) == tuples(build(events, name))


def test_write_errors_fail_the_query(spark, tmp_path):
    land(tmp_path / "in", texts(), 1)
    (tmp_path / "views").write_text("a file where a folder must be")
    query = jobs.start_views(
        file_messages(spark, str(tmp_path / "in"), True), str(tmp_path / "views"), "r",
        str(tmp_path / "c"), jobs.DROP, ONCE, decode=parse_envelope,
    )
    with pytest.raises(Exception):
        query.awaitTermination()


def test_closed_hours_equal_the_batch_report(spark, tmp_path):
    rows = [
        event(f"2024-01-01 {h:02d}:{m:02d}:{s:02d}", domain=d, created_by_bot=b)
        for h in range(5) for m in (0, 30, 59) for s in (0, 0, 59)
        for d in ("a.org", "b.org") for b in (True, False)
    ]
    folder = tmp_path / "in"
    folder.mkdir()
    for h in range(5):
        hour = events_frame(spark, [row for row in rows if row["time"].hour == h])
        lines = [row.value for row in to_wire(hour).collect()]
        (folder / f"{h}.txt").write_text("\n".join(lines) + "\n")
        os.utime(folder / f"{h}.txt", (1_700_000_000 + h,) * 2)
    stream = accepted(from_wire(file_messages(spark, str(folder), True, maxFilesPerTrigger=1)))
    jobs.start_hourly(
        stream, str(tmp_path / "hours"), str(tmp_path / "c"), trigger=ONCE
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "hours"))
    want = reports.hourly_domain_stats(events_frame(spark, rows)).filter(
        F.col("hour") < F.timestamp_seconds(F.lit(1_704_067_200 + 3 * 3600))
    )
    assert tuples(got) == tuples(want)
    assert got.count() == 6


def test_late_events_are_dropped_by_the_stream_only(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    batches = [
        [event("2024-01-01 00:10:00"), event("2024-01-01 05:00:00")],
        [event("2024-01-01 05:30:00")],
        [event("2024-01-01 00:20:00")],
        [event("2024-01-01 09:00:00")],
    ]
    for i, batch in enumerate(batches):
        lines = [row.value for row in to_wire(events_frame(spark, batch)).collect()]
        (folder / f"{i}.txt").write_text("\n".join(lines) + "\n")
        os.utime(folder / f"{i}.txt", (1_700_000_000 + i,) * 2)
    stream = accepted(from_wire(file_messages(spark, str(folder), True, maxFilesPerTrigger=1)))
    jobs.start_hourly(
        stream, str(tmp_path / "hours"), str(tmp_path / "c"), trigger=ONCE
    ).awaitTermination()
    hours = spark.read.parquet(str(tmp_path / "hours")).orderBy("hour").collect()
    assert [row.pages_created for row in hours] == [1, 2]
    everything = events_frame(spark, [row for batch in batches for row in batch])
    first = reports.hourly_domain_stats(everything).orderBy("hour").first()
    assert first.pages_created == 2

import random
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import event, events_frame, tuples
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pagetide import snapshots
from pagetide.functions.timing import report_bounds
from pagetide.operators import documents, viewlog
from pagetide.operators.report_reader import read_document
from pagetide.operators.views import EVENT_LOG, SPECS, build, merge, project
from pagetide.schemas import HOURLY_REPORT

T = "2024-01-01 00:00:01"
LATER = "2024-01-01 00:00:02"


def built(spark, rows, view):
    return tuples(build(events_frame(spark, rows), view))


def test_one_second_of_a_domain_is_one_row(spark):
    rows = [event(T, page_id=1), event(T, page_id=2), event(T, page_id=3, created_by_bot=True)]
    assert len(built(spark, rows, "domain_page_stats")) == 2


def test_one_second_of_a_user_keeps_the_later_title(spark):
    rows = [event(T, page_title="old", seq=1), event(T, page_title="new", seq=2)]
    assert [row[3] for row in built(spark, rows, "user_stat")] == ["new"]


def test_equal_time_and_seq_is_still_deterministic(spark):
    rows = [event(T, page_title="a"), event(T, page_title="b")]
    for order in (rows, rows[::-1]):
        assert [row[3] for row in built(spark, order, "user_stat")] == ["b"]


def test_page_id_repeats_across_domains(spark):
    rows = [event(T, domain="a.org"), event(LATER, domain="b.org")]
    assert len(built(spark, rows, "domain_page_counts")) == 2
    assert [row[2] for row in built(spark, rows, "page_details_by_page_id")] == ["b.org"]
    wider = SPECS["page_details_by_page_id"].with_key("domain", "page_id")
    assert len(built(spark, rows, wider)) == 2


def test_latest_by_time_before_seq(spark):
    rows = [event(LATER, page_title="late", seq=1), event(T, page_title="early", seq=2)]
    assert built(spark, rows, "pages_by_user") == [(1, 1, "late")]


def test_null_values_do_not_hide_a_later_row(spark):
    rows = [event(T, page_title="early"), event(LATER, page_title=None)]
    assert built(spark, rows, "pages_by_user") == [(1, 1, None)]


def test_one_row_per_day_and_user(spark):
    rows = [event(T, username="x"), event(LATER, username="y"), event("2024-01-02 00:00:00")]
    assert [row[2] for row in built(spark, rows, "page_creations_by_time")] == ["y", "one"]


def test_events_without_a_user_reach_the_other_views(spark):
    rows = [event(T, user_id=None)]
    kept = {name for name in SPECS if built(spark, rows, name)}
    assert kept == set(SPECS) - {"user_stat", "pages_by_user", "page_creations_by_time"}


seconds = st.integers(0, 3)
small = st.integers(1, 2)
random_events = st.lists(
    st.tuples(seconds, small, small, small, st.booleans(), st.sampled_from(["x", "y", None])),
    max_size=12,
)


@settings(max_examples=8, deadline=None)
@given(random_events)
def test_latest_is_idempotent_and_matches_a_plain_loop(spark, picks):
    rows = [
        event(
            f"2024-01-0{d} 00:00:0{s}", user_id=u, page_id=p, created_by_bot=b, page_title=t, seq=i
        )
        for i, (s, d, u, p, b, t) in enumerate(picks)
    ]
    frame = events_frame(spark, rows)
    for name, spec in SPECS.items():
        best = {}
        for row in sorted(rows, key=lambda r: (r["time"], r["seq"])):
            row = {**row, "day": row["time"].date(), "time": int(row["time"].timestamp())}
            best[tuple(row[k] for k in spec.key)] = tuple(row[c] for c in spec.columns)
        view = build(frame, name)
        if "time" in spec.columns:
            view = view.withColumn("time", F.unix_timestamp("time"))
        assert tuples(view) == sorted(best.values(), key=str)

        stored = merge(project(frame, name), name)
        assert tuples(merge(stored, name)) == tuples(stored)


# Stored views


def sample(n=60):
    pick = random.Random(7)
    return [
        event(
            f"2024-01-0{pick.randint(1, 3)} 0{pick.randint(0, 9)}:00:0{pick.randint(0, 2)}",
            domain=pick.choice(["a.org", "b.org"]),
            user_id=pick.randint(1, 4),
            username=pick.choice(["x", "y"]),
            page_id=pick.randint(1, 15),
            page_title=pick.choice(["p", "q", "r"]),
            created_by_bot=pick.random() < 0.3,
            seq=i,
        )
        for i in range(n)
    ]


def assert_views(spark, root, rows):
    frame = events_frame(spark, rows)
    for name in SPECS:
        assert tuples(viewlog.read(spark, root, name)) == tuples(build(frame, name)), name


@pytest.mark.parametrize("parts", [1, 2, 6])
def test_shuffled_batches_equal_one_batch(spark, tmp_path, parts):
    rows = sample()
    mixed = random.Random(parts).sample(rows, len(rows))
    for i in range(parts):
        batch = events_frame(spark, mixed[i::parts])
        viewlog.write_batch(batch, str(tmp_path), "r1", i)
    assert_views(spark, str(tmp_path), rows)


def test_replay_new_run_empty_batch_and_compaction(spark, tmp_path):
    root, rows = str(tmp_path / "log"), sample()
    first, second = events_frame(spark, rows[:30]), events_frame(spark, rows[30:])
    viewlog.write_batch(first, root, "r1", 0)
    before = {name: viewlog.scan(spark, root, name).count() for name in SPECS}
    viewlog.write_batch(first, root, "r1", 0)
    assert before == {name: viewlog.scan(spark, root, name).count() for name in SPECS}

    viewlog.write_batch(first.limit(0), root, "r1", 0)
    assert_views(spark, root, rows[:30])

    viewlog.write_batch(second, root, "r2", 0)
    assert_views(spark, root, rows)

    viewlog.compact(spark, root)
    assert_views(spark, root, rows)
    for name in SPECS:
        stored = viewlog.scan(spark, root, name)
        assert tuples(stored, *SPECS[name].columns) == tuples(build(events_frame(spark, rows), name))

    viewlog.write_batch(first, root, "r3", 0)
    viewlog.compact(spark, root)
    assert_views(spark, root, rows)
    # The log keeps each batch: the first of both runs, and the second.
    assert viewlog.read(spark, root, EVENT_LOG).count() == 30 + len(rows)


def log_of(spark, root):
    return tuples(viewlog.read(spark, root, EVENT_LOG))


def test_a_replay_after_a_compaction_changes_nothing(spark, tmp_path):
    """Also when the folder of the batch has gone, and in a run whose numbers go on."""
    root, rows = str(tmp_path), sample()
    batches = [events_frame(spark, rows[at : at + 20]) for at in (0, 20, 40)]
    for number in (0, 1):
        viewlog.write_batch(batches[number], root, "r", number)
    want = log_of(spark, root)
    assert len(want) == 40
    for _ in range(3):
        viewlog.compact(spark, root)
        assert log_of(spark, root) == want
        viewlog.write_batch(batches[1], root, "r", 1)
        viewlog.write_batch(batches[0], root, "r", 0)
        assert log_of(spark, root) == want
    assert not list(tmp_path.glob(f"{EVENT_LOG}/live/run=*/batch_id=*"))
    viewlog.write_batch(batches[2], root, "r", 2)
    viewlog.write_batch(batches[2], root, "r", 2)
    assert_views(spark, root, rows)
    assert len(log_of(spark, root)) == 60
    # A new run starts its numbers again.
    viewlog.write_batch(batches[0], root, "s", 0)
    assert len(log_of(spark, root)) == 80
    with pytest.raises(ValueError, match="run"):
        viewlog.write_batch(batches[0], root, "a/b", 0)


def test_a_batch_that_was_not_finished_is_not_there(spark, tmp_path, monkeypatch):
    root, rows, name = str(tmp_path), sample(), "user_stat"
    save = viewlog._save

    def cut(frame, *args):
        save(frame.limit(3), *args)
        raise OSError("lost")

    monkeypatch.setattr(viewlog, "_save", cut)
    with pytest.raises(OSError, match="lost"):
        viewlog.write_batch(events_frame(spark, rows), root, "r", 0, [name])
    monkeypatch.setattr(viewlog, "_save", save)
    assert viewlog.read(spark, root, name).collect() == []
    viewlog.write_batch(events_frame(spark, rows), root, "r", 0, [name])
    assert tuples(viewlog.read(spark, root, name)) == tuples(build(events_frame(spark, rows), name))


@pytest.mark.parametrize("name", ["page_details_by_page_id", "user_stat"])
def test_a_batch_written_during_a_compaction_stays(spark, tmp_path, monkeypatch, name):
    root, rows = str(tmp_path), sample()
    viewlog.write_batch(events_frame(spark, rows[:30]), root, "r", 0, [name])
    save = viewlog._save

    def save_while_a_batch_arrives(*args):
        monkeypatch.setattr(viewlog, "_save", save)
        viewlog.write_batch(events_frame(spark, rows[30:]), root, "r", 1, [name])
        save(*args)
        # The new base is there at this moment, but no snapshot names it.
        current = viewlog.read(spark, root, name)
        assert tuples(current) == tuples(build(events_frame(spark, rows), name))

    monkeypatch.setattr(viewlog, "_save", save_while_a_batch_arrives)
    viewlog.compact(spark, root, [name])
    current = viewlog.read(spark, root, name)
    assert tuples(current) == tuples(build(events_frame(spark, rows), name))


BUCKETED = [name for name in SPECS if viewlog.in_buckets(name)]


def test_buckets_hold_what_merged_batches_give(spark, tmp_path, monkeypatch):
    """Batches in any order and twice, and only the buckets of a batch are written again."""
    assert BUCKETED == ["distinct_domains", "pages_by_user", "domain_page_counts", "page_details_by_page_id"]
    root, rows = str(tmp_path), sample()
    mixed = random.Random(2).sample(rows, len(rows))
    for number in range(4):
        batch = events_frame(spark, mixed[number::4])
        for _ in range(2):
            viewlog.write_batch(batch, root, "r", number, list(SPECS), buckets=4)
    viewlog.compact(spark, root)
    assert_views(spark, root, rows)
    for name in BUCKETED:
        assert tuples(viewlog.scan(spark, root, name), *SPECS[name].columns) == tuples(
            build(events_frame(spark, rows), name)
        )
    name, folder = BUCKETED[-1], f"{root}/{BUCKETED[-1]}"
    before = snapshots.current(spark, folder)[1]["buckets"]
    reader = viewlog.read(spark, root, name)
    viewlog.write_batch(events_frame(spark, [event(LATER, page_id=1000)]), root, "s", 0, [name], 4)
    after = snapshots.current(spark, folder)[1]["buckets"]
    assert sum(after[bucket] != before.get(bucket) for bucket in after) == 1
    assert viewlog.read(spark, root, name).count() == reader.count() + 1
    viewlog.write_batch(events_frame(spark, []), root, "s", 1, [name], 4)
    assert viewlog.read(spark, root, name).count() == reader.count() + 1
    with pytest.raises(ValueError, match="buckets"):
        viewlog.write_batch(events_frame(spark, rows), root, "s", 2, [name])
    # Folders that nobody names go when readers have had their time.
    monkeypatch.setattr(snapshots.retired, "__defaults__", (-1,))
    viewlog.write_batch(events_frame(spark, [event(LATER, page_id=1001)]), root, "s", 2, [name], 4)
    left = {path.relative_to(f"{folder}/base").as_posix() for path in tmp_path.glob(f"{name}/base/version=*/bucket=*")}
    assert left == set(snapshots.current(spark, folder)[1]["buckets"].values())
    assert viewlog.read(spark, root, name).count() == len({row["page_id"] for row in rows}) + 2


def test_a_reader_that_started_before_a_compaction_ends_well(spark, tmp_path):
    root, rows, name = str(tmp_path), sample(), "pages_by_user"
    for number in range(3):
        viewlog.write_batch(events_frame(spark, rows[number * 20 :][:20]), root, "r", number, [name])
        before = viewlog.read(spark, root, name)
        viewlog.compact(spark, root, [name])
        want = build(events_frame(spark, rows[: number * 20 + 20]), name)
        assert tuples(before) == tuples(want) == tuples(viewlog.read(spark, root, name))


def test_a_reader_in_a_loop_never_fails(spark, tmp_path):
    """Beside a stream of batches, compactions and published reports."""
    root, out, rows, stop = str(tmp_path / "v"), str(tmp_path / "o"), sample(), threading.Event()
    names, bounds = ["domain_page_stats", EVENT_LOG], report_bounds("2024-01-02 10:30:00")
    viewlog.write_batch(events_frame(spark, rows[:10]), root, "r", 0, names)
    publish(spark, root, out, bounds)
    sizes, reports = [], []

    def read():
        while not stop.is_set():
            sizes.append([viewlog.read(spark, root, name).count() for name in names])
            reports.append(sum(row.pages_created for row in read_document(spark, out, HOURLY_REPORT).collect()))

    with ThreadPoolExecutor(1) as pool:
        reader = pool.submit(read)
        for number in range(1, 6):
            viewlog.write_batch(events_frame(spark, rows[number * 10 :][:10]), root, "r", number, names)
            viewlog.compact(spark, root, names)
            publish(spark, root, out, bounds)
        stop.set()
        reader.result()
    assert sizes == sorted(sizes) and reports == sorted(reports) and len(sizes) > 3
    assert viewlog.read(spark, root, EVENT_LOG).count() == len(rows)
    # Of old versions, one is kept.
    assert len(list((tmp_path / "o" / HOURLY_REPORT).glob("version-*"))) == 2


def publish(spark, root, out, bounds):
    rows = viewlog.scan(spark, root, "domain_page_stats", bounds)
    documents.publish(spark, rows, rows, bounds, out, names=[HOURLY_REPORT])


def test_a_compaction_rewrites_the_days_it_has_rows_of(spark, tmp_path):
    root, name = str(tmp_path), "user_stat"
    first = [event(f"2024-01-0{day} 05:00:00") for day in (1, 2, 3)]
    viewlog.write_batch(events_frame(spark, first), root, "r", 0, [name])
    viewlog.compact(spark, root, [name])
    viewlog.write_batch(events_frame(spark, [event("2024-01-02 06:00:00")]), root, "r", 1, [name])
    viewlog.compact(spark, root, [name])
    number, content = snapshots.current(spark, f"{root}/{name}")
    assert number == 2
    versions = {path[-10:]: path.split("-")[0] for path in content["base"]}
    assert versions == {"2024-01-01": "version=1", "2024-01-02": "version=2", "2024-01-03": "version=1"}
    assert viewlog.read(spark, root, name).count() == 4
    with pytest.raises(Exception, match="[Ee]xist"):
        snapshots.publish(spark, f"{root}/{name}", number, content)


def test_an_unfinished_snapshot_is_not_read(spark, tmp_path):
    folder = str(tmp_path)
    assert snapshots.current(spark, folder) == (0, None)
    snapshots.publish(spark, folder, 1, {"a": 1})
    (tmp_path / "snapshots" / "2").write_text('{"a": ')
    assert snapshots.current(spark, folder) == (1, {"a": 1})
    snapshots.publish(spark, folder, 2, {"a": 2})
    assert snapshots.current(spark, folder) == (2, {"a": 2})


def test_lookups_of_missing_keys_read_no_rows(spark, tmp_path):
    """Bloom filters of compacted files: the keys lie inside the range of each file."""
    root, name = str(tmp_path), "page_details_by_page_id"
    rows = [event("2024-01-01 05:00:00", page_id=2 * i, user_id=4 * i) for i in range(20_000)]
    viewlog.write_batch(events_frame(spark, rows), root, "r", 0, [name])
    viewlog.compact(spark, root, [name])
    for column, missing, there in (("page_id", 20_001, 20_002), ("user_id", 40_002, 40_004)):
        for key, expected in ((missing, 0), (there, 1)):
            found = viewlog.scan(spark, root, name).filter(F.col(column) == key)
            assert len(found.collect()) == expected
            read = rows_read(found)
            assert read == 0 if key == missing else 0 < read


def rows_read(frame):
    """Rows that the scans of a collected frame gave."""
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(
        leaves.apply(at).metrics().get("numOutputRows").get().value() for at in range(leaves.size())
    )


def test_folders_after_many_batches_are_bounded_by_days(spark, tmp_path):
    root, rows, name = str(tmp_path), sample(), "user_stat"
    for number in range(100):
        batch = events_frame(spark, rows[number % len(rows) :][:1])
        viewlog.write_batch(batch.coalesce(1), root, "r", number, [name])
    viewlog.compact(spark, root, [name])
    viewlog.compact(spark, root, [name])
    days = {row["time"].date() for row in rows if row["time"]}
    assert len(list(tmp_path.glob(f"{name}/base/version=*/day=*"))) <= len(days)
    assert not list(tmp_path.glob(f"{name}/live/run=*/batch_id=*"))
    assert tuples(viewlog.read(spark, root, name)) == tuples(build(events_frame(spark, rows), name))


def test_scan_prunes_days_and_refuses_unsafe_filters(spark, tmp_path):
    viewlog.write_batch(events_frame(spark, sample()), str(tmp_path), "r", 0)
    bounds = report_bounds("2024-01-02 09:30:00")
    rows = viewlog.scan(spark, str(tmp_path), "user_stat", bounds)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "GreaterThanOrEqual(time" in plan
    assert {str(day) for (day,) in tuples(rows, "day")} == {"2024-01-02"}
    with pytest.raises(ValueError):
        viewlog.scan(spark, str(tmp_path), "page_details_by_page_id", bounds)

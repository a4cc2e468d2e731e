"""What the plans must keep doing for large data."""

import re
from contextlib import contextmanager
from pathlib import Path

import pytest
from helpers import event, events_frame
from pyspark.sql import functions as F

from pagetide.operators import documents, lookups, reports, viewlog
from pagetide.operators.views import SPECS, build
from pagetide.plans.queries import QUERIES, WINDOW
from pagetide.sources.event_table import as_page_creates

FOLDER = "/root/testdata/sf0.001"
# These run jobs when called, and their result is a plain read of what the jobs wrote.
WRITING = re.compile(r"^(sse_|streamed_|stored_|hourly_stream|compacted_|partial_|upserted_)|_document$")
# Their ranks are numbered on as many rows as are asked for.
RANKED = re.compile(r"^top_")
# Its windows hold the days of one user.
BY_USER = re.compile(r"^lookup_days_of_requests$")


@contextmanager
def configured(spark, settings):
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not WRITING.search(n)])
def test_no_cross_join_or_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas"):
        assert operator not in plan
    if RANKED.search(name):
        # What stands below the limit; every branch of the plan holds the same one.
        counted = _below(plan, "TakeOrderedAndProject")
        assert counted and "Window " not in counted and "SinglePartition" not in counted
    else:
        assert ("Window " not in plan or BY_USER.search(name)) and "SinglePartition" not in plan


def _below(plan, operator):
    """The lines of the subtree of the first such operator, itself left out."""
    lines = plan.split("\n")
    depth = [len(re.match(r"[\s:+-]*", line)[0]) for line in lines]
    top = next(at for at, line in enumerate(lines) if operator in line)
    end = next((at for at in range(top + 1, len(lines)) if depth[at] <= depth[top]), len(lines))
    return "\n".join(lines[top + 1 : end])


def test_users_are_counted_in_hash_aggregates(spark):
    """But for seconds with two names of a user, which are looked at row by row."""
    rows = as_page_creates(spark.read.parquet(f"{FOLDER}/events.parquet"))
    plan = plan_of(reports.user_counts(rows))
    assert "partial_bit_or" in plan and "SortAggregate" not in plan and "Join" not in plan

    named = F.when(F.col("page_id") % 7 == 0, F.lit("other")).otherwise(F.col("username"))
    plan = plan_of(reports.user_counts(rows.withColumn("username", named)))
    above = plan[: plan.index("Union")]
    plain = _below(plan, "BroadcastHashJoin" if "BroadcastHashJoin" in plan else "SortMergeJoin")
    assert "HashAggregate" in above and "SortAggregate" not in above
    assert "partial_bit_or" in plain and "SortAggregate" not in plain


def test_documents_are_written_without_a_single_task(spark, tmp_path, monkeypatch):
    seen = {}
    lines = documents._lines
    monkeypatch.setattr(
        documents, "_lines", lambda name, *args: seen.setdefault(name, lines(name, *args))
    )
    frame = events_frame(spark, [event("2024-01-16 05:00:00", created_by_bot=True)])
    documents.publish(spark, frame, frame, WINDOW, str(tmp_path))
    assert len(seen) == 3
    for found in seen.values():
        plan = plan_of(found.orderBy(*documents._ORDER))
        assert "SinglePartition" not in plan and "collect_list" not in plan
        assert "rangepartitioning" in plan


@pytest.mark.parametrize(
    "name", ["hourly_domain_stats", "bot_domain_stats", "top_20_users", "user_active_days_range"]
)
def test_the_window_reaches_the_scan(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    scans = re.findall(r"PushedFilters: \[[^\]]*\]", plan)
    assert scans and all("GreaterThanOrEqual(ts" in scan for scan in scans)


def test_only_used_columns_are_read(spark):
    plan = plan_of(QUERIES["hourly_domain_stats_all"](spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_second_masks_stay_in_hash_aggregates(spark):
    plan = plan_of(reports.hourly_domain_stats(events_frame(spark, [event("2024-01-01 00:00:00")])))
    assert "SortAggregate" not in plan and "partial_bit_or" in plan


@pytest.mark.parametrize("name", list(SPECS))
def test_views_aggregate_before_their_only_shuffle(spark, name):
    plan = plan_of(build(events_frame(spark, [event("2024-01-01 00:00:00")]), name))
    assert plan.count("Exchange") == 1
    assert len(re.findall("(?:Sort|Hash)Aggregate", plan)) == 2


def test_a_hot_key_sends_one_row_per_task(spark):
    rows = spark.range(0, 100_000, 1, 7).select(
        F.timestamp_seconds(F.lit(1_704_067_200)).alias("time"),
        F.lit("a.org").alias("domain"),
        F.lit(True).alias("created_by_bot"),
        F.lit(1).cast("bigint").alias("user_id"),
        F.lit("one").alias("username"),
        F.concat(F.lit("T"), "id").alias("page_title"),
        F.lit(1).cast("bigint").alias("page_id"),
        F.col("id").alias("seq"),
    )
    for name in SPECS:
        frame = build(rows, name)
        assert len(frame.collect()) == 1
        final = frame._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        assert _shuffled_rows(frame) == 7


def _shuffled_rows(frame):
    """Rows written by the shuffles of an executed frame."""
    total, nodes = 0, [frame._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
            continue
        if "QueryStage" in kind:
            nodes.append(node.plan())
            continue
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        nodes.extend(children.apply(i) for i in range(children.size()))
    return total


def test_a_hot_user_is_split_in_a_large_key_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    pages = spark.range(60_000).repartition(8).select(
        F.when(F.col("id") % 3 != 0, 7).otherwise(F.col("id")).cast("bigint").alias("user_id"),
        F.col("id").alias("page_id"),
        F.concat(F.lit("T"), "id").alias("page_title"),
        F.timestamp_seconds(F.col("id")).alias("time"),
        F.col("id").alias("seq"),
    )
    with configured(spark, settings):
        found = lookups.pages_by_user(
            build(pages, "pages_by_user"), spark.range(0, 60_000, 2).union(spark.range(7, 8))
        )
        assert len(found.collect()) == 40_000 + 10_000
        assert "skew=true" in plan_of(found)


def test_a_busy_day_is_written_by_several_tasks(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    busy = spark.range(80_000).repartition(8).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).alias("time"),
        (F.col("id") % 9).alias("user_id"),
        F.lit("one").alias("username"),
        F.concat(F.lit("T"), "id").alias("page_title"),
        F.col("id").alias("seq"),
    )
    with configured(spark, settings):
        viewlog.write_batch(busy, str(tmp_path), "r", 0, ["user_stat"])
    assert len(list(tmp_path.glob("user_stat/live/run=r/batch_id=0/day=2024-01-01/part-*"))) > 1
    assert viewlog.read(spark, str(tmp_path), "user_stat").count() == 80_000


def test_stored_lookups_reach_the_scan(spark, tmp_path):
    rows = [event(f"2024-01-0{d} 00:00:00", user_id=u) for d in (1, 2) for u in (1, 2)]
    viewlog.write_batch(events_frame(spark, rows), str(tmp_path), "r", 0)
    plan = plan_of(lookups.pages_by_user(viewlog.read(spark, str(tmp_path), "pages_by_user"), [1, 2]))
    assert "PushedFilters: [In(user_id, [1,2])" in plan
    view = viewlog.read(spark, str(tmp_path), "page_creations_by_time")
    plan = plan_of(lookups.user_active_days_range(view, "2024-01-02", "2024-01-02"))
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ [>=]+ 2024-01-02", plan)


def test_stored_window_prunes_days(spark, tmp_path):
    viewlog.write_batch(events_frame(spark, [event("2024-01-16 05:00:00")]), str(tmp_path), "r", 0)
    rows = viewlog.scan(spark, str(tmp_path), "domain_page_stats", WINDOW)
    plan = plan_of(reports.bot_domain_stats(rows, WINDOW))
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 2024-01-16", plan)
    assert "EqualTo(created_by_bot,true)" in plan or "created_by_bot" in plan


def test_buckets_are_looked_up_without_a_merge(spark, tmp_path):
    root, name = str(tmp_path), "page_details_by_page_id"
    for number in range(3):
        rows = [event("2024-01-16 05:00:00", page_id=i, seq=number) for i in range(0, 300, number + 1)]
        viewlog.write_batch(events_frame(spark, rows), root, "r", number, [name], buckets=8)
    view = viewlog.read(spark, root, name)
    plan = plan_of(view.filter(F.col("page_id") == 7))
    for operator in ("Aggregate", "Exchange", "Sort", "Union"):
        assert operator not in plan
    assert "EqualTo(page_id,7)" in plan
    assert view.count() == 300


def test_redelivered_frames_are_read_in_batches_by_size(spark, tmp_path):
    """More files are not more batches: there are two of data, and one that closes each run."""
    events = spark.range(120).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.col("id") + 1705000000).alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit('{"k": 1}').alias("props"),
    )
    root = spark.conf.get("spark.checkpoint.dir")
    for files in (1, 6):
        folder = tmp_path / f"of-{files}"
        events.repartitionByRange(files, "event_id").write.parquet(f"{folder}/events.parquet")
        with configured(spark, {"spark.sql.files.openCostInBytes": str(2**27)}):
            assert QUERIES["sse_redelivered"](spark, str(folder)).count() == 120
        (work,) = Path(root).glob("pagetide-sse_redelivered-redelivered-*/data")
        assert len(list(work.glob("feed/part-*"))) == 2 * files
        assert len(list(work.glob("check/commits/[0-9]*"))) <= 4

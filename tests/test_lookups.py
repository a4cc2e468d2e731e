from helpers import event, events_frame, tuples

from pagetide.operators import lookups
from pagetide.operators.views import build


def frame(spark):
    return events_frame(
        spark,
        [
            event("2024-01-01 00:00:00", page_id=2, page_title="B"),
            event("2024-01-01 00:00:01", page_id=1, page_title="A"),
            event("2024-01-01 05:00:01", page_id=3, page_title="C", username="renamed"),
            event("2024-01-02 00:00:01", page_id=4, domain="b.org", user_id=2, username="two"),
            event("2024-01-03 00:00:00", page_id=5, username="last"),
        ],
    )


def keys(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"k {kind}")


def test_domains(spark):
    view = build(frame(spark), "distinct_domains")
    assert tuples(lookups.domains(view)) == [("a.org",), ("b.org",)]
    assert tuples(lookups.domains(view.limit(0))) == []


def test_pages_by_user(spark):
    view = build(frame(spark), "pages_by_user")
    for users in ([1, 77], keys(spark, [1, 1, None, 77], "bigint")):
        found = [tuple(row) for row in lookups.pages_by_user(view, users, True).collect()]
        assert found == [(1, 1, "A"), (1, 2, "B"), (1, 3, "C"), (1, 5, "T")]


def test_only_answers_to_lists_are_sorted(spark):
    view = build(frame(spark), "pages_by_user")
    sort = "rangepartitioning"
    for users, sorted_by_default in (([1], True), (keys(spark, [1], "bigint"), False)):
        plan = lookups.pages_by_user(view, users)._jdf.queryExecution().executedPlan().toString()
        assert (sort in plan) == sorted_by_default


def test_long_lists_of_keys_are_filters_too(spark):
    many = [*range(1, 3000), 2]
    view = build(frame(spark), "pages_by_user")
    assert lookups.pages_by_user(view, many).count() == 5
    plan = lookups.pages_by_user(view, many)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_domain_page_count(spark):
    view = build(frame(spark), "domain_page_counts")
    for names in (["a.org", "none.org"], keys(spark, ["a.org", "none.org", "a.org"], "string")):
        assert tuples(lookups.domain_page_count(view, names)) == [("a.org", 4), ("none.org", 0)]


def test_page_details(spark):
    view = build(frame(spark), "page_details_by_page_id")
    for pages in ([4, 99, None], keys(spark, [4, 99, None], "bigint")):
        rows = lookups.page_details(view, pages).orderBy("page_id").collect()
        assert [row.domain for row in rows] == ["b.org", None]
        assert [row.page_id for row in rows] == [4, 99]


def test_day_ranges(spark):
    view = build(frame(spark), "page_creations_by_time")
    active = lookups.user_active_days_range
    assert tuples(active(view, "2024-01-01", "2024-01-03")) == [(1, "renamed", 2), (2, "two", 1)]
    assert tuples(active(view, "2024-01-02", "2024-01-02")) == [(2, "two", 1)]
    assert tuples(active(view, "2024-01-03", "2024-01-01")) == []
    created = lookups.user_pages_created_range
    assert tuples(created(frame(spark), "2024-01-01", "2024-01-02")) == [
        (1, "one", 3), (2, "two", 1),
    ]
    assert tuples(created(frame(spark), "2024-01-03", "2024-01-01")) == []

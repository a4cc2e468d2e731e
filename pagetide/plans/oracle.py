"""The registered queries as plain SQL over the same tables."""

EVENTS = """
pc AS (
  SELECT date_trunc('second', ts) AS time,
         event_type || '.example.org' AS domain,
         user_id % 5 = 0 AS created_by_bot,
         user_id,
         'user_' || CAST(user_id AS VARCHAR) AS username,
         'Title ' || regexp_extract(props, '[0-9]+') AS page_title,
         event_id % 4000 AS page_id,
         event_id AS seq
  FROM events
)"""


def _sql(body, *ctes):
    return "WITH " + ",\n".join([EVENTS.strip(), *ctes]) + "\n" + body.strip()


def _latest(name, key, where="TRUE", source="pc"):
    return f"""{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY time DESC, seq DESC) AS rn
    FROM {source} WHERE {where}
  ) ranked WHERE rn = 1
)"""


IN_WINDOW = "time >= TIMESTAMP '2024-01-16 04:00:00' AND time < TIMESTAMP '2024-01-16 11:00:00'"
IN_SIX_HOURS = "time >= TIMESTAMP '2024-01-16 05:00:00' AND time < TIMESTAMP '2024-01-16 11:00:00'"
IN_DAYS = "CAST(time AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'"
TIME_TEXT = "CAST(time AS VARCHAR) AS time"
DETAILS = f"page_id, page_title, domain, user_id, username, created_by_bot, {TIME_TEXT}"

NORMALIZED = _sql(
    f"SELECT {TIME_TEXT}, domain, created_by_bot, user_id, username, page_title, page_id FROM pc"
)
DOMAIN_STATS = _sql(f"SELECT DISTINCT {TIME_TEXT}, domain, created_by_bot FROM pc")
DETAILS_BY_PAGE = _sql(f"SELECT {DETAILS} FROM v6", _latest("v6", "page_id"))


def _hourly(where="TRUE", rows="SELECT DISTINCT time, domain, created_by_bot FROM pc"):
    return _sql(
        f"""
SELECT CAST(date_trunc('hour', time) AS VARCHAR) AS hour, domain, count(*) AS pages_created
FROM ({rows}) r WHERE {where}
GROUP BY date_trunc('hour', time), domain"""
    )


def _bots(where="TRUE", rows="SELECT DISTINCT time, domain, created_by_bot FROM pc"):
    return _sql(
        f"""
SELECT domain, count(*) AS created_by_bots
FROM ({rows}) r WHERE created_by_bot AND {where} GROUP BY domain"""
    )


TOP = """top AS (
  SELECT CAST(row_number() OVER (ORDER BY pages_created DESC, user_id, username) AS INTEGER) AS rank,
         user_id, username, pages_created
  FROM (
    SELECT user_id, username, count(*) AS pages_created FROM {rows}
    GROUP BY user_id, username
    ORDER BY pages_created DESC, user_id, username LIMIT 20
  ) counted
)"""

TOP_USERS = """
SELECT t.rank, t.user_id, t.username, {labels}t.pages_created, v.page_title
FROM top t JOIN v2 v ON v.user_id = t.user_id AND v.username = t.username"""

WINDOW_LABELS = "'04:00' AS time_start, '11:00' AS time_end, "


def _pages_by_user(where):
    return _sql(
        f"SELECT user_id, page_id, page_title FROM v4 WHERE {where}",
        _latest("v4", "user_id, page_id"),
    )


def _details_of(keys):
    return _sql(
        f"""
SELECT k.page_id, page_title, domain, user_id, username, created_by_bot, {TIME_TEXT}
FROM ({keys}) k LEFT JOIN v6 ON v6.page_id = k.page_id""",
        _latest("v6", "page_id"),
    )


VIEW_SIZES = {
    "domain_page_stats": "time, domain, created_by_bot",
    "user_stat": "time, user_id",
    "distinct_domains": "domain",
    "pages_by_user": "user_id, page_id",
    "domain_page_counts": "domain, page_id",
    "page_details_by_page_id": "page_id",
    "page_creations_by_time": "CAST(time AS DATE), user_id",
}

SAME_HOUR = "same_hour AS (SELECT * REPLACE (date_trunc('hour', time) AS time) FROM pc)"

ON_TIME = "page_id % 10 <> 3"
CLOSED = (
    "date_trunc('hour', time) + INTERVAL 1 HOUR <= (SELECT max(time) - INTERVAL 1 HOUR FROM pc{on_time})"
)

ORACLE = {
    "normalize_page_creates": NORMALIZED,
    "wire_round_trip": NORMALIZED,
    "sse_normalized": NORMALIZED,
    "sse_crlf_normalized": NORMALIZED,
    "sse_to_views": _sql("SELECT DISTINCT domain FROM pc"),
    "quarantine_counts": """
SELECT problem, count(*) AS messages FROM (
  SELECT CASE event_type
           WHEN 'error' THEN 'bad_json'
           WHEN 'click' THEN 'bad_json'
           WHEN 'view' THEN 'bad_json'
           WHEN 'signup' THEN 'bad_time'
           WHEN 'purchase' THEN 'no_key: user_stat, pages_by_user, page_creations_by_time'
         END AS problem
  FROM events
) p WHERE problem IS NOT NULL GROUP BY problem""",
    "view_domain_page_stats": DOMAIN_STATS,
    "view_user_stat": _sql(
        f"SELECT {TIME_TEXT}, user_id, username, page_title FROM v2",
        _latest("v2", "time, user_id"),
    ),
    "view_distinct_domains": _sql("SELECT DISTINCT domain FROM pc"),
    "view_pages_by_user": _pages_by_user("TRUE"),
    "view_domain_page_counts": _sql("SELECT DISTINCT domain, page_id FROM pc"),
    "view_page_details": DETAILS_BY_PAGE,
    "view_page_details_per_domain": _sql(
        f"SELECT {DETAILS} FROM v6", _latest("v6", "domain, page_id")
    ),
    "view_page_creations_by_day": _sql(
        "SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS day, user_id, username FROM v7",
        _latest("v7", "CAST(time AS DATE), user_id"),
    ),
    "hourly_domain_stats": _hourly(IN_WINDOW),
    "hourly_domain_stats_6h": _hourly(IN_SIX_HOURS),
    "hourly_domain_stats_all": _hourly(),
    "hourly_domain_events_all": _hourly(rows="SELECT time, domain FROM pc"),
    "bot_domain_stats": _bots(IN_WINDOW),
    "bot_domain_stats_all": _bots(),
    "bot_domain_events_all": _bots(rows="SELECT * FROM pc"),
    "top_20_users": _sql(
        TOP_USERS.format(labels=""),
        _latest("v2", "time, user_id", IN_WINDOW),
        TOP.format(rows="v2"),
    ),
    "top_20_users_all": _sql(
        TOP_USERS.format(labels=""),
        _latest("v2", "time, user_id"),
        TOP.format(rows="v2"),
    ),
    "top_20_users_events_all": _sql("SELECT * FROM top", TOP.format(rows="pc")),
    "lookup_domains": _sql("SELECT DISTINCT domain FROM pc"),
    "lookup_pages_by_user": _pages_by_user("user_id IN (0, 7, 41, 149, 999999)"),
    "lookup_pages_by_customer": _pages_by_user("user_id IN (SELECT c_custkey FROM customer)"),
    "lookup_domain_page_count": _sql(
        """
SELECT k.domain, count(v.page_id) AS page_count
FROM (VALUES ('click.example.org'), ('view.example.org'), ('missing.example.org')) k(domain)
LEFT JOIN (SELECT DISTINCT domain, page_id FROM pc) v ON v.domain = k.domain
GROUP BY k.domain"""
    ),
    "lookup_page_details": _details_of(
        "SELECT * FROM (VALUES (0), (17), (3999), (999999)) i(page_id)"
    ),
    "lookup_details_of_pages": _details_of("SELECT DISTINCT page_id FROM pages"),
    "user_active_days_range": _sql(
        """
SELECT user_id, arg_min(username, time) AS username, count(*) AS page_count
FROM v7 GROUP BY user_id""",
        _latest("v7", "CAST(time AS DATE), user_id", IN_DAYS),
    ),
    "user_pages_created_range": _sql(
        f"""
SELECT user_id, min(username) AS username, count(*) AS pages_created
FROM pc WHERE {IN_DAYS} GROUP BY user_id"""
    ),
    "stored_pages_created_range": _sql(
        f"""
SELECT user_id, min(username) AS username, count(*) AS pages_created
FROM pc WHERE {IN_DAYS} GROUP BY user_id"""
    ),
    "hourly_report_document": _sql(
        f"""
SELECT strftime(date_trunc('hour', time), '%H:%M') AS time_start,
       strftime(date_trunc('hour', time) + INTERVAL 1 HOUR, '%H:%M') AS time_end,
       domain, count(*) AS pages_created
FROM (SELECT DISTINCT time, domain, created_by_bot FROM pc) r WHERE {IN_WINDOW}
GROUP BY date_trunc('hour', time), domain"""
    ),
    "bot_report_document": _sql(
        f"""
SELECT {WINDOW_LABELS}domain, count(*) AS created_by_bots
FROM (SELECT DISTINCT time, domain, created_by_bot FROM pc) r
WHERE created_by_bot AND {IN_WINDOW} GROUP BY domain"""
    ),
    "top_users_document": _sql(
        TOP_USERS.format(labels=WINDOW_LABELS),
        _latest("v2", "time, user_id", IN_WINDOW),
        TOP.format(rows="v2"),
    ),
    "stored_hourly_events": _hourly(IN_WINDOW, rows="SELECT time, domain FROM pc"),
    "compacted_page_details": DETAILS_BY_PAGE,
    "compacted_event_log": NORMALIZED,
    "upserted_pages_by_user": _pages_by_user("TRUE"),
    "sse_redelivered": NORMALIZED,
    "partial_hourly_stats": _hourly(),
    "hourly_stream_corrected": _hourly(),
    "partial_bot_stats": _bots(IN_WINDOW),
    "partial_top_20_users": _sql(
        TOP_USERS.format(labels=""),
        _latest("v2", "time, user_id", IN_WINDOW),
        TOP.format(rows="v2"),
    ),
    "stored_active_days": _sql(
        """
SELECT user_id, arg_min(username, time) AS username, count(*) AS page_count
FROM v7 GROUP BY user_id""",
        _latest("v7", "CAST(time AS DATE), user_id", IN_DAYS),
    ),
    "lookup_days_of_requests": _sql(
        """
SELECT r.request, r.user_id, count(d.day) AS active_days
FROM (
  SELECT c_custkey AS request, c_custkey % 200 AS user_id,
         DATE '2023-12-28' + CAST(c_custkey % 40 AS INTEGER) AS start_day,
         CAST(c_custkey % 11 AS INTEGER) - 1 AS days
  FROM customer
) r LEFT JOIN (SELECT DISTINCT user_id, CAST(time AS DATE) AS day FROM pc) d
  ON d.user_id = r.user_id AND d.day BETWEEN r.start_day AND r.start_day + r.days
GROUP BY r.request, r.user_id"""
    ),
    "streamed_domain_page_stats": DOMAIN_STATS,
    "streamed_page_details": DETAILS_BY_PAGE,
    "streamed_view_sizes": _sql(
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS view_name, count(*) AS rows_kept"
            f" FROM (SELECT DISTINCT {key} FROM pc) v"
            for name, key in VIEW_SIZES.items()
        )
    ),
    "streamed_user_stat": _sql(
        f"SELECT {TIME_TEXT}, user_id, username, page_title FROM v2",
        SAME_HOUR, _latest("v2", "time, user_id", source="same_hour"),
    ),
    "streamed_pages_by_user": _sql(
        "SELECT user_id, page_id, page_title FROM v4",
        SAME_HOUR, _latest("v4", "user_id, page_id", source="same_hour"),
    ),
    "streamed_page_details_same_second": _sql(
        f"SELECT {DETAILS} FROM v6", SAME_HOUR, _latest("v6", "page_id", source="same_hour")
    ),
    "hourly_stream": _hourly(CLOSED.format(on_time="")),
    "hourly_stream_late": _hourly(
        CLOSED.format(on_time=f" WHERE {ON_TIME}"),
        rows=f"SELECT DISTINCT time, domain, created_by_bot FROM pc WHERE {ON_TIME}",
    ),
}

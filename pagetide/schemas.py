"""Declared schemas. Nothing is inferred, and undeclared JSON fields are dropped."""

# Message layouts, field names and report names that other programs rely on.
ENVELOPE = (
    "meta struct<domain:string,dt:string>, "
    "performer struct<user_id:bigint,user_is_bot:boolean,user_text:string>, "
    "page_title string, page_id bigint"
)
COLUMN_TYPES = {
    "time": "timestamp",
    "domain": "string",
    "created_by_bot": "boolean",
    "user_id": "bigint",
    "username": "string",
    "page_title": "string",
    "page_id": "bigint",
}
FEED_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
HOUR_LABEL_FORMAT = "HH:mm"

HOURLY_REPORT = "hourly_domain_page_stats"
BOT_REPORT = "bot_created_domain_stats"
TOP_USERS_REPORT = "top_20_users"
REPORT_ROWS = {
    HOURLY_REPORT: "hour timestamp, domain string, pages_created bigint",
    BOT_REPORT: "domain string, created_by_bots bigint, time_start string, time_end string",
    TOP_USERS_REPORT: (
        "rank int, user_id bigint, username string, pages_created bigint, page_title string, "
        "time_start string, time_end string"
    ),
}
# End of fixed values.

PAGE_CREATE = tuple(COLUMN_TYPES)
PAGE_CREATE_DDL = ", ".join(f"{name} {kind}" for name, kind in COLUMN_TYPES.items())

# `seq` orders rows that carry the same time. The others are derived from `time`: a day, a minute
# with a mask of its seconds, and a span of days with a mask of them.
STORED_TYPES = {
    **COLUMN_TYPES,
    "seq": "bigint",
    "day": "date",
    "minute": "timestamp",
    "seconds": "bigint",
    "span": "bigint",
    "days": "bigint",
}


def ddl(columns):
    return ", ".join(f"{name} {STORED_TYPES[name]}" for name in columns)

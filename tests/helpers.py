import json
from datetime import datetime, timezone

from pagetide.schemas import PAGE_CREATE_DDL


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def event(time, **fields):
    row = {
        "domain": "a.org",
        "created_by_bot": False,
        "user_id": 1,
        "username": "one",
        "page_title": "T",
        "page_id": 1,
        "seq": 0,
    }
    row.update(fields)
    row["time"] = at(time) if time else None
    return row


def events_frame(spark, rows):
    names = [field.split()[0] for field in PAGE_CREATE_DDL.split(", ")] + ["seq"]
    data = [tuple(row[name] for name in names) for row in rows]
    return spark.createDataFrame(data, PAGE_CREATE_DDL + ", seq bigint")


def messages_frame(spark, texts):
    return spark.createDataFrame(
        [(text, i) for i, text in enumerate(texts)], "value string, seq bigint"
    )


def envelope(dt="2024-01-01T00:00:07Z", **changes):
    document = {
        "meta": {"domain": "a.org", "dt": dt, "stream": "ignored"},
        "performer": {"user_id": 5, "user_is_bot": True, "user_text": "five"},
        "page_title": "T",
        "page_id": 3_000_000_000,
        "comment": "ignored",
    }
    document.update(changes)
    return json.dumps(document)


def tuples(frame, *names):
    return sorted(map(tuple, (frame.select(*names) if names else frame).collect()), key=str)

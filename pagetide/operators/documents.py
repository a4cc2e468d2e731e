"""Published reports: rows in Parquet, and the same report as one JSON document in text lines.

A document may be of any size. It is built as lines, an entry each, that are sorted globally and
written as text: the part files, read in their order, are one JSON value. No report is gathered in
one row or one task.
"""

import uuid

from pyspark.sql import functions as F

from pagetide import snapshots
from pagetide.functions.timing import hour_end, hour_label
from pagetide.operators.reports import (
    KEYED,
    bot_domain_stats,
    bots_of_minutes,
    hourly_domain_stats,
    hourly_of_minutes,
    top_user_titles,
)
from pagetide.schemas import BOT_REPORT, HOURLY_REPORT, REPORT_ROWS
from pagetide.session import delete_folder, folders

# The order of lines: parts of the document, then groups, then what a group holds.
_ORDER = ("section", "group_key", "piece", "entry_key", "entry_number")


def _json(value):
    """JSON of one value, taken out of a list of one."""
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _field(name, value):
    return F.concat(F.lit(f'"{name}":'), value)


def _comma(is_first):
    return F.when(is_first, "").otherwise(",")


def _line(text, section, group=None, piece=0, key=None, number=None):
    """A line with its place in the document."""
    return [
        F.lit(section).alias("section"),
        (group if group is not None else F.lit("")).alias("group_key"),
        F.lit(piece).alias("piece"),
        (key if key is not None else F.lit("")).alias("entry_key"),
        (number if number is not None else F.lit(0)).cast("bigint").alias("entry_number"),
        text.alias("value"),
    ]


def _ends(spark, opening, closing):
    return spark.range(1).select(*_line(opening, 0)).union(
        spark.range(1).select(*_line(closing, 2))
    )


def _labels(bounds):
    """Labels of the window, worked out on the driver."""
    return [moment.strftime("%H:%M") for moment in bounds]


# Texts of the lines, each from its values, without the comma before it.


def _span(start, end):
    return F.concat(_field("time_start", _json(start)), F.lit(","), _field("time_end", _json(end)))


def hour_head(start, end):
    return F.concat(F.lit("{"), _span(start, end), F.lit(',"statistics":['))


bot_head = hour_head


def hour_entry(domain, count):
    return F.to_json(F.create_map(domain, count))


def bot_entry(domain, count):
    return F.to_json(F.struct(domain.alias("domain"), count.alias("created_by_bots")))


def user_head(user_id, username, start, end):
    named = F.concat(_field("username", _json(username)), F.lit(","))
    return F.concat(
        F.lit("{"),
        _field("user_id", user_id.cast("string")),
        F.lit(","),
        F.when(username.isNull(), "").otherwise(named),
        _span(start, end),
        F.lit(',"page_titles":['),
    )


def title_entry(title):
    return _json(title)


def user_tail(count):
    return F.concat(F.lit("],"), _field("pages_created", count.cast("string")), F.lit("}"))


# The lines of each report.


def hourly_lines(rows):
    """An array of labelled hours, each with a list of one-entry maps from domain to count."""
    spark, hour = rows.sparkSession, F.col("hour").cast("string")
    earliest = rows.agg(F.min("hour").alias("hour")).first().hour
    firsts = rows.groupBy("hour").agg(F.min("domain").alias("domain"))
    heads = firsts.select(
        *_line(
            F.concat(
                _comma(F.col("hour") == F.lit(earliest)),
                hour_head(hour_label(F.col("hour")), hour_label(hour_end(F.col("hour")))),
            ),
            1,
            hour,
        )
    )
    tails = firsts.select(*_line(F.lit("]}"), 1, hour, 2))
    marked = rows.join(firsts.withColumn("is_first", F.lit(True)), ["hour", "domain"], "left")
    entries = marked.select(
        *_line(
            F.concat(
                _comma(F.col("is_first").isNotNull()),
                hour_entry(F.col("domain"), F.col("pages_created")),
            ),
            1,
            hour,
            1,
            F.col("domain"),
        )
    )
    return _ends(spark, F.lit("["), F.lit("]")).union(heads).union(entries).union(tails)


def bot_lines(rows, bounds):
    """One object, also when no bot created anything."""
    first = rows.agg(F.min("domain").alias("domain")).first().domain
    entries = rows.select(
        *_line(
            F.concat(
                _comma(F.col("domain") == F.lit(first)),
                bot_entry(F.col("domain"), F.col("created_by_bots")),
            ),
            1,
            key=F.col("domain"),
        )
    )
    opening = bot_head(*map(F.lit, _labels(bounds)))
    return _ends(rows.sparkSession, opening, F.lit("]}")).union(entries)


def top_user_lines(rows, bounds):
    """An array of users, most active first, each with its sorted titles, one line per title."""
    place = F.lpad(F.col("rank").cast("string"), 20, "0")
    users = rows.groupBy("rank", "user_id", "username", "pages_created").agg(
        F.min(
            F.when(F.col("page_title").isNotNull(), F.struct("page_title", "entry"))
        )["entry"].alias("first_entry")
    )
    labels = map(F.lit, _labels(bounds))
    head = user_head(F.col("user_id"), F.col("username"), *labels)
    heads = users.select(*_line(F.concat(_comma(F.col("rank") == 1), head), 1, place))
    tails = users.select(*_line(user_tail(F.col("pages_created")), 1, place, 2))
    firsts = users.select(
        "rank", F.col("first_entry").alias("entry"), F.lit(True).alias("is_first")
    )
    titles = rows.filter("page_title is not null").join(firsts, ["rank", "entry"], "left")
    entries = titles.select(
        *_line(
            F.concat(_comma(F.col("is_first").isNotNull()), title_entry(F.col("page_title"))),
            1,
            place,
            1,
            F.col("page_title"),
            F.col("entry"),
        )
    )
    return _ends(rows.sparkSession, F.lit("["), F.lit("]")).union(heads).union(entries).union(tails)


def _version(spark, out, name):
    """Folder of the published version of a report; a place without one does not exist."""
    folder = f"{out.rstrip('/')}/{name}"
    _, content = snapshots.current(spark, folder)
    return f"{folder}/{content['folder'] if content else 'none'}"


def report_path(spark, out, name):
    return f"{_version(spark, out, name)}/document"


def rows_path(spark, out, name):
    return f"{_version(spark, out, name)}/rows"


def _labelled(rows, bounds):
    start, end = _labels(bounds)
    return rows.withColumns({"time_start": F.lit(start), "time_end": F.lit(end)})


def _rows(name, domain_rows, user_rows, bounds, n, grain, minutes):
    domain_minutes, user_minutes = minutes or (None, None)
    if name == HOURLY_REPORT:
        if minutes:
            return hourly_of_minutes(domain_minutes)
        return hourly_domain_stats(domain_rows, bounds, grain)
    if name == BOT_REPORT:
        if minutes:
            return _labelled(bots_of_minutes(domain_minutes), bounds)
        return _labelled(bot_domain_stats(domain_rows, bounds, grain), bounds)
    # A number per row tells equal titles of a user apart once the rows are written.
    titles = _labelled(top_user_titles(user_rows, bounds, n, grain, user_minutes), bounds)
    return titles.withColumn("entry", F.monotonically_increasing_id())


def _lines(name, rows, bounds):
    if name == HOURLY_REPORT:
        return hourly_lines(rows)
    return bot_lines(rows, bounds) if name == BOT_REPORT else top_user_lines(rows, bounds)


def publish(
    spark, domain_rows, user_rows, bounds, out, n=20, names=tuple(REPORT_ROWS), grain=KEYED,
    minutes=None,
):
    """Write the three reports, or some: each as Parquet rows and as a JSON document.

    `minutes` are the stored partial aggregates of the window, of domains and of users; reports are
    then made of them, and `user_rows` give the titles.

    A report is written beside the one before it, and is there for readers when its snapshot is
    published. The one before goes when the next is published, for those who are reading it.
    """
    for name in names:
        folder = f"{out.rstrip('/')}/{name}"
        version = f"version-{uuid.uuid4().hex}"
        rows = _rows(name, domain_rows, user_rows, bounds, n, grain, minutes)
        rows.write.parquet(f"{folder}/{version}/rows")
        written = spark.read.schema(rows.schema).parquet(f"{folder}/{version}/rows")
        # A global sort: the text of the part files, in order, is the document.
        lines = _lines(name, written, bounds).orderBy(*_ORDER).select("value")
        lines.write.text(f"{folder}/{version}/document")
        number, before = snapshots.current(spark, folder)
        snapshots.publish(spark, folder, number + 1, {"folder": version})
        kept = {version, before["folder"] if before else version}
        for path in folders(spark, f"{folder}/version-*"):
            if path.rsplit("/", 1)[-1] not in kept:
                delete_folder(spark, path)


def read_report(spark, out, name):
    """Rows of a published report, with its labels. A missing or broken report is an error."""
    rows = spark.read.schema(REPORT_ROWS[name]).parquet(rows_path(spark, out, name))
    if name == HOURLY_REPORT:
        return rows.select(
            hour_label(F.col("hour")).alias("time_start"),
            hour_label(hour_end(F.col("hour"))).alias("time_end"),
            "domain",
            "pages_created",
        )
    return rows.drop("entry")

"""Published report documents read back from their text alone.

A document is nested JSON, an entry a line, in text files that are one value in the order of their
names. Which hour or user an entry belongs to, and whether it may stand where it does, depends on
lines before it, which may be in another file or in another task. Lines are numbered inside their
file block, and each block is first reduced to one row: its number of group heads and its last line.
Sums over these few rows tell each block what came before it. Then every line knows its group and
its predecessor, and heads, entries and tails of a group are joined.

A document is checked whole before it is used: every line has to be, byte for byte, what is written
for the values read from it, and has to follow its predecessor with or without a comma and in the
published order. What fails is an error, as a cut or edited file is.
"""

from pyspark.sql import Window, functions as F

from pagetide.operators.documents import (
    bot_entry,
    bot_head,
    hour_entry,
    hour_head,
    report_path,
    title_entry,
    user_head,
    user_tail,
)
from pagetide.schemas import BOT_REPORT, HOURLY_REPORT, TOP_USERS_REPORT

OPEN, HEAD, ENTRY, TAIL, CLOSE = "open", "head", "entry", "tail", "close"
_BLOCK = ("part", "block")
_SPAN = "time_start string, time_end string"

# What a line may follow; nothing at all is null. A list of groups, and one group alone.
_NESTED = {OPEN: [None], HEAD: [OPEN, TAIL], ENTRY: [HEAD, ENTRY], TAIL: [HEAD, ENTRY], CLOSE: [OPEN, TAIL]}
_SINGLE = {HEAD: [None], ENTRY: [HEAD, ENTRY], TAIL: [HEAD, ENTRY]}
# Siblings are parted by commas.
_SIBLING = {HEAD: TAIL, ENTRY: ENTRY}


class _Layout:
    """How the lines of a report are told apart, read and written again."""

    def __init__(self, follows, fields, read, written):
        self.follows, self.fields, self.read, self.written = follows, fields, read, written

    @property
    def last(self):
        return CLOSE if CLOSE in self.follows else TAIL


def _kind(body):
    return (
        F.when(body == "[", OPEN)
        .when(body == "]", CLOSE)
        .when(body.startswith("]"), TAIL)
        .when(body.startswith("{") & body.endswith(":["), HEAD)
        .otherwise(ENTRY)
    )


def _head(body, fields):
    return F.from_json(F.concat(body, F.lit("]}")), fields)


def _hourly(body):
    entry = F.get(F.map_entries(F.from_json(body, "map<string,bigint>")), F.lit(0))
    return _head(body, _SPAN), F.struct(entry["key"].alias("key"), entry["value"].alias("n"))


def _bot(body):
    entry = F.from_json(body, "domain string, created_by_bots bigint")
    return _head(body, _SPAN), F.struct(
        entry["domain"].alias("key"), entry["created_by_bots"].alias("n")
    )


def _top(body):
    title = F.get(F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<string>"), F.lit(0))
    total = F.from_json(
        F.concat(F.lit('{"titles":['), body), "pages_created bigint"
    )["pages_created"]
    head = _head(body, f"user_id bigint, username string, {_SPAN}")
    return head, F.struct(title.alias("key"), total.alias("n"))


_LAYOUTS = {
    HOURLY_REPORT: _Layout(
        _NESTED,
        _SPAN,
        _hourly,
        {
            HEAD: lambda head, entry: hour_head(head["time_start"], head["time_end"]),
            ENTRY: lambda head, entry: hour_entry(F.coalesce(entry["key"], F.lit("")), entry["n"]),
            TAIL: lambda head, entry: F.lit("]}"),
        },
    ),
    BOT_REPORT: _Layout(
        _SINGLE,
        _SPAN,
        _bot,
        {
            HEAD: lambda head, entry: bot_head(head["time_start"], head["time_end"]),
            ENTRY: lambda head, entry: bot_entry(entry["key"], entry["n"]),
            TAIL: lambda head, entry: F.lit("]}"),
        },
    ),
    TOP_USERS_REPORT: _Layout(
        _NESTED,
        f"user_id bigint, username string, {_SPAN}",
        _top,
        {
            HEAD: lambda head, entry: user_head(*[
                head[name] for name in ("user_id", "username", "time_start", "time_end")
            ]),
            ENTRY: lambda head, entry: title_entry(entry["key"]),
            TAIL: lambda head, entry: user_tail(entry["n"]),
        },
    ),
}


def _lines(spark, path):
    """Lines with their place: number of the part file, start of the block, order inside it."""
    lines = spark.read.option("lineSep", "\n").text(path)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("bigint")
    return lines.select(
        part.alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").startswith(",").alias("comma"),
        F.regexp_replace("value", "^,", "").alias("body"),
    )


def _parsed(lines, layout):
    """Each line's kind and values, and whether the values say all that the line does."""
    body, kind = F.col("body"), F.col("kind")
    head, entry = layout.read(body)
    rows = lines.withColumn("kind", _kind(body)).withColumns(
        {"head": F.when(kind == HEAD, head), "entry": F.when(kind.isin(ENTRY, TAIL), entry)}
    )
    again = F.when(kind.isin(OPEN, CLOSE), body)
    for name, written in layout.written.items():
        again = again.when(kind == name, written(F.col("head"), F.col("entry")))
    known = (kind != ENTRY) | F.col("entry.key").isNotNull()
    return rows.select(
        *_BLOCK,
        "line",
        "comma",
        "kind",
        "head",
        "entry",
        F.coalesce((again == body) & known, F.lit(False)).alias("whole"),
    )


def _in_order(rows):
    """The rows with `group`, the number of heads up to the line, and `before`, the last line."""
    seen = F.struct("kind", F.col("entry.key").alias("key"))
    is_head = (F.col("kind") == HEAD).cast("bigint")
    inside = Window.partitionBy(*_BLOCK).orderBy("line")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = rows.groupBy(*_BLOCK).agg(
        F.sum(is_head).alias("heads"), F.max_by(seen, "line").alias("end")
    )
    # One row per block of the file system.
    across = Window.orderBy(*_BLOCK)
    heads_before = F.sum("heads").over(across.rowsBetween(Window.unboundedPreceding, -1))
    carried = blocks.select(
        *_BLOCK,
        F.coalesce(heads_before, F.lit(0)).alias("heads_before"),
        F.lag("end").over(across).alias("end_before"),
    )
    placed = rows.withColumns(
        {"heads": F.sum(is_head).over(so_far), "before": F.lag(seen).over(inside)}
    ).join(carried, list(_BLOCK))
    return placed.withColumns(
        {
            "group": F.col("heads") + F.col("heads_before"),
            "before": F.coalesce("before", "end_before"),
        }
    )


def _fits(layout):
    """Whether a line may stand behind its predecessor."""
    kind, before = F.col("kind"), F.col("before")
    allowed = F.lit(False)
    for name, others in layout.follows.items():
        known = [other for other in others if other]
        after = before["kind"].isin(known) if known else F.lit(False)
        if None in others:
            after = after | before.isNull()
        allowed = allowed | (kind == name) & F.coalesce(after, F.lit(False))
    sibling = F.lit(False)
    for name, other in _SIBLING.items():
        sibling = sibling | (kind == name) & F.coalesce(before["kind"] == other, F.lit(False))
    in_order = F.coalesce(
        (kind != ENTRY) | (before["kind"] != ENTRY) | (before["key"] <= F.col("entry.key")),
        F.lit(False),
    )
    return allowed & (F.col("comma") == sibling) & in_order & F.col("whole")


def _check(placed, layout, path):
    """A driver's look at two numbers."""
    place = F.struct(*_BLOCK, "line")
    found = placed.agg(
        F.min(F.when(~_fits(layout), F.struct(*_BLOCK, "line", "kind"))).alias("wrong"),
        F.max_by("kind", place).alias("last"),
    ).first()
    if found.wrong is not None:
        raise ValueError(
            f"{path}: {found.wrong.kind} does not belong in part {found.wrong.part} of the document"
            f" behind byte {found.wrong.block}"
        )
    if found.last != layout.last:
        raise ValueError(f"{path}: the document is cut")


def read_document(spark, out, name):
    """Rows of a published report, from its document: one per entry, with its labels.

    A user without titles has one row. A missing, cut or edited document is an error.
    """
    layout, path = _LAYOUTS[name], report_path(spark, out, name)
    placed = _in_order(_parsed(_lines(spark, path), layout))
    _check(placed, layout, path)
    heads = placed.filter(F.col("kind") == HEAD).select("group", "head.*")
    entries = placed.filter(F.col("kind") == ENTRY).select("group", "entry.*")
    if name == TOP_USERS_REPORT:
        totals = placed.filter(F.col("kind") == TAIL).select(
            "group", F.col("entry.n").alias("pages_created")
        )
        titles = entries.select("group", F.col("key").alias("page_title"))
        return heads.join(totals, "group").join(titles, "group", "left").select(
            F.col("group").cast("int").alias("rank"),
            "user_id", "username", "pages_created", "page_title", "time_start", "time_end",
        )
    counted = "pages_created" if name == HOURLY_REPORT else "created_by_bots"
    return entries.join(heads, "group").select(
        "time_start", "time_end", F.col("key").alias("domain"), F.col("n").alias(counted)
    )

"""Jobs to submit: `spark-submit job.py <command> ...` or `python -m pagetide <command> ...`.

Commands
  normalize  raw messages to normalised ones, as a stream
  views      normalised messages to the seven keyed views, as a stream
  hourly     normalised messages to counts of closed hours, as a stream; with --root and --run, to
             counts that late events correct
  reports    the three report documents for the window that belongs to --as-of
  read       a published document, as rows in JSON lines
  compact    merge the batches of the views to one row per key, beside a running stream
  lookup     one of the lookups, written as JSON lines

Streams run until stopped, or with --once until the input is used up. Each batch reads a limited
part of the input. Unreadable messages go where --quarantine says, or nowhere with --drop-bad.
"""

import argparse
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession, functions as F

from pagetide.functions.timing import Bounds, as_utc, report_bounds
from pagetide.operators import documents, lookups, viewlog
from pagetide.operators.normalize import accepted, from_wire
from pagetide.operators.reports import EVENT, KEYED
from pagetide.operators.report_reader import read_document
from pagetide.operators.views import DOMAIN_MINUTES, EVENT_LOG, PARTIALS, STORES, USER_MINUTES
from pagetide.schemas import REPORT_ROWS
from pagetide.session import utc
from pagetide.sources.frames import sse_frames
from pagetide.sources.messages import PATIENT, file_messages, kafka_raw
from pagetide.streaming import jobs

# Lookup name -> the view it reads and the function that answers it.
BY_KEY = {
    "pages-by-user": ("pages_by_user", int, lookups.pages_by_user),
    "domain-page-count": ("domain_page_counts", str, lookups.domain_page_count),
    "page-details": ("page_details_by_page_id", int, lookups.page_details),
}
# Lookup name -> the store it reads and the function that answers it, by first and last day.
BY_DAYS = {
    "active-days": ("page_creations_by_time", lookups.user_active_days_range),
    "pages-created": (EVENT_LOG, lookups.user_pages_created_range),
}
# How much one batch of a stream reads, unless told otherwise.
MOST_MESSAGES = 20_000_000
MOST_BYTES = 16 * 2**30


def _arguments():
    parser = argparse.ArgumentParser(prog="pagetide", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    def stream(name):
        command = commands.add_parser(name)
        command.add_argument("--servers", help="broker addresses; reads and writes topics")
        command.add_argument("--topic")
        command.add_argument("--starting", help="where a topic is read from; the latest messages")
        command.add_argument(
            "--allow-data-loss", action="store_true", help="skip messages that a topic lost"
        )
        command.add_argument("--min-partitions", type=int)
        command.add_argument("--input", help="folder of message files, instead of a topic")
        command.add_argument("--checkpoint", required=True)
        command.add_argument("--once", action="store_true")
        command.add_argument("--interval", help="time between batches, such as '1 second'")
        command.add_argument("--max-offsets", type=int, default=MOST_MESSAGES, help="per batch")
        command.add_argument("--max-files", type=int, help="per batch")
        command.add_argument(
            "--max-bytes", type=int, default=MOST_BYTES, help="per batch, unless --max-files"
        )
        return command

    def bad_messages(command):
        kept = command.add_mutually_exclusive_group(required=True)
        kept.add_argument("--quarantine", help="folder for messages with a problem")
        kept.add_argument("--drop-bad", action="store_true", help="do without them")

    normalize = stream("normalize")
    normalize.add_argument("--frames", action="store_true", help="input holds event frames")
    normalize.add_argument(
        "--redelivered", help="how long frames may come again, such as '1 hour'; with --frames"
    )
    normalize.add_argument("--out", help="folder for message files, instead of a topic")
    normalize.add_argument("--rejects", default=jobs.REJECTED_TOPIC, help="topic of bad messages")
    views = stream("views")
    views.add_argument("--root", required=True)
    views.add_argument("--run", required=True, help="a new name for every new checkpoint")
    views.add_argument(
        "--buckets", type=int, help="keep views without time in so many buckets, for many lookups"
    )
    views.add_argument(
        "--partials", action="store_true", help="keep partial aggregates for reports as well"
    )
    bad_messages(views)
    hourly = stream("hourly")
    hourly.add_argument("--out", required=True)
    hourly.add_argument("--delay", default="1 hour")
    hourly.add_argument("--root", help="folder of minutes; late events correct published hours")
    hourly.add_argument("--run", help="with --root, a new name for every new checkpoint")
    bad_messages(hourly)

    reports = commands.add_parser("reports")
    reports.add_argument("--root", required=True)
    reports.add_argument("--out", required=True)
    reports.add_argument("--as-of", help="UTC time; now if left out")
    reports.add_argument("--hours", type=int, default=7)
    reports.add_argument("--grain", choices=[KEYED, EVENT], default=KEYED)
    reports.add_argument("--partials", action="store_true", help="from partial aggregates")
    read = commands.add_parser("read")
    read.add_argument("name", choices=list(REPORT_ROWS))
    read.add_argument("--reports", required=True, help="what the reports were written to")
    read.add_argument("--out", required=True)
    compact = commands.add_parser("compact")
    compact.add_argument("--root", required=True)
    lookup = commands.add_parser("lookup")
    lookup.add_argument("name", choices=["domains", *BY_DAYS, *BY_KEY])
    lookup.add_argument("keys", nargs="*", help="keys, or first and last day")
    lookup.add_argument("--keys-file", help="text file or folder with a key per line, of any size")
    lookup.add_argument("--root", required=True)
    lookup.add_argument("--out", required=True)
    return parser


def _trigger(args):
    if args.once:
        return {"availableNow": True}
    return {"processingTime": args.interval} if args.interval else None


def _file_limits(args):
    """Spark takes one of the two limits on files."""
    if args.max_files:
        return {"maxFilesPerTrigger": str(args.max_files)}
    return {"maxBytesPerTrigger": str(args.max_bytes)}


def _messages(spark, args, topic, options=None):
    if args.input:
        return file_messages(spark, args.input, streaming=True, **_file_limits(args))
    settings = {**(options or {}), "maxOffsetsPerTrigger": str(args.max_offsets)}
    if args.allow_data_loss:
        settings["failOnDataLoss"] = "false"
    return kafka_raw(
        spark, args.servers, args.topic or topic, args.starting, args.min_partitions, settings
    )


def _normalized(spark, args):
    if args.input:
        return jobs.normalized_files(spark, args.input, **_file_limits(args))
    return _messages(spark, args, jobs.PROCESSED_TOPIC, PATIENT)


def normalize(spark, args):
    if args.frames:
        messages = sse_frames(
            spark, args.input, streaming=True, redelivered=args.redelivered, **_file_limits(args)
        )
    else:
        messages = _messages(spark, args, jobs.INPUT_TOPIC)
    start, target = (
        (jobs.start_normalize_to_files, args.out)
        if args.out
        else (jobs.start_normalize_to_kafka, args.servers)
    )
    return [start(messages, target, args.checkpoint, _trigger(args), rejects=args.rejects)]


def views(spark, args):
    quarantine = jobs.DROP if args.drop_bad else args.quarantine
    return [
        jobs.start_views(
            _normalized(spark, args), args.root, args.run, args.checkpoint, quarantine,
            _trigger(args), views=[*STORES, *PARTIALS] if args.partials else None,
            buckets=args.buckets,
        )
    ]


def hourly(spark, args):
    messages, trigger, started = _normalized(spark, args), _trigger(args), []
    if not args.drop_bad:
        rejects = f"{args.checkpoint}-rejects"
        started.append(jobs.start_rejects(messages, args.quarantine, rejects, trigger))
    events = accepted(from_wire(messages))
    if args.root:
        started.append(
            jobs.start_corrected_hours(
                events, args.root, args.run, args.out, args.checkpoint, trigger
            )
        )
        return started
    started.append(jobs.start_hourly(events, args.out, args.checkpoint, args.delay, trigger))
    return started


def reports(spark, args):
    bounds = report_bounds(args.as_of or datetime.now(timezone.utc), args.hours)
    # Events are counted in the log; the keyed counts do not need it.
    stores = [EVENT_LOG] * 2 if args.grain == EVENT else ["domain_page_stats", "user_stat"]
    rows = [viewlog.scan(spark, args.root, store, bounds) for store in stores]
    minutes = None
    if args.partials:
        minutes = [
            viewlog.read(spark, args.root, store, bounds) for store in (DOMAIN_MINUTES, USER_MINUTES)
        ]
    documents.publish(spark, *rows, bounds, args.out, grain=args.grain, minutes=minutes)


def read(spark, args):
    read_document(spark, args.reports, args.name).write.mode("overwrite").json(args.out)


def compact(spark, args):
    viewlog.compact(spark, args.root)


def lookup(spark, args):
    if args.name == "domains":
        rows = lookups.domains(viewlog.read(spark, args.root, "distinct_domains"))
    elif args.name in BY_DAYS:
        view, answer = BY_DAYS[args.name]
        first, last = args.keys
        bounds = Bounds(as_utc(first), as_utc(last) + timedelta(days=1))
        rows = answer(viewlog.read(spark, args.root, view, bounds), first, last)
    else:
        view, kind, answer = BY_KEY[args.name]
        if args.keys_file:
            named = "bigint" if kind is int else "string"
            keys = spark.read.text(args.keys_file).select(F.trim("value").try_cast(named))
        else:
            keys = [kind(key) for key in args.keys]
        rows = answer(viewlog.read(spark, args.root, view), keys)
    rows.write.mode("overwrite").json(args.out)


COMMANDS = {
    "normalize": normalize,
    "views": views,
    "hourly": hourly,
    "reports": reports,
    "read": read,
    "compact": compact,
    "lookup": lookup,
}


def main(argv=None):
    args = _arguments().parse_args(argv)
    spark = utc(SparkSession.builder.appName(f"pagetide-{args.command}").getOrCreate())
    spark.streams.resetTerminated()
    started = COMMANDS[args.command](spark, args) or []
    while any(query.isActive for query in started):
        # If one of two streams fails, so does the job.
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()
    for query in started:
        query.awaitTermination()


if __name__ == "__main__":
    main()

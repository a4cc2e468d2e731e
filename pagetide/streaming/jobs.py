"""The streaming jobs: normalise messages, keep the views current, count closed hours."""

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from pagetide import snapshots
from pagetide.functions.seconds import seconds_in, seconds_mask
from pagetide.operators.normalize import from_wire, parse_envelope, rejected, wire_text
from pagetide.operators.quarantine import marked, quarantined, usable
from pagetide.operators.reports import hourly_of_minutes
from pagetide.operators.viewlog import read, write_batch
from pagetide.operators.views import DOMAIN_MINUTES, STORES
from pagetide.session import folders, keep_state_on_disk

# Topic names.
INPUT_TOPIC = "input"
PROCESSED_TOPIC = "processed"
# End of fixed values.
REJECTED_TOPIC = "rejected"

# What to give instead of a folder for bad messages, to do without them on purpose.
DROP = "drop"


def _start(stream, checkpoint, trigger):
    return stream.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def normalized_messages(messages, processed=PROCESSED_TOPIC, rejects=REJECTED_TOPIC):
    """Outgoing messages with their topic: flat JSON for good ones, the raw text for bad ones.

    Each message is parsed once and one query writes both topics. The key keeps the messages of a
    page in one partition and so in order.
    """
    decoded = parse_envelope(messages)
    good = F.col("problem").isNull()
    raw = F.to_json(F.struct("problem", F.col("text").alias("value")))
    return decoded.select(
        F.when(good, processed).otherwise(rejects).alias("topic"),
        F.col("page_id").cast("string").alias("key"),
        F.when(good, wire_text(decoded)).otherwise(raw).alias("value"),
    )


def start_normalize_to_kafka(messages, servers, checkpoint, trigger=None, **topics):
    outgoing = normalized_messages(messages, **topics)
    sink = outgoing.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return _start(sink, checkpoint, trigger or {"processingTime": "0 seconds"})


def start_normalize_to_files(messages, path, checkpoint, trigger=None, **topics):
    """The same messages as text files, one folder per topic."""
    outgoing = normalized_messages(messages, **topics).drop("key")
    sink = outgoing.writeStream.format("text").partitionBy("topic").option("path", path)
    return _start(sink, checkpoint, trigger or {"processingTime": "0 seconds"})


def normalized_files(spark, path, topic=PROCESSED_TOPIC, streaming=True, **options):
    """Messages of one topic written by `start_normalize_to_files`."""
    reader = spark.readStream if streaming else spark.read
    rows = reader.format("text").schema("value string, topic string").options(**options)
    return rows.load(path).filter(F.col("topic") == topic).select("value")


def view_writer(root, run, quarantine, views=None, buckets=None):
    """The per-batch function that upserts a batch of events into every view.

    `quarantine` is the folder for messages with a problem, or `DROP`. With `buckets`, views whose
    key has no time are kept in so many buckets, and reading them merges nothing.

    Errors are not caught: a batch that fails is retried by Spark, and rewriting the views it had
    already reached replaces the same folders. The batch is cached when it is read more than once.
    """
    names = tuple(views or STORES)

    def write(decoded, batch_id):
        batch = marked(decoded, names)
        keep_bad = quarantine != DROP
        reread = len(names) > 1 or keep_bad or buckets
        if reread:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(usable(batch), root, run, batch_id, names, buckets)
            if keep_bad:
                _write_quarantine(quarantined(batch), quarantine, run, batch_id)
        finally:
            if reread:
                batch.unpersist()

    return write


def _write_quarantine(rows, path, run, batch_id):
    (
        rows.withColumn("run", F.lit(run))
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run", "batch_id")
        .parquet(path)
    )


def start_views(
    messages, root, run, checkpoint, quarantine, trigger=None, views=None, decode=from_wire,
    buckets=None,
):
    """Keep the views below `root` current. `run` must be new whenever `checkpoint` is new.

    Bad messages go to the folder `quarantine`, unless it is `DROP`.
    """
    sink = decode(messages).writeStream.foreachBatch(
        view_writer(root, run, quarantine, views, buckets)
    )
    return _start(sink, checkpoint, trigger or {"processingTime": "1 second"})


def hourly_counts(events, delay="1 hour"):
    """Pages per hour and domain at the keyed grain, emitted once the watermark closes the hour.

    State is one long per minute, domain and bot flag instead of one row per distinct second.
    Events later than `delay` are dropped here; the batch reports still count them.
    """
    minutes = (
        events.dropna(subset=["time", "domain", "created_by_bot"])
        .withWatermark("time", delay)
        .groupBy(F.window("time", "1 minute").alias("minute"), "domain", "created_by_bot")
        .agg(seconds_mask(F.col("time")).alias("seconds"))
    )
    return (
        minutes.groupBy(F.window(F.window_time("minute"), "1 hour").alias("span"), "domain")
        .agg(F.sum(seconds_in(F.col("seconds"))).alias("pages_created"))
        .select(F.col("span.start").alias("hour"), "domain", "pages_created")
    )


def start_rejects(messages, path, checkpoint, trigger=None, decode=from_wire):
    """Keep what cannot be read, for jobs whose own output has no place for it."""
    sink = rejected(decode(messages)).writeStream.format("parquet").option("path", path)
    return _start(sink, checkpoint, trigger or {"processingTime": "1 minute"})


def start_hourly(events, path, checkpoint, delay="1 hour", trigger=None):
    """Counts of closed hours. The open minutes are state, on disk and not on the heap."""
    keep_state_on_disk(events.sparkSession)
    sink = (
        hourly_counts(events, delay)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
    )
    return _start(sink, checkpoint, trigger or {"processingTime": "1 minute"})


def corrected_hours_writer(root, run, out):
    """The per-batch function that keeps published hours right, however late an event is.

    A batch is kept as masks of the seconds of a minute; the hours of the days that it has events of
    are counted again from the masks of all batches, and replace those days in `out`. Nothing is
    dropped and nothing is state: the masks are stored once, in the partial view below `root`.
    """

    def write(events, batch_id):
        spark = events.sparkSession
        write_batch(events, root, run, batch_id, [DOMAIN_MINUTES])
        found = events.select(F.to_date("time").alias("day")).distinct().dropna().collect()
        if not found:
            return
        days = sorted(row.day for row in found)
        minutes = read(spark, root, DOMAIN_MINUTES, days=days)
        hours = hourly_of_minutes(minutes).withColumn("day", F.to_date("hour"))
        version = f"version-{uuid.uuid4().hex}"
        hours.write.partitionBy("day").parquet(f"{out}/{version}")
        number, before = snapshots.current(spark, out)
        named, gone = dict(before["days"]) if before else {}, []
        for path in folders(spark, f"{out}/{version}/day=*"):
            day = path.rsplit("day=", 1)[1]
            if day in named:
                gone.append(named[day])
            named[day] = f"{version}/day={day}"
        left = snapshots.retired(spark, out, before, gone)
        snapshots.publish(spark, out, number + 1, {"days": named, "retired": left})

    return write


def start_corrected_hours(events, root, run, out, checkpoint, trigger=None):
    """Hours that late events correct. `run` must be new whenever `checkpoint` is new."""
    sink = events.writeStream.foreachBatch(corrected_hours_writer(root, run, out))
    return _start(sink, checkpoint, trigger or {"processingTime": "1 minute"})


def corrected_hours(spark, out):
    """The hours that are published now."""
    _, content = snapshots.current(spark, out)
    named = content["days"] if content else {}
    reader = spark.read.schema("hour timestamp, domain string, pages_created bigint")
    if not named:
        return spark.createDataFrame([], "hour timestamp, domain string, pages_created bigint")
    # Folders of many versions; their days are in the hours.
    return reader.parquet(*[f"{out}/{path}" for path in named.values()])

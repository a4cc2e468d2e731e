"""The `events` table read as page-create events, as raw envelopes and as event frames."""

from pyspark.sql import functions as F

from pagetide.schemas import FEED_TIME_FORMAT
from pagetide.session import is_file


def events_path(folder):
    return f"{folder.rstrip('/')}/events.parquet"


def read_events(spark, folder, bounds=None):
    """Raw rows. Bounds on whole seconds filter `ts` itself, which reaches the scan."""
    rows = spark.read.parquet(events_path(folder))
    if bounds is None:
        return rows
    kind = rows.schema["ts"].dataType

    def moment(value):
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast(kind)

    return rows.filter(
        (F.col("ts") >= moment(bounds.start)) & (F.col("ts") < moment(bounds.end))
    )


def stream_events(spark, folder, **options):
    path = events_path(folder)
    schema = spark.read.parquet(path).schema
    # A stream reads folders: the folder of files itself, or the one that the single file is in.
    names = {"pathGlobFilter": "events.parquet"} if is_file(spark, path) else {}
    place = folder if names else path
    return spark.readStream.schema(schema).options(**names, **options).parquet(place)


def as_page_creates(events):
    return events.select(
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("time"),
        F.concat("event_type", F.lit(".example.org")).alias("domain"),
        (F.col("user_id") % 5 == 0).alias("created_by_bot"),
        "user_id",
        F.concat(F.lit("user_"), "user_id").alias("username"),
        F.concat(F.lit("Title "), F.regexp_extract("props", "[0-9]+", 0)).alias("page_title"),
        (F.col("event_id") % 4000).alias("page_id"),
        F.col("event_id").alias("seq"),
    )


def page_creates(spark, folder, bounds=None):
    return as_page_creates(read_events(spark, folder, bounds))


def as_envelopes(page_creates, time_format=FEED_TIME_FORMAT):
    """Events nested and encoded the way the feed sends them."""
    envelope = F.struct(
        F.struct("domain", F.date_format("time", time_format).alias("dt")).alias("meta"),
        F.struct(
            "user_id",
            F.col("created_by_bot").alias("user_is_bot"),
            F.col("username").alias("user_text"),
        ).alias("performer"),
        "page_title",
        "page_id",
    )
    return page_creates.select(F.to_json(envelope).alias("value"), "seq")


def as_frames(messages):
    """Event frames for the messages, without the blank line that ends each."""
    return messages.select(
        F.concat(
            F.lit("event: message\nid: "),
            F.col("seq").cast("string"),
            F.lit("\ndata: "),
            F.col("value"),
        ).alias("value")
    )

"""Server-sent event frames landed as text files."""

from pyspark.sql import functions as F

from pagetide.session import keep_state_on_disk

# A blank line ends a frame, whichever way its lines end.
_BLANK_LINE = r"\r?\n\r?\n"


def read_frames(spark, path, streaming=False, separator="\n\n", **options):
    """One row per frame, with `landed`, the time of its file.

    Files are cut at `separator`, and what is between at any other form of a blank line, so no frame
    is lost. For feeds whose lines end in CRLF, `separator="\\r\\n\\r\\n"` lets Spark split files.
    """
    reader = spark.readStream if streaming else spark.read
    records = reader.format("text").options(lineSep=separator, **options).load(path)
    frames = F.explode(F.split("value", _BLANK_LINE, -1)).alias("value")
    return records.select(F.col("_metadata.file_modification_time").alias("landed"), frames)


def _field(name):
    # (?md): ^ and $ match at \n only, so other line breaks inside JSON text stay untouched.
    # A line is taken at once; its last \r is not part of it.
    line = r"[^\n]*(?<!\r)|[^\n]*(?=\r$)"
    pattern = rf"(?md)^{name}(?:: ?({line}))?\r?$"
    return F.regexp_extract_all(F.col("value"), F.lit(pattern), F.lit(1))


def frame_messages(frames):
    """Frames of type `message` (the default type) as messages; data lines are joined.

    Frames without data, comments and other event types are not messages. Whether the data is
    valid JSON is decided by the normaliser, which keeps bad text aside instead of dropping it.
    """
    fields = F.struct(
        F.try_element_at(_field("event"), F.lit(-1)).alias("event"),
        F.try_element_at(_field("id"), F.lit(-1)).alias("id"),
        F.array_join(_field("data"), "\n").alias("value"),
    )
    # Generated, so that the filter reads the fields and does not take them from the text again.
    fields = frames.select(
        *[F.col(name) for name in frames.columns if name == "landed"], F.inline(F.array(fields))
    )
    kind = F.coalesce(F.nullif(F.col("event"), F.lit("")), F.lit("message"))
    return fields.filter((kind == "message") & (F.col("value") != "")).drop("event")


def delivered_once(messages, delay=None):
    """Messages whose id was not there before; those without an id are kept as they are.

    A feed that reconnects sends the frames after the last id it knows again. In a stream, ids are
    remembered until `delay` after they landed, so a frame may come again up to then.
    """
    # Rows without an id must not be equal to each other.
    keyed = messages.withColumn("once", F.coalesce("id", F.concat(F.lit("none "), F.uuid())))
    if messages.isStreaming:
        keep_state_on_disk(messages.sparkSession)
        kept = keyed.withWatermark("landed", delay).dropDuplicatesWithinWatermark(["once"])
    else:
        kept = keyed.dropDuplicates(["once"])
    return kept.drop("once")


def sse_frames(spark, path, streaming=False, redelivered=None, **options):
    """`id` and `value` of the messages; `redelivered` is how long a frame may come again."""
    messages = frame_messages(read_frames(spark, path, streaming, **options))
    if redelivered:
        messages = delivered_once(messages, redelivered)
    return messages.select("id", "value")

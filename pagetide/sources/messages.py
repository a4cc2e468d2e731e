"""Message streams: topics, and text files with one message per line."""

from pyspark.sql import functions as F

# Settings of the reader of normalised messages.
PATIENT = {
    "kafka.request.timeout.ms": "6000",
    "kafka.session.timeout.ms": "6000",
}
# End of fixed values.

# Offsets that fit between two milliseconds of the order number.
_OFFSETS = 1 << 20


def arrival_order():
    """A number that follows the broker's time of arrival, then the offset.

    Offsets of different partitions cannot be compared; times of arrival can.
    """
    offset = F.pmod(F.col("offset"), F.lit(_OFFSETS))
    return F.unix_millis("timestamp") * _OFFSETS + offset


def kafka_raw(
    spark, servers, topic, starting=None, min_partitions=None, options=None, streaming=True
):
    """Messages of a topic as (value, seq).

    A stream starts at the latest messages, a batch reads from the earliest, unless told otherwise.
    Topics have few partitions; `min_partitions` splits their offset ranges over more tasks. Lost
    offsets fail the job unless `options` has `failOnDataLoss` set to false.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting or ("latest" if streaming else "earliest"),
        **(options or {}),
    }
    if min_partitions:
        settings["minPartitions"] = str(min_partitions)
    return reader.options(**settings).load().select("value", arrival_order().alias("seq"))


def file_messages(spark, path, streaming=False, **options):
    reader = spark.readStream if streaming else spark.read
    return reader.format("text").options(**options).load(path)

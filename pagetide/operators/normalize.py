"""Raw envelopes to flat page-create rows, and flat rows to and from their wire form.

Every parse here is tolerant: a bad message becomes a row with a `problem`, it never fails a job.
"""

import uuid

from pyspark.sql import functions as F

from pagetide.functions.timing import feed_time
from pagetide.schemas import ENVELOPE, FEED_TIME_FORMAT, PAGE_CREATE, PAGE_CREATE_DDL

NO_MESSAGE = "no_message"
BAD_JSON = "bad_json"
BAD_TIME = "bad_time"

_CORRUPT = "_corrupt"
_GUARD = "_guard"


def _decode(messages, schema, flatten, clean_time):
    """Columns of the messages, plus the flat fields, `seq` and `problem`.

    A message is parsed between two guards, in an array that has to hold these three and nothing
    else. A parser stops after the first value of a text; so wrapped, text after the message is an
    error and not lost. What closes the array or the object early, and goes on, loses a guard, which
    it cannot write itself as it does not know them.

    The JSON is parsed once, inside a generator. As plain projections the parse would be copied into
    the filter on `problem` and so run twice per message.
    """
    text = F.col("value").cast("string")
    opens, closes = (uuid.uuid4().hex for _ in range(2))
    parsed = F.from_json(
        F.concat(
            F.lit(f'{{"guarded":[{{"{_GUARD}":"{opens}"}},'),
            text,
            F.lit(f',{{"{_GUARD}":"{closes}"}}]}}'),
        ),
        f"guarded array<struct<{schema}, {_GUARD} string>>, {_CORRUPT} string",
        {"columnNameOfCorruptRecord": _CORRUPT},
    )
    seq = F.col("seq") if "seq" in messages.columns else F.lit(0).cast("bigint")

    def event_of(whole):
        first, message, last = (F.get(whole["guarded"], F.lit(at)) for at in range(3))
        alone = (
            (F.size(whole["guarded"]) == 3) & (first[_GUARD] == opens) & (last[_GUARD] == closes)
        )
        return F.struct(
            *flatten(message),
            _seq(message, schema, seq).alias("seq"),
            text.isNull().alias("absent"),
            (
                message.isNull()
                | whole[_CORRUPT].isNotNull()
                | ~F.coalesce(alone, F.lit(False))
            ).alias("unreadable"),
        )

    fields = F.transform(F.array(parsed), event_of)
    event = F.col("event")
    problem = (
        F.when(event["absent"], NO_MESSAGE)
        .when(event["unreadable"], BAD_JSON)
        .when(~clean_time(event["time"]), BAD_TIME)
    )
    return messages.select(text.alias("text"), F.explode(fields).alias("event")).select(
        *[event[name].alias(name) for name in PAGE_CREATE],
        event["seq"].alias("seq"),
        "text",
        problem.alias("problem"),
    )


def _seq(document, schema, arrival):
    """The order that the first hop wrote into the message, else the message's own."""
    return F.coalesce(document["seq"], arrival) if "seq bigint" in schema else arrival


def parse_envelope(messages, time_formats=(FEED_TIME_FORMAT,)):
    """Parse raw messages (`value`, optional `seq`) and flatten them to page-create fields."""

    def flatten(doc):
        return [
            feed_time(doc["meta"]["dt"], time_formats).alias("time"),
            doc["meta"]["domain"].alias("domain"),
            doc["performer"]["user_is_bot"].alias("created_by_bot"),
            doc["performer"]["user_id"].alias("user_id"),
            doc["performer"]["user_text"].alias("username"),
            doc["page_title"].alias("page_title"),
            doc["page_id"].alias("page_id"),
        ]

    return _decode(messages, ENVELOPE, flatten, lambda time: time.isNotNull())


def from_wire(messages):
    """Parse flat JSON messages. Times must be whole seconds, as the normaliser writes them."""

    def whole_second(time):
        return F.coalesce(time == F.date_trunc("second", time), F.lit(False))

    def flatten(doc):
        return [doc[name].alias(name) for name in PAGE_CREATE]

    return _decode(messages, f"{PAGE_CREATE_DDL}, seq bigint", flatten, whole_second)


def accepted(decoded):
    return decoded.filter(F.col("problem").isNull()).select(*PAGE_CREATE, "seq")


def rejected(decoded):
    return decoded.filter(F.col("problem").isNotNull()).select(
        F.col("text").alias("value"), "seq", "problem"
    )


def to_wire(events):
    """One JSON text per event in `value`; null fields are left out.

    `seq` goes along, so that rows of one second keep their order over the second hop.
    """
    return events.select(wire_text(events).alias("value"))


def wire_text(events):
    extra = ["seq"] if "seq" in events.columns else []
    return F.to_json(F.struct(*PAGE_CREATE, *extra))

"""Messages kept aside: unreadable ones, and events that lack a key some view needs."""

from pyspark.sql import functions as F

from pagetide.operators.views import missing_from
from pagetide.schemas import PAGE_CREATE

NO_KEY = "no_key"


def marked(decoded, views=None):
    """Decoded messages with `problem` also set where an event lacks a key.

    Raw text is kept for messages with a problem only, so a cached batch does not hold every
    message twice. Events that lack some key still reach the views that do not need it, so
    `unusable` tells whether there is an event at all.
    """
    missing = missing_from(views)
    no_key = F.when(
        F.size(missing) > 0, F.concat(F.lit(f"{NO_KEY}: "), F.array_join(missing, ", "))
    )
    problem = F.coalesce("problem", no_key)
    return decoded.withColumns(
        {
            "unusable": F.col("problem").isNotNull(),
            "problem": problem,
            "text": F.when(problem.isNotNull(), F.col("text")),
        }
    )


def usable(batch):
    """Events of a marked batch."""
    return batch.filter(~F.col("unusable")).select(*PAGE_CREATE, "seq")


def quarantined(batch):
    """One row per message of a marked batch that has a problem."""
    return batch.filter(F.col("problem").isNotNull()).select(
        F.col("text").alias("value"), "seq", "problem"
    )

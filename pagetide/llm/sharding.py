"""Shard placement by a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own, given by an offset and a
skip. The shards take turns, and in its turn a shard claims its most preferred free slot, until no
slot is free. So the shards' shares differ by one slot at most, and a shard that leaves gives its
slots away while most other slots stay.

A row is placed by the slot of its key: one array access in a broadcast table whose size is the
prime, whatever the number of rows.

Defined results: a null key has its own fixed slot, like any other key; equal keys, and so repeated
rows, share a shard; an empty table gives an empty result.
"""

import hashlib

from pyspark.sql import functions as F

# A prime, and more than a hundred times the number of shards, so that shares are within 1 %.
SLOTS = 4099
SHARDS = tuple(f"shard-{number:02d}" for number in range(32))


def _number(text):
    """The first 32 bits of the MD5 of a text, which every SQL engine can compute."""
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def fill_table(shards=SHARDS, slots=SLOTS):
    """The number of the shard in each slot; the result depends on names, not on their order."""
    if slots < 2 or any(slots % factor == 0 for factor in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    if len(set(shards)) != len(shards) or not 0 < len(shards) < slots:
        raise ValueError("shards need distinct names, and fewer than there are slots")
    turns = sorted(range(len(shards)), key=lambda number: shards[number])
    place = {n: _number(f"offset {shards[n]}") % slots for n in turns}
    skip = {n: _number(f"skip {shards[n]}") % (slots - 1) + 1 for n in turns}
    table, free = [None] * slots, slots
    while free:
        for number in turns[:free]:
            while table[place[number]] is not None:
                place[number] = (place[number] + skip[number]) % slots
            table[place[number]] = number
            free -= 1
    return table


def table_rows(spark, shards=SHARDS, slots=SLOTS):
    """The table as rows of `slot` and `shard`, made on the executors from one literal."""
    numbers = ",".join(map(str, fill_table(shards, slots)))
    names = F.array(*[F.lit(name) for name in shards])
    table = F.from_json(F.lit(f"[{numbers}]"), "array<int>")
    return spark.range(1).select(F.posexplode(table).alias("slot", "number")).select(
        "slot", F.get(names, F.col("number")).alias("shard")
    )


def slot_of(key, slots=SLOTS):
    """The slot of a key column, by the first 32 bits of the MD5 of its text."""
    text = F.coalesce(key.cast("string"), F.lit("null key"))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % slots).cast("int")


def place(rows, key, shards=SHARDS, slots=SLOTS):
    """The rows with `slot` and `shard`. The broadcast table has `slots` rows, a fixed number."""
    table = F.broadcast(table_rows(rows.sparkSession, shards, slots))
    return rows.withColumn("slot", slot_of(key, slots)).join(table, "slot")

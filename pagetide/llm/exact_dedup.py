"""Exact deduplication against a history that is kept in a minimal perfect hash.

The history is a set of distinct SHA-256 digests. They are dealt to buckets by their leading bits;
in each bucket a hash-and-displace function maps n digests to n slots without a gap, so a bucket is
a row of displacements and of slots, each slot a full digest, its winner's id and its number of
copies. A lookup goes to one slot and compares all 32 bytes there. Digests that are found join their
slot; all others are grouped by themselves.

Digests are uniform and distinct before they are dealt, so buckets are of equal size however many
rows share a text. Only ids and digests are shuffled, never texts.

Defined results: a null text equals an empty one; the largest `doc_id` of a group stays, a null id
only where no row has one; rows that repeat an id are counted each, and each of them is kept where
its id is; an empty history or an empty table is allowed; other columns are ignored.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window, functions as F

from pagetide.llm.tables import stored, texts

BUCKET_DIGESTS = 4096
GROUP = 4
# Displacements of a group that are tried at once.
TRIES = 256
DIGEST = 32

INDEX = "bucket bigint, digests binary, displacements binary, winners binary, copies binary"
NO_WINNER = np.iinfo(np.int64).min


def digested(docs):
    """`doc_id` and the SHA-256 of the whole text as 32 bytes."""
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    return texts(docs).select("doc_id", digest.alias("digest"))


def distinct_digests(rows):
    """A row per digest with the winner and the number of copies; merged before the shuffle."""
    return rows.groupBy("digest").agg(
        F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("copies")
    )


def _with_bucket(rows, buckets):
    lead = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint")
    return rows.withColumn("bucket", lead % buckets)


# Slots inside a bucket. Three words of the digest that the bucket number does not use.


def _words(digests):
    words = digests.reshape(-1, DIGEST).view("<u8")
    return words[:, 1], words[:, 2], words[:, 3]


def _slots(words, displacements, size):
    """The slot of each digest, from the displacement of its group."""
    group, first, second = words
    moved = displacements[(group % np.uint64(len(displacements))).astype(np.int64)]
    return _moved(first, second, moved.astype(np.uint64), size)


def _moved(first, second, displacement, size):
    mixed = first + displacement * (second | np.uint64(1))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(24)) % np.uint64(size)).astype(np.int64)


def build_bucket(digests):
    """Displacements that send `n` distinct digests to the slots 0 to n - 1, largest group first."""
    words = _words(digests)
    size = len(words[0])
    groups = max(1, -(-size // GROUP))
    number = (words[0] % np.uint64(groups)).astype(np.int64)
    ends = np.cumsum(np.bincount(number, minlength=groups))[:-1]
    members = np.split(np.argsort(number, kind="stable"), ends)
    displacements, taken = np.zeros(groups, np.int32), np.zeros(size, bool)
    for group in sorted(range(groups), key=lambda at: -len(members[at])):
        at = members[group]
        if not len(at):
            continue
        base = 0
        while True:
            moved = np.arange(base, base + TRIES, dtype=np.uint64)[:, None]
            slots = _moved(words[1][at], words[2][at], moved, size)
            free = ~taken[slots].any(axis=1)
            if len(at) > 1:
                ordered = np.sort(slots, axis=1)
                free &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            found = np.flatnonzero(free)
            if len(found):
                displacements[group] = base + found[0]
                taken[slots[found[0]]] = True
                break
            base += TRIES
    return displacements


def _ids(column):
    return column.fillna(NO_WINNER).to_numpy(np.int64)


def _joined(column):
    return np.frombuffer(b"".join(bytes(value) for value in column), np.uint8)


def _build(rows):
    digests = _joined(rows["digest"])
    displacements = build_bucket(digests)
    slots = _slots(_words(digests), displacements, len(rows))
    order = np.argsort(slots)
    return pd.DataFrame(
        {
            "bucket": [rows["bucket"].iloc[0]],
            "digests": [digests.reshape(-1, DIGEST)[order].tobytes()],
            "displacements": [displacements.tobytes()],
            "winners": [_ids(rows["winner"])[order].tobytes()],
            "copies": [rows["copies"].to_numpy(np.int64)[order].tobytes()],
        }
    )


def buckets_for(digests):
    return max(1, -(-digests // BUCKET_DIGESTS))


def build_index(history, buckets):
    """The index of distinct digests: a row per bucket, some thousand slots in each."""
    return _with_bucket(history, buckets).groupBy("bucket").applyInPandas(
        _build, INDEX
    )


def _nullable(ids):
    return pd.Series(ids, dtype="Int64").mask(pd.Series(ids == NO_WINNER))


def _merge(index, rows):
    """The bucket's slots with what the incoming digests add, then the digests it does not hold."""
    if len(rows):
        incoming = _joined(rows["digest"])
        winners, copies = _ids(rows["winner"]), rows["copies"].to_numpy(np.int64)
    else:
        incoming = np.zeros(0, np.uint8)
        winners = copies = np.zeros(0, np.int64)
    outside = np.ones(len(rows), bool)
    held = np.zeros((0, DIGEST), np.uint8)
    slot_winners = slot_copies = np.zeros(0, np.int64)
    if len(index):
        row = index.iloc[0]
        held = np.frombuffer(row["digests"], np.uint8).reshape(-1, DIGEST)
        slot_winners = np.frombuffer(row["winners"], np.int64).copy()
        slot_copies = np.frombuffer(row["copies"], np.int64).copy()
        displacements = np.frombuffer(row["displacements"], np.int32)
        slots = _slots(_words(incoming), displacements, len(held))
        found = (held[slots] == incoming.reshape(-1, DIGEST)).all(axis=1)
        outside = ~found
        np.maximum.at(slot_winners, slots[found], winners[found])
        np.add.at(slot_copies, slots[found], copies[found])
    new = incoming.reshape(-1, DIGEST)[outside]
    return pd.DataFrame(
        {
            "digest": [value.tobytes() for value in held] + [value.tobytes() for value in new],
            "winner": _nullable(np.append(slot_winners, winners[outside])),
            "copies": np.append(slot_copies, copies[outside]),
            "known": np.append(np.ones(len(held), bool), np.zeros(len(new), bool)),
        }
    )


def look_up(index, incoming, buckets):
    """Groups after the incoming distinct digests met the index; `known` says who has a slot."""
    return (
        index.groupBy("bucket")
        .cogroup(_with_bucket(incoming, buckets).groupBy("bucket"))
        .applyInPandas(_merge, "digest binary, winner bigint, copies bigint, known boolean")
    )


def dedup(history, docs):
    """A row per document of both tables: who stays, how many are equal, and the digest.

    Rows find their group in a plain join. Where one text has a large part of the rows, Spark
    splits its partition, and the other side brings one row per text.
    """
    old = stored(digested(history), "history-digests")
    new = stored(digested(docs), "new-digests")
    buckets = buckets_for(old.count() + new.count())
    index = stored(build_index(distinct_digests(old), buckets), "digest-index")
    groups = stored(look_up(index, distinct_digests(new), buckets), "digest-groups")
    return old.unionByName(new).join(groups, "digest").select(
        "doc_id",
        F.col("winner").alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("winner")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def halves(docs):
    """The table as a history and what came later, cut at the middle of its ids; nothing is lost."""
    middle = docs.agg((F.min("doc_id") / 2 + F.max("doc_id") / 2).alias("middle")).first().middle
    if middle is None:
        return docs, docs.limit(0)
    later = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    return docs.filter(~later), docs.filter(later)


def unique_documents(docs):
    """The rows of `docs` that stay, one per text, with all their columns, whatever their names.

    Of rows that repeat both id and text, the first in the order of the other columns stays; rows
    that share an id, or have none, and differ in their texts are told apart by the digest.
    """
    keys = dedup(*halves(docs)).groupBy("doc_id", F.unhex("text_sha256").alias("digest"), "kept")
    keys = stored(keys.agg(F.count(F.lit(1)).alias("rows")), "digest-keys")
    # The rows that go are the fewer, so their keys are brought to the texts.
    rows = _keyed(docs)
    staying = _without(rows, keys.filter("not kept or rows > 1")).select("row.*")
    again = keys.filter("kept and rows > 1")
    if again.isEmpty():
        return staying
    # Only rows that are there more than once are dealt again.
    return staying.unionByName(first_copies(_within(rows, again)))


def _keyed(docs):
    """Rows whole, as `row`, beside their id and digest, so that no column's name matters."""
    return docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").alias("doc_id"),
        F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)).alias("digest"),
    )


def _matched(rows, keys, how):
    known = keys.select(F.col("doc_id").alias("known_id"), F.col("digest").alias("known_digest"))
    same = F.col("doc_id").eqNullSafe(F.col("known_id")) & (
        F.col("digest") == F.col("known_digest")
    )
    return rows.join(known, same, how)


def _within(rows, keys):
    return _matched(rows, keys, "left_semi")


def _without(rows, keys):
    return _matched(rows, keys, "left_anti")


def first_copies(rows):
    """One row per id and text; copies are merged before the shuffle, however many there are."""
    kept = rows.groupBy("doc_id", "digest").agg(F.min("row").alias("row"))
    return kept.select("row.*")

"""A trie of the prefixes that rebuilt conversations share, by composable fingerprints.

A rebuilt conversation is the head of its base conversation followed by its own turns behind that
head. No rebuilt text is made. The fingerprint of a run of turns is an element of a monoid: its
length and a polynomial of its turns' digests modulo a prime. Prefixes of the stored conversations
are fingerprinted once, in their order; a rebuilt prefix is the product of a base head and an own
suffix, and the suffix is the quotient of two stored prefixes.

Rebuilt prefixes of equal depth and fingerprint are a node. A node is checked through the stored
turns that its members refer to: the last turns have one digest, and turns of one digest have one
role and text, compared as they stand. As a fingerprint and its last turn fix the fingerprint
before, the prefixes are then equal at every depth. If any check fails, all is done again with
another salt.

Conversations are dealt by ranges of their full order, so one of any length is spread over tasks.
Each task multiplies what it reads; of conversations that reach into several tasks the products are
chained, one row per task. Sums over subtrees go up the trie in doubling steps: in step r a node
sends what it holds to its ancestor 2^r turns up, so the number of steps is the logarithm of the
shared depth. Nodes with one member have known sums and take no part. Ids that end in a node are
joined in parallel and hashed from these parts.

Defined results: a null role or text is empty; null turns come first; turns of one number follow each
other by a hash of their role and text, rows that repeat all of them too count each; rows without
`conv_id` belong to no conversation and are left out; `%` has the sign of the id, as in SQL; an empty
table has no root and gives no rows; other columns are ignored.
"""

import hashlib
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from pagetide.llm.tables import ship, stored

GROUP = 5
HEADS = 9
# Prime modulus of fingerprints and bytes of a turn's digest, by attempt; the last goes on.
STRENGTHS = ((2**127 - 1, 32),)
IDS_PER_PART = 1_000

_ORDER = ["conv_id", "turn", "digest"]


_power = lru_cache(1 << 16)(pow)


class Products:
    """The monoid of (length, polynomial) under one prime and one base."""

    def __init__(self, salt, modulus):
        self.modulus = modulus
        seed = hashlib.sha256(f"base {salt}".encode()).digest()
        self.base = 2 + int.from_bytes(seed, "big") % (modulus - 2)

    def turn(self, digest):
        """The polynomial of a run of one turn."""
        return self.base * int.from_bytes(digest[:16], "big") % self.modulus

    def then(self, n, x, y):
        """The polynomial of a run of `n` turns and one behind it."""
        return (x + _power(self.base, n, self.modulus) * y) % self.modulus

    def without(self, n, x, whole):
        """What is behind the first `n` turns of a run, given theirs and that of the whole."""
        return (whole - x) * _power(self.base, -n, self.modulus) % self.modulus


def _number(value):
    return 0 if value is None else int.from_bytes(value, "big")


def _bytes(number):
    return number.to_bytes(16, "big")


def hashed(conversations, salt, digest_bytes):
    """Turns with a digest of role and text in place of both."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    sized = F.concat_ws(":", F.lit(str(salt)), F.octet_length(role).cast("string"))
    digest = F.unhex(F.sha2(F.concat(sized, F.lit(":"), role, text), 256))
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.substring(digest, 1, digest_bytes).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size"),
        role.alias("role"),
        text.alias("text"),
    )


_TURNS = "conv_id bigint, part int, place bigint, digest binary, size bigint, product binary"
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _batch(ddl, rows):
    """Rows of a declared layout as an Arrow batch."""
    fields = [field.split() for field in ddl.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    arrays = [pa.array(list(values), _KINDS[kind]) for values, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _pieces(products):
    """Turns in order, each with its place and product in the task's piece of its conversation.

    Only the first and the last conversation of a task may reach into others; their whole pieces
    follow, without a digest.
    """

    def run(batches):
        part, conversation, ends = TaskContext.get().partitionId(), None, []
        place = product = 0
        for batch in batches:
            rows = []
            for conv_id, digest, size in zip(*(column.to_pylist() for column in batch.columns)):
                if conv_id != conversation:
                    if conversation is not None and not ends:
                        ends.append((conversation, part, place, None, None, _bytes(product)))
                    conversation, place, product = conv_id, 0, 0
                product = products.then(place, product, products.turn(digest))
                place += 1
                rows.append((conv_id, part, place, digest, size, _bytes(product)))
            yield _batch(_TURNS, rows)
        if conversation is not None:
            ends.append((conversation, part, place, None, None, _bytes(product)))
        yield _batch(_TURNS, ends)

    return run


def _chained(products):
    """Length and product of what comes before each piece of a conversation."""

    def run(pieces):
        before, product, found = 0, 0, []
        for row in pieces.sort_values("part").itertuples():
            if before:
                found.append((row.conv_id, row.part, before, _bytes(product)))
            product = products.then(before, product, _number(row.product))
            before += row.place
        return pd.DataFrame(found, columns=["conv_id", "part", "before", "product_before"])

    return run


_HEADS = "conv_id bigint, position bigint, product binary, digest binary, size bigint"


def _absolute(products):
    def run(batches):
        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns))
            yield _batch(
                _HEADS,
                [
                    (
                        conv_id,
                        position,
                        _bytes(products.then(before, _number(first), _number(product))),
                        digest,
                        size,
                    )
                    for conv_id, position, product, digest, size, before, first in rows
                ],
            )

    return run


_PREFIXES = "conv_id bigint, depth bigint, product binary, digest binary, size bigint"


def _behind_heads(products):
    """Products of a base head and the own turns from behind the cut to the row's turn."""

    def run(batches):
        for batch in batches:
            made = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                conv_id, position, product, digest, size, before, first, cut, own, n, head = row
                whole = products.then(before, _number(first), _number(product))
                suffix = products.without(cut, _number(own), whole)
                product = products.then(n, _number(head), suffix)
                made.append((conv_id, n + position - cut, _bytes(product), digest, size))
            yield _batch(_PREFIXES, made)

    return run


def _rebuilt(placed, products):
    """Per conversation: where its own turns are cut, the head it takes, and its depth."""
    firsts = placed.filter(F.col("position") < HEADS).select(
        "conv_id", "position", "product", "digest", "size", "before", "product_before"
    )
    firsts = firsts.mapInArrow(_absolute(products), _HEADS)
    # At most eight turns a conversation.
    heads = firsts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "product", "digest", "size"))).alias("head")
    )
    known = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    known = stored(known.join(heads, "conv_id"), "heads")
    base = known.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    cut = F.crc32(F.col("conv_id").cast("string")) % HEADS
    rows = (
        known.withColumn("cut", cut)
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
        .join(base, "base", "left")
        .withColumn("base_head", F.coalesce("base_head", F.array().cast(known.schema["head"].dataType)))
        .withColumn("n_head", F.least(F.col("cut"), F.size("base_head").cast("bigint")))
    )
    last = lambda head, n: F.get(F.col(head), n.cast("int") - 1)["product"]
    return stored(
        rows.select(
            "conv_id",
            "cut",
            "n_head",
            F.slice("base_head", F.lit(1), F.col("n_head").cast("int")).alias("taken"),
            last("head", F.least("cut", "n_own")).alias("own_product"),
            last("base_head", F.col("n_head")).alias("head_product"),
            (F.col("n_head") + F.greatest(F.col("n_own") - F.col("cut"), F.lit(0))).alias("depth"),
        ),
        "rebuilt",
    )


def _prefixes(placed, rebuilt, products):
    """A row per rebuilt conversation and depth of at least one."""
    heads = rebuilt.select("conv_id", F.explode("taken").alias("turn")).select(
        "conv_id",
        F.col("turn.position").alias("depth"),
        "turn.product",
        "turn.digest",
        "turn.size",
    )
    cuts = rebuilt.select("conv_id", "cut", "own_product", "n_head", "head_product")
    behind = placed.join(cuts, "conv_id").filter("position > cut").select(
        "conv_id", "position", "product", "digest", "size", "before", "product_before",
        "cut", "own_product", "n_head", "head_product",
    )
    return heads.unionByName(behind.mapInArrow(_behind_heads(products), _PREFIXES))


def _texts_differ(conversations, turns, salt, digest_bytes):
    """Whether two stored turns of one digest differ in role or text."""
    repeated = turns.groupBy("digest").count().filter("count > 1").select("digest")
    texts = hashed(conversations, salt, digest_bytes).join(repeated, "digest", "left_semi")
    content = F.struct("role", "text")
    ends = (F.min("content").alias("least"), F.max("content").alias("most"))
    # First apart by conversation, so that a turn that is found everywhere is not one task's work.
    spread = texts.select("digest", F.pmod(F.hash("conv_id"), F.lit(64)).alias("share"), content.alias("content"))
    apart = spread.groupBy("digest", "share").agg(*ends)
    whole = apart.groupBy("digest").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    return not whole.filter("least <> most").isEmpty()


def _attempt(conversations, salt, modulus, digest_bytes):
    """Prefixes with the node they belong to, and what is known of it; None where a check fails."""
    products = Products(salt, modulus)
    known = hashed(conversations, salt, digest_bytes).drop("role", "text")
    known = stored(known, "turns")
    pieces = stored(
        known.repartitionByRange(*_ORDER)
        .sortWithinPartitions(*_ORDER)
        .select("conv_id", "digest", "size")
        .mapInArrow(_pieces(products), _TURNS),
        "pieces",
    )
    turns = pieces.filter("digest is not null")
    if _texts_differ(conversations, turns, salt, digest_bytes):
        return None
    ends = pieces.filter("digest is null").select("conv_id", "part", "place", "product")
    carried = stored(
        ends.groupBy("conv_id").applyInPandas(
            _chained(products), "conv_id bigint, part int, before bigint, product_before binary"
        ),
        "carried",
    )
    before = F.coalesce("before", F.lit(0))
    placed = turns.join(carried, ["conv_id", "part"], "left").withColumns(
        {"position": F.col("place") + before, "before": before}
    )
    rebuilt = _rebuilt(placed, products)
    prefixes = stored(_prefixes(placed, rebuilt, products), "prefixes")
    nodes = stored(
        prefixes.groupBy("depth", "product").agg(
            F.min("conv_id").alias("node"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("size").alias("size"),
            (F.min("digest") == F.max("digest")).alias("same"),
        ),
        "nodes",
    )
    if not nodes.filter("not same").isEmpty():
        return None
    members = prefixes.select("conv_id", "depth", "product").join(nodes, ["depth", "product"])
    members = members.select("conv_id", "depth", "node", "n_convs", "size")
    return rebuilt, stored(members, "members")


def _with_root(rebuilt, members):
    """The members of all nodes, those of the root included."""
    root = rebuilt.agg(F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"))
    rows = rebuilt.select("conv_id", F.lit(0).cast("bigint").alias("depth"))
    # One row, so it is broadcast however many conversations there are.
    roots = rows.join(F.broadcast(root.filter("node is not null")), F.lit(True))
    return roots.withColumn("size", F.lit(0).cast("bigint")).unionByName(members)


def _summed(shared, members):
    """Leaves and saved tokens of the subtrees of shared nodes, in doubling steps."""
    places = members.filter("n_convs > 1").select(
        F.col("conv_id").alias("node"), F.col("depth").alias("up"), F.col("node").alias("target")
    )
    deepest = shared.agg(F.max("depth").alias("depth")).first().depth or 0
    held, step = shared.select("node", "depth", "leaves", "saved"), 1
    while step <= deepest:
        sent = held.filter(F.col("depth") >= step).withColumn("up", F.col("depth") - step)
        got = (
            sent.join(places, ["node", "up"])
            .groupBy(F.col("target").alias("node"), F.col("up").alias("depth"))
            .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        )
        held = stored(
            held.join(got, ["node", "depth"], "left").select(
                "node",
                "depth",
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "subtrees",
        )
        step *= 2
    return held


_PARTS = "node bigint, depth bigint, first bigint, ids string"
_ENDS = "node bigint, depth bigint, ends_sha256 string"


def _joined(batches):
    """Ids in order to texts of a bounded number of ids of one node."""
    key, ids = None, []
    for batch in batches:
        made = []
        for node, depth, conv_id in zip(*(column.to_pylist() for column in batch.columns)):
            if key != (node, depth) or len(ids) == IDS_PER_PART:
                if ids:
                    made.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids = (node, depth), []
            ids.append(conv_id)
        yield _batch(_PARTS, made)
    yield _batch(_PARTS, [(*key, ids[0], ",".join(map(str, ids)))] if ids else [])


def _digests(batches):
    """The hash over a node's parts in order."""
    key, digest = None, None
    for batch in batches:
        made = []
        for node, depth, ids in zip(*(column.to_pylist() for column in batch.columns)):
            if key != (node, depth):
                if digest:
                    made.append((*key, digest.hexdigest()))
                key, digest = (node, depth), hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
        yield _batch(_ENDS, made)
    yield _batch(_ENDS, [(*key, digest.hexdigest())] if digest else [])


def _ends(rebuilt, members):
    """Per node the hash of the ids of the conversations that end there."""
    ends = members.join(rebuilt.select("conv_id", "depth"), ["conv_id", "depth"])
    order = ["node", "depth", "conv_id"]
    parts = (
        ends.select(*order)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_joined, _PARTS)
    )
    return (
        parts.repartition("node", "depth")
        .sortWithinPartitions("node", "depth", "first")
        .select("node", "depth", "ids")
        .mapInArrow(_digests, _ENDS)
    )


def prefix_trie(conversations, strengths=STRENGTHS):
    """One row per node: members, children, leaves, saved tokens and who ends there."""
    ship(conversations.sparkSession)
    salt, found = 0, None
    while found is None:
        found = _attempt(conversations, salt, *strengths[min(salt, len(strengths) - 1)])
        salt += 1
    rebuilt, deeper = found
    members = _with_root(rebuilt, deeper)
    nodes = members.filter("conv_id = node").drop("conv_id")
    above = members.select(
        F.col("conv_id").alias("node"),
        (F.col("depth") + 1).alias("depth"),
        F.col("node").alias("parent_conv_id"),
    )
    nodes = stored(nodes.join(above, ["node", "depth"], "left"), "trie")
    children = nodes.filter("depth > 0").groupBy(
        F.col("parent_conv_id").alias("node"), (F.col("depth") - 1).alias("depth")
    )
    children = children.agg(
        F.count(F.lit(1)).alias("children"),
        F.sum((F.col("n_convs") == 1).cast("bigint")).alias("single"),
    )
    counted = nodes.join(children, ["node", "depth"], "left")
    # A child with one member is a chain that ends in one leaf and saves nothing.
    shared = stored(
        counted.filter("n_convs > 1").select(
            "node",
            "depth",
            F.coalesce("single", F.lit(1)).alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        ),
        "shared",
    )
    sums = _summed(shared, members)
    return (
        counted.join(sums, ["node", "depth"], "left")
        .join(_ends(rebuilt, members), ["node", "depth"], "left")
        .select(
            F.col("node").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("children", F.lit(0)).alias("n_children"),
            F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )

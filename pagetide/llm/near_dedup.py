"""Near duplicates by MinHash with sequential Bayesian verification.

A document is the set of its five-word shingles, by 64-bit hashes. Documents with equal sets are one
class from the start. Classes that share a band of minimum hashes are candidates. The signatures of
a candidate pair are compared in batches; a pair is dropped as soon as the posterior probability
that it reaches the threshold, given the matches so far and a uniform prior, is below the chosen
miss probability. What survives is confirmed on the full sets.

No bucket is expanded into all its pairs. First each class is compared with one centre of its
buckets, and linked classes are merged into components. Buckets of one component are then done, as
links inside it change nothing. In small other buckets the classes of different components are
compared, which is bounded by the size of a small bucket. Large ones are dealt into finer buckets
by one more band, where the same is done again, and kept whole beside them; what is still large after
the last level is compared block by block. No case is dropped, and nothing of the corpus passes through the driver.

Chances of a miss: a pair at the threshold shares no band with a probability of 7e-7, and is pruned
wrongly with less than `MISS` per batch.

Defined results: null and empty texts, and texts of white space, have no shingles and are linked with
nothing; a text of fewer than five words is one shingle; rows that repeat a `doc_id` are judged by
their own texts, and a null id loses to any other; an empty table gives an empty result; other
columns are ignored.
"""

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from pagetide.llm.shingles import mixed, shingle_hashes, word_hashes
from pagetide.llm.tables import stored, texts

PERCENT = 85
BANDS, ROWS = 30, 6
# Of each minimum a sketch keeps the last byte; minima that differ match there once in 256 times.
BATCH, BATCHES = 32, 16
HASHES = BATCH * BATCHES
MISS = 1e-7
# A bucket of at most so many classes is compared at once.
SMALL = 1024
LEVELS = 3
# Ids of documents to verify are broadcast up to this number, 8 bytes each, and joined beyond it.
MOST_BROADCAST = 500_000

_CHUNK = 1 << 11


def _parameters():
    random = np.random.default_rng(20240229)
    values = random.integers(0, 1 << 32, (2, HASHES, 1), dtype=np.uint64).astype(np.uint32)
    return values[0] | np.uint32(1), values[1]


_FACTORS, _TERMS = _parameters()


def signature(shingles):
    """The minimum of each hash function over the set, a bounded part of it at a time."""
    halves = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(halves), _CHUNK):
        part = halves[start : start + _CHUNK] * _FACTORS + _TERMS
        np.minimum(least, part.min(axis=1), out=least)
    return least


def band_hashes(signatures):
    """A 64-bit hash per band and row of a matrix of signatures; it depends on the band's place."""
    banded = signatures[:, : BANDS * ROWS].astype(np.uint64)
    by_band = banded.reshape(len(signatures), BANDS, ROWS)
    found = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signatures), BANDS))
    for at in range(ROWS):
        found = mixed(found + by_band[:, :, at])
    return found.view(np.int64)


def least_matches(percent=PERCENT, miss=MISS):
    """Per batch: the fewest matches so far with which a pair goes on.

    With a uniform prior, `m` of `n` matches leave a chance of a match of at least t with the
    probability that a binomial of n + 1 trials and chance t is at most m.
    """
    similarity, found = percent / 100, []
    chance = similarity + (1 - similarity) / 256
    for batch in range(1, BATCHES + 1):
        trials, total, matches = batch * BATCH + 1, 0.0, -1
        while total < miss:
            matches += 1
            total += comb(trials, matches) * chance**matches * (1 - chance) ** (trials - matches)
        found.append(matches)
    return found


def survivors(left, right, bounds):
    """Which rows of two matrices of sketches survive all batches."""
    live, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for batch, bound in enumerate(bounds):
        part = slice(batch * BATCH, (batch + 1) * BATCH)
        matches[live] += (left[live, part] == right[live, part]).sum(axis=1)
        live = live[matches[live] >= bound]
    return live


def _values(column):
    """The values of a binary column one after the other, without a copy, and where each starts."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), starts


def _sketches(column):
    if not len(column):
        return np.zeros((0, HASHES), np.uint8)
    data, starts = _values(column)
    return data[starts[0] : starts[-1]].reshape(-1, HASHES)


# Reading the documents.

SUMMARY = (
    "doc_id bigint, n_shingles bigint, row bigint, digest binary, sketch binary, "
    "bands array<bigint>"
)


def _digest(shingles):
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _summarise(batches):
    base, seen = TaskContext.get().partitionId() << 33, 0
    for batch in batches:
        count = batch.num_rows
        sets = [shingle_hashes(word_hashes(raw)) for raw in batch.column(1).to_pylist()]
        full = [at for at, one in enumerate(sets) if len(one)]
        signatures = np.array([signature(sets[at]) for at in full], np.uint32)
        signatures = signatures.reshape(len(full), HASHES)
        sketches = signatures.astype(np.uint8)
        bands = band_hashes(signatures)
        digests, sketch, band = [None] * count, [None] * count, [None] * count
        for place, at in enumerate(full):
            digests[at], sketch[at] = _digest(sets[at]), sketches[place].tobytes()
            band[at] = bands[place]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(one) for one in sets], pa.int64()),
                pa.array(range(base + seen, base + seen + count), pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(sketch, pa.binary()),
                pa.array(band, pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "row", "digest", "sketch", "bands"],
        )
        seen += count


def _raw(docs):
    return texts(docs).withColumn("text", F.col("text").cast("binary"))


def summaries(docs):
    """Per row of documents: size and digest of its set, its sketch and its band hashes."""
    return _raw(docs).mapInArrow(_summarise, SUMMARY)


def classes(rows):
    """A row per distinct set. `node` names it, `first_doc` is the smallest id that has it."""
    return (
        rows.filter(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(
            F.min("row").alias("node"),
            F.min("doc_id").alias("first_doc"),
            F.any_value("sketch").alias("sketch"),
            F.any_value("bands").alias("bands"),
        )
    )


# Candidates.


def _shared(keyed):
    """`key`, `node` and the bucket's size, for keys with several nodes."""
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    # Stored, so that Spark can split the rows of a hot key in the join.
    return keyed.join(stored(sizes, "near-sizes"), "key")


def _star_pairs(members):
    """Each node with one centre, the one of those of its buckets that it shares most buckets with.

    The centre of a bucket is the node with the most neighbours in all its buckets. Among edited
    copies that is one with few edits, and so one that most others are closest to.
    """
    degrees = members.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = members.join(degrees, "node").groupBy("key").agg(
        F.max(F.struct("degree", (-F.col("node")).alias("lowest"))).alias("best")
    )
    centres = stored(ranked.select("key", (-F.col("best.lowest")).alias("centre")), "near-centres")
    shared = (
        members.join(centres, "key").filter("node <> centre").groupBy("node", "centre").count()
    )
    best = F.max(F.struct("count", (-F.col("centre")).alias("lowest"))).alias("best")
    return shared.groupBy("node").agg(best).select(
        (-F.col("best.lowest")).alias("a"), F.col("node").alias("b")
    )


def _survive(bounds):
    def run(batches):
        for batch in batches:
            left, right = (_sketches(batch.column(at)) for at in (2, 3))
            kept = pa.array(survivors(left, right, bounds))
            yield batch.select([0, 1]).take(kept)

    return run


def pruned(pairs, known, bounds):
    """The pairs whose sketches survive."""
    sketch = known.select("node", "sketch")
    both = pairs.join(
        sketch.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), "a"
    ).join(sketch.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")), "b")
    return both.select("a", "b", "sketch_a", "sketch_b").mapInArrow(
        _survive(bounds), "a bigint, b bigint"
    )


def _bands(column):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(-1, BANDS)


def _compare_runs(bounds, once):
    """Survivors among rows of equal keys, which follow each other, in different components.

    With `once`, keys are bands, and a pair is left to the first band that it shares.
    """

    def compare(table):
        bands = _bands(table.column(4)) if once else None
        keys, nodes, parts = (
            table.column(at).to_numpy() for at in (0, 1, 2)
        )
        sketches = _sketches(table.column(3))
        found_a, found_b = [], []
        step, left = 1, np.arange(len(keys))
        while True:
            left = left[left + step < len(keys)]
            left = left[keys[left] == keys[left + step]]
            if not len(left):
                break
            differ = left[parts[left] != parts[left + step]]
            for start in range(0, len(differ), 1 << 14):
                some = differ[start : start + (1 << 14)]
                kept = some[survivors(sketches[some], sketches[some + step], bounds)]
                if once and len(kept):
                    first = (bands[kept] == bands[kept + step]).argmax(axis=1)
                    kept = kept[bands[kept, first] == keys[kept]]
                found_a.append(nodes[kept])
                found_b.append(nodes[kept + step])
            step += 1
        none = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(none + found)) for found in (found_a, found_b)],
            names=["a", "b"],
        )

    def run(batches):
        waiting = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if waiting is not None:
                table = pa.concat_tables([waiting, table])
            if not table.num_rows:
                continue
            # The last key may go on in the next batch.
            keys = table.column(0).to_numpy()
            end = int(np.searchsorted(keys, keys[-1]))
            if end:
                yield compare(table.slice(0, end).combine_chunks())
            waiting = table.slice(end).combine_chunks()
        if waiting is not None and waiting.num_rows:
            yield compare(waiting)

    return run


def _within(rows, known, bounds, once=False):
    """Survivors inside buckets of `key`, `node` and `component`; each bucket is of bounded size.

    `once` is for keys that are bands: of the buckets that a pair shares, the first one reports it.
    That bucket holds both of its classes and is open as long as they are in different components.
    """
    values = ["sketch", "bands"] if once else ["sketch"]
    return (
        rows.select("key", "node", "component")
        .join(known.select("node", *values), "node")
        .select("key", "node", "component", *values)
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_compare_runs(bounds, once), "a bigint, b bigint")
        .distinct()
    )


def _finer(rows, known):
    """Large buckets dealt again by each band that their nodes have.

    The band of the bucket itself is among them, so the bucket goes on whole as well and reaches
    the blocks if it stays large: a pair may share no other band.
    """
    bands = known.select("node", F.explode("bands").alias("band"))
    return (
        rows.select("key", "node")
        .join(bands, "node")
        .select(F.xxhash64("key", "band").alias("key"), "node")
        .distinct()
    )


def _in_blocks(rows):
    """Large buckets as pairs of blocks: each two nodes meet in one, and each is of bounded size."""
    blocks = F.ceil(F.col("size") / SMALL).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    return rows.select(
        "key", "node", "component", own.alias("own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    ).select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
        "node",
        "component",
    )


# Exact confirmation.


def _sets(batches):
    for batch in batches:
        found = [shingle_hashes(word_hashes(raw)) for raw in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([_digest(one) for one in found], pa.binary()),
                pa.array([one.tobytes() for one in found], pa.binary()),
            ],
            names=["digest", "shingles"],
        )


def similar(left, right, percent=PERCENT):
    """Whether two sorted arrays of distinct hashes reach the threshold."""
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= percent * (len(left) + len(right) - common)


def _confirm(percent):
    def run(batches):
        for batch in batches:
            (left, left_at), (right, right_at) = (_values(batch.column(at)) for at in (2, 3))
            kept = [
                at
                for at in range(batch.num_rows)
                if similar(
                    left[left_at[at] : left_at[at + 1]].view(np.uint64),
                    right[right_at[at] : right_at[at + 1]].view(np.uint64),
                    percent,
                )
            ]
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))

    return run


def _among(docs, wanted):
    """The documents whose ids are wanted: by broadcast up to a checked number, else by a join."""
    ids = wanted.select("first_doc").distinct()
    ids = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("first_doc")), "left_semi")


def confirmed(docs, known, pairs, percent, ids_repeat=True):
    """The pairs whose full sets reach the threshold; the sets are made again from the texts.

    A set is made once per class, unless ids repeat: then each row of an id makes its own.
    """
    names = known.select("node", "digest", "first_doc")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = stored(names.join(ends, "node"), "near-wanted")
    sets = _among(_raw(docs), wanted).mapInArrow(_sets, "digest binary, shingles binary")
    if ids_repeat:
        sets = sets.dropDuplicates(["digest"])

    def end(name):
        return wanted.select(F.col("node").alias(name), F.col("digest").alias(f"digest_{name}"))

    def side(name):
        return sets.select(
            F.col("digest").alias(f"digest_{name}"), F.col("shingles").alias(f"shingles_{name}")
        )

    return (
        pairs.join(end("a"), "a")
        .join(end("b"), "b")
        .join(side("a"), "digest_a")
        .join(side("b"), "digest_b")
        .select("a", "b", "shingles_a", "shingles_b")
        .mapInArrow(_confirm(percent), "a bigint, b bigint")
    )


# Components.


def _are_stars(edges):
    """Whether every node has one edge to a root, and no root has an edge itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs"))
    roots = edges.select("v", F.lit(0), F.lit(1))
    seen = ends.union(roots).groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return seen.filter("ups > 1 or ups > 0 and downs > 0").isEmpty()


def components(links):
    """`node` and `component`, the smallest node it can be reached from, for linked nodes.

    Large-star and small-star steps in turn hang nodes below smaller ones until only stars are left.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct(),
        "near-edges",
    )
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(
            both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root")), "near-least"
        )
        large = both.filter("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("root").alias("v")
        )
        large = stored(large.filter("u <> v").distinct(), "near-large")
        lowest = stored(large.groupBy("u").agg(F.min("v").alias("root")), "near-lowest")
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("root").alias("v"))
        own = lowest.select("u", F.col("root").alias("v"))
        edges = stored(small.filter("u <> v").union(own).distinct(), "near-edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


# The whole.


class _Search:
    def __init__(self, docs, known, percent, ids_repeat):
        self.docs, self.known, self.percent = docs, known, percent
        self.ids_repeat = ids_repeat
        self.bounds = least_matches(percent)
        self.components = None

    def link(self, pairs):
        """Confirm the pairs and merge what they link."""
        pairs = stored(pairs, "near-survivors")
        if pairs.isEmpty():
            return
        links = confirmed(self.docs, self.known, pairs, self.percent, self.ids_repeat)
        if self.components is not None:
            old = self.components.select(F.col("node").alias("a"), F.col("component").alias("b"))
            links = links.unionByName(old)
        self.components = components(links)

    def open_buckets(self, members):
        """Members of buckets with several components, with the size of the bucket."""
        if self.components is None:
            placed = members.withColumn("component", F.col("node"))
        else:
            placed = members.join(self.components, "node", "left").withColumn(
                "component", F.coalesce("component", "node")
            )
        placed = placed.select("key", "node", "component", "size")
        mixed_keys = (
            placed.groupBy("key")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .filter("low <> high")
        )
        return stored(placed.join(mixed_keys, "key").drop("low", "high"), "near-open")

    def run(self):
        keyed = self.known.select(F.explode("bands").alias("key"), "node")
        for level in range(1, LEVELS + 1):
            members = stored(_shared(keyed), "near-members")
            if members.isEmpty():
                break
            self.link(pruned(_star_pairs(members), self.known, self.bounds))
            left = self.open_buckets(members)
            small = left.filter(F.col("size") <= SMALL)
            self.link(_within(small, self.known, self.bounds, once=level == 1))
            large = left.filter(F.col("size") > SMALL)
            if large.isEmpty():
                break
            if level == LEVELS:
                self.link(_within(_in_blocks(large), self.known, self.bounds))
            else:
                keyed = _finer(large, self.known)
        return self.components


def near_duplicates(docs, percent=PERCENT):
    """Per row of documents: `n_shingles`, the component's smallest id, and who stays."""
    rows = stored(summaries(docs), "near-rows")
    known = stored(classes(rows), "near-classes")
    repeated = rows.groupBy("doc_id").count().filter("count > 1")
    linked = _Search(docs, known, percent, not repeated.isEmpty()).run()
    placed = known.select("digest", "node", "first_doc")
    if linked is None:
        placed = placed.withColumn("component_id", F.col("first_doc"))
    else:
        # Linked classes alone; a component is counted before it is joined.
        members = stored(placed.join(linked, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        ), "near-placed")
        firsts = stored(
            members.groupBy("component").agg(F.min("first_doc").alias("component_id")),
            "near-firsts",
        )
        placed = members.join(firsts, "component")
    placed = stored(placed.select("digest", "component_id"), "near-components")
    found = rows.select("doc_id", "n_shingles", "digest").join(placed, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def unique_documents(docs, percent=PERCENT):
    """The rows of `docs` that stay: one per component, with all their columns, whatever their names.

    The row with the smallest id stays. Where ids are missing or repeat, rows are numbered in the
    order of id and text first, those without an id last, so exactly one row of a component stays.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    ids = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if not ids.filter("n > 1 or doc_id is null").isEmpty():
        # Numbers rise with the order of a sorted table, and are written before they are used.
        ordered = rows.orderBy(F.col("doc_id").asc_nulls_last(), F.sha2("text", 256))
        number = F.monotonically_increasing_id()
        rows = stored(ordered.select("row", number.alias("doc_id"), "text"), "near-numbered")
    going = near_duplicates(rows.select("doc_id", "text"), percent).filter("not kept")
    return rows.join(going.select("doc_id"), "doc_id", "left_anti").select("row.*")

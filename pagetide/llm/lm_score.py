"""Cross-entropy difference between a target and a background language model.

Both models are pairs of token ids over one vocabulary, that of a public byte-level tokenizer. The
target model counts documents labelled good and not toxic, the background model counts all documents,
and its counts are scaled to the target's number of tokens, so that smoothing weighs alike in both. A
pair's count is mixed with the estimate of its second token alone, and that with the uniform
distribution, so pairs and tokens that were never counted have a loss as well. A document's score is
the mean over its tokens of the difference of the two losses, in bits; the lower, the more it is like
the target.

Texts are read and encoded once. Documents are taken in blocks of bounded size: a block keeps the
ids of its documents, compressed, and lists its distinct pairs with both counts. Only pairs are
counted over the corpus, so the models grow with it and are stored tables; the losses come back to
each block that has the pair, and the block scores its documents. However often a pair occurs, it is
one row a block. The tables of single tokens have a row per id of the vocabulary and are broadcast.

Defined results: null and empty texts have no tokens and the difference 0; without target documents
both models are uniform and all differences are 0; labels with nulls are ignored; a null `doc_id` is
never a target; repeated rows count and are scored each; an empty table gives no rows; other columns
are ignored.
"""

from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F

from pagetide.llm.tables import stored, texts
from pagetide.llm.token_ids import encoder

# How many tokens' worth of counts a shorter estimate adds to a longer one.
SMOOTHING = 20.0
# Characters of text in a block; a longer text is a block of its own.
BLOCK_SIZE = 1 << 23
# Ids of target documents are broadcast up to this number, 8 bytes each, and joined beyond it.
MOST_TARGETS = 2_000_000

_FIELDS = {
    "block": pa.int64(),
    # A document: its number of tokens, and its compressed ids.
    "doc_id": pa.int64(),
    "n_tokens": pa.int64(),
    "ids": pa.binary(),
    # A pair of ids of a block, in one number, and its counts there.
    "pair": pa.int64(),
    "target": pa.int64(),
    "background": pa.int64(),
}
_PARTS = pa.schema(list(_FIELDS.items()))
_DDL = ", ".join(f"{name} {'binary' if name == 'ids' else 'bigint'}" for name in _FIELDS)


def _table(**columns):
    """A batch of one kind of rows; the columns of the other kind are null."""
    rows = len(columns["block"])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[name], kind) if name in columns else pa.nulls(rows, kind)
            for name, kind in _FIELDS.items()
        ],
        schema=_PARTS,
    )


def pairs_of(ids, sizes, start):
    """Each token and the one before it as one number; the first of each run comes after `start`."""
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    firsts = np.cumsum(sizes) - sizes
    before[firsts[sizes > 0]] = start
    return before << 32 | ids


@lru_cache(maxsize=1)
def _packer():
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _block(number, rows, encode):
    """Rows of a block: its documents, then its distinct pairs."""
    found = [np.frombuffer(encode(text), np.uint32) for _, text, _ in rows]
    sizes = np.array(list(map(len, found)), np.int64)
    pack = _packer()[0].compress
    yield _table(
        block=[number] * len(rows),
        doc_id=[doc_id for doc_id, _, _ in rows],
        n_tokens=sizes,
        ids=[pack(ids.tobytes()) for ids in found],
    )
    ids = np.concatenate(found).astype(np.int64)
    if not len(ids):
        return
    pairs, numbers = np.unique(pairs_of(ids, sizes, encode.vocabulary), return_inverse=True)
    chosen = np.repeat([is_target for _, _, is_target in rows], sizes)
    yield _table(
        block=np.full(len(pairs), number),
        pair=pairs,
        target=np.bincount(numbers[chosen], minlength=len(pairs)),
        background=np.bincount(numbers, minlength=len(pairs)),
    )


def _blocks(path, block_size):
    def run(batches):
        encode, number = encoder(path), TaskContext.get().partitionId() << 33
        waiting, size = [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                waiting.append(row)
                size += len(row[1])
                if size >= block_size:
                    yield from _block(number, waiting, encode)
                    waiting, size = [], 0
                    number += 1
        if waiting:
            yield from _block(number, waiting, encode)

    return run


def target_ids(labels):
    """Ids of the documents that all their labels call good and not toxic."""
    return (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality", "toxic")
        .dropna()
        .groupBy("doc_id")
        .agg((F.min("quality") == 1).alias("good"), (F.max("toxic") == 0).alias("clean"))
        .filter("good and clean")
        .select("doc_id")
    )


def encoded(docs, labels=None, path=None, block_size=BLOCK_SIZE):
    """The stored blocks of a table; without labels, no document is a target."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    rows = texts(docs)
    if labels is None:
        marked = rows.withColumn("is_target", F.lit(False))
    else:
        ids = stored(target_ids(labels).withColumn("is_target", F.lit(True)), "targets")
        ids = F.broadcast(ids) if ids.count() <= MOST_TARGETS else ids
        marked = rows.join(ids, "doc_id", "left").withColumn(
            "is_target", F.coalesce("is_target", F.lit(False))
        )
    marked = marked.select("doc_id", "text", "is_target")
    return stored(marked.mapInArrow(_blocks(path, block_size), _DDL), "token-blocks")


class Models:
    """Counts of pairs, of second tokens and of first tokens, as tables, and their totals."""

    def __init__(self, parts, path=None):
        both = [F.sum(name).alias(name) for name in ("target", "background")]
        self.path = path or public_tokenizers.path("byte_bpe_50k.json")
        self.vocabulary = encoder(self.path).vocabulary
        counted = parts.filter("pair is not null").groupBy("pair").agg(*both)
        self.pairs = stored(counted, "pair-counts")

        def single(token, name):
            sums = self.pairs.groupBy(token.alias(name)).agg(*both)
            renamed = [F.col(kind).alias(f"{kind}_{name}") for kind in ("target", "background")]
            # At most a row per id of the vocabulary.
            return F.broadcast(stored(sums.select(name, *renamed), f"{name}-counts"))

        self.seconds = single(F.col("pair").bitwiseAND((1 << 32) - 1), "second")
        self.firsts = single(F.shiftright("pair", 32), "first")
        total = self.seconds.agg(F.sum("target_second"), F.sum("background_second")).first()
        self.total, background = (value or 0 for value in total)
        self.scale = self.total / background if background else 0.0

    def losses(self, pairs):
        """The pairs with the bits of their second token in both models, counted or not."""
        known = (
            pairs.withColumn("first", F.shiftright("pair", 32))
            .withColumn("second", F.col("pair").bitwiseAND((1 << 32) - 1))
            .join(self.pairs, "pair", "left")
            .join(self.firsts, "first", "left")
            .join(self.seconds, "second", "left")
        )

        def mixed(count, shorter, context):
            return (count + F.lit(SMOOTHING) * shorter) / (context + F.lit(SMOOTHING))

        def bits(kind, times):
            found, first, second = (
                F.coalesce(F.col(name), F.lit(0)) * F.lit(times)
                for name in (kind, f"{kind}_first", f"{kind}_second")
            )
            alone = mixed(second, F.lit(1.0 / self.vocabulary), F.lit(float(self.total)))
            return (-F.log2(mixed(found, alone, first))).alias(f"{kind}_bits")

        return known.select(
            *pairs.columns, bits("target", 1.0), bits("background", self.scale)
        )


_SCORED = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double"


def _score(vocabulary):
    def run(docs, pairs):
        sizes = docs.column("n_tokens").to_numpy()
        unpack = _packer()[1].decompress
        raw = b"".join(unpack(ids.as_py()) for ids in docs.column("ids"))
        own = pairs_of(np.frombuffer(raw, np.uint32).astype(np.int64), sizes, vocabulary)
        order = np.argsort(pairs.column("pair").to_numpy())
        at = np.searchsorted(pairs.column("pair").to_numpy()[order], own)
        ends = np.cumsum(sizes)
        columns = [docs.column("doc_id"), docs.column("n_tokens")]
        for name in ("target_bits", "background_bits"):
            bits = pairs.column(name).to_numpy()[order][at]
            # A running sum, so that texts without tokens need no care.
            running = np.append(0.0, np.cumsum(bits, dtype=np.float64))
            columns.append(pa.array((running[ends] - running[ends - sizes]) / np.maximum(sizes, 1)))
        return pa.table(columns, names=[part.split()[0] for part in _SCORED.split(", ")])

    return run


def scored(parts, models):
    """Documents of stored blocks, scored: their number of tokens, both losses, the difference."""
    pairs = parts.filter("pair is not null").select(F.col("block").alias("in_block"), "pair")
    bits = models.losses(pairs).select(
        "in_block",
        "pair",
        F.col("target_bits").cast("float").alias("target_bits"),
        F.col("background_bits").cast("float").alias("background_bits"),
    )
    rows = parts.filter("pair is null").select("block", "doc_id", "n_tokens", "ids")
    found = rows.groupBy("block").cogroup(bits.groupBy("in_block")).applyInArrow(
        _score(models.vocabulary), _SCORED
    )
    return found.withColumn("difference", F.col("target_loss") - F.col("background_loss"))


def cross_entropy_difference(docs, labels, path=None, block_size=BLOCK_SIZE):
    """The score of each document under models of all of them."""
    parts = encoded(docs, labels, path, block_size)
    return scored(parts, Models(parts, path))

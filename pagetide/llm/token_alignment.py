"""Alignment of the tokens of two tokenizers, byte by byte, by anchors at white space.

Each text is tokenised whole by both. Where a token of either ends at the same byte and the next
token of either is marked with a space, the text is cut: an anchor. Between anchors lie windows of a
few ids, and natural texts repeat them, so the alignment of a window is kept once, by its two tuples
of ids. The merged ends of tokens give the links, which are all pairs of tokens whose bytes overlap,
and the groups, which end where both tokens end.

How often a pair of ids is linked in the whole corpus is needed for every document. Documents are
taken in blocks of bounded size. A block lists its distinct windows once, its documents as numbers
of windows, and its distinct pairs with their counts. Only pairs are counted over the corpus; the
counts come back to each block that has the pair, and the block scores its windows and so its
documents. What is shuffled is a row per block and distinct pair, however often a pair occurs, and
about two bytes per window. No model is collected or broadcast, and texts are read once.

Defined results: texts that are null or empty, or that a tokenizer does not give back byte for byte,
have no tokens: zeros and an empty digest. A null `doc_id` is kept as it is; repeated rows are
aligned and counted each; an empty table gives no rows; other columns are ignored. Texts without
spaces are one window.
"""

import hashlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from pagetide.llm.tables import stored, texts
from pagetide.llm.token_ids import encoder, token_bytes

# Characters of text in a block; a longer text is a block of its own.
BLOCK_SIZE = 1 << 22


class Side:
    """One vocabulary: bytes, lengths, space marks and decimal names by id."""

    def __init__(self, tokens, last):
        self.tokens = tokens
        self.lengths = np.array(list(map(len, tokens)), np.int64)
        self.spaced = np.array([token[:1] == b" " for token in tokens])
        # An id inside a group, then the same id at the end of one.
        ids = range(len(tokens))
        self.names = np.array([f"{i},".encode() for i in ids] + [f"{i}{last}".encode() for i in ids])

    def joined(self, ids):
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def piece_bytes(pieces):
    """The bytes of each id of a sentencepiece model."""
    return [
        bytes([int(piece[3:5], 16)])
        if pieces.is_byte(number)
        else piece.replace("\u2581", " ").encode()
        for number, piece in enumerate(map(pieces.id_to_piece, range(pieces.get_piece_size())))
    ]


class Tokenizers:
    def __init__(self, byte_level, piece_model):
        from sentencepiece import SentencePieceProcessor

        pieces = SentencePieceProcessor(model_file=piece_model)
        self.first = Side(token_bytes(byte_level), "|")
        self.second = Side(piece_bytes(pieces), ";")
        self._encode = encoder(byte_level, plain=True)
        self._pieces = pieces.encode

    def __call__(self, text):
        """Ids of both sides, or None where one does not stand for the text."""
        if not text:
            return None
        spaced = " " + text
        written = spaced.encode()
        first = np.frombuffer(self._encode(spaced), np.uint32)
        second = np.array(self._pieces(text, num_threads=1), np.uint32)
        if self.first.joined(first) != written or self.second.joined(second) != written:
            return None
        return first, second


@lru_cache(maxsize=1)
def tokenizers(byte_level, piece_model):
    """One pair per Python worker."""
    return Tokenizers(byte_level, piece_model)


def _mixed(values):
    """Hashes of numbers, by the finishing steps of splitmix64."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _stretched(starts, sizes):
    """The numbers of all places of runs that begin at `starts`."""
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - before, sizes)


class Windows:
    """The tokens of a block's documents, end to end, cut into groups and windows."""

    def __init__(self, first, second, doc_ends, one, other):
        """`doc_ends`: the place behind each document's last token of the first side."""
        ends, ends_other = np.cumsum(one.lengths[first]), np.cumsum(other.lengths[second])
        here, there = np.zeros((2, ends[-1] + 1), bool)
        here[ends], there[ends_other] = True, True
        self.closes, self.closes_other = there[ends], here[ends_other]
        # Places behind the last token of each group, on either side.
        self.after = np.flatnonzero(self.closes) + 1
        self.beside = np.flatnonzero(self.closes_other) + 1
        ended = np.zeros(len(first) + 1, bool)
        ended[doc_ends] = True
        # The ids looked at behind the last token do not matter: a document ends there.
        cut = one.spaced[first[np.minimum(self.after, len(first) - 1)]]
        cut &= other.spaced[second[np.minimum(self.beside, len(second) - 1)]]
        cut |= ended[self.after]
        self.ends, self.ends_other = self.after[cut], self.beside[cut]
        self.group_ends = np.flatnonzero(cut) + 1
        self.starts, self.starts_other = (
            np.concatenate([[0], places[:-1]]) for places in (self.ends, self.ends_other)
        )
        # A link ends where a token of either side ends; where a group ends, both do.
        link_ends = self.ends + self.ends_other - self.group_ends
        self.link_starts = np.concatenate([[0], link_ends[:-1]])
        self.n_links = link_ends - self.link_starts
        places = np.flatnonzero(here | there)
        here, there = here[places], there[places]
        own, its = np.cumsum(here) - here, np.cumsum(there) - there
        self.links = (first[own].astype(np.int64) << 32) | second[its]
        self.first, self.second = first, second

    def _sides(self):
        yield self.first, self.starts, self.ends - self.starts
        yield self.second, self.starts_other, self.ends_other - self.starts_other

    def distinct(self):
        """The first window with the ids of each, on both sides, and a number for each of those.

        Windows are found by a hash and compared id by id; a window that differs from the first of
        its hash stands for itself.
        """
        hashes = np.zeros(len(self.starts), np.uint64)
        for side, (ids, starts, sizes) in enumerate(self._sides()):
            place = np.arange(len(ids)) - np.repeat(starts, sizes)
            salted = (place.astype(np.uint64) << np.uint64(33)) + (ids + np.uint64(side << 32))
            hashes += np.add.reduceat(_mixed(salted + np.uint64(0x9E3779B97F4A7C15)), starts)
        _, firsts, numbers = np.unique(hashes, return_index=True, return_inverse=True)
        wrong = np.zeros(len(hashes), bool)
        for ids, starts, sizes in self._sides():
            model = firsts[numbers]
            wrong |= sizes != sizes[model]
            model = np.where(wrong, np.arange(len(model)), model)
            same = ids[_stretched(starts[model], sizes)] == ids
            wrong |= ~np.logical_and.reduceat(same, starts)
        alone = np.flatnonzero(wrong)
        numbers[alone] = len(firsts) + np.arange(len(alone))
        return np.concatenate([firsts, alone]), numbers

    def groups(self, one, other):
        """The groups as text, id by id, each with the mark behind it, padded with zero bytes."""
        group = np.cumsum(self.closes) - self.closes
        group_other = np.cumsum(self.closes_other) - self.closes_other
        before = np.concatenate([[0], self.beside[:-1]])
        width = max(one.names.itemsize, other.names.itemsize)
        merged = np.empty(len(self.first) + len(self.second), f"S{width}")
        closing = len(one.tokens) * self.closes, len(other.tokens) * self.closes_other
        merged[np.arange(len(self.first)) + before[group]] = one.names[self.first + closing[0]]
        merged[np.arange(len(self.second)) + self.after[group_other]] = other.names[
            self.second + closing[1]
        ]
        return merged


def _planes(numbers):
    """Numbers as bytes, all low bytes first, which compresses well where most are small."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes):
    return np.ascontiguousarray(
        np.frombuffer(planes, np.uint8).reshape(4, -1).T
    ).view("<u4").ravel()


_PARTS = pa.schema(
    [
        ("block", pa.int64()),
        # A document: its numbers, and the windows it is made of.
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("windows", pa.binary()),
        # A block: links per window, and for each link the place of its pair among the block's.
        ("sizes", pa.binary()),
        ("links", pa.binary()),
        # A pair of a block: both ids in one number, and how often it is linked there.
        ("pair", pa.int64()),
        ("n", pa.int64()),
    ]
)


def _table(**columns):
    """A batch of one kind of rows; the columns of other kinds are null."""
    rows = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[field.name], field.type)
            if field.name in columns
            else pa.nulls(rows, field.type)
            for field in _PARTS
        ],
        schema=_PARTS,
    )


def _block(number, doc_ids, block_texts, tools):
    """Rows of a block: its documents, its windows, and its pairs."""
    one, other = tools.first, tools.second
    tokens = list(map(tools, block_texts))
    rows = [(0, 0, 0, 0, "", b"")] * len(tokens)
    full = [at for at, found in enumerate(tokens) if found]
    sizes = links = pairs = counts = np.zeros(0, np.int64)
    if full:
        n_a, n_b = (np.array([len(tokens[at][side]) for at in full]) for side in (0, 1))
        first, second = (np.concatenate([tokens[at][side] for at in full]) for side in (0, 1))
        del tokens
        doc_ends = np.cumsum(n_a)
        windows = Windows(first, second, doc_ends, one, other)
        models, numbers = windows.distinct()
        # Frequent windows get small numbers.
        times = np.bincount(numbers, minlength=len(models))
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        numbers, models, times = rank[numbers], models[order], times[order]
        sizes = windows.n_links[models]
        own = windows.links[_stretched(windows.link_starts[models], sizes)]
        pairs, links = np.unique(own, return_inverse=True)
        # Counts of a block are far below 2^53.
        counts = np.bincount(links, np.repeat(times, sizes), len(pairs)).astype(np.int64)
        written, ends = windows.groups(one, other), np.cumsum(n_a + n_b)
        last = np.searchsorted(windows.ends, doc_ends) + 1
        groups = np.diff(windows.group_ends[last - 1], prepend=0)
        starts = np.concatenate([[0], last[:-1]])
        for place, at in enumerate(full):
            text = written[ends[place] - n_a[place] - n_b[place] : ends[place]].view(np.uint8)
            digest = hashlib.sha256(text[text != 0][:-1].tobytes()).hexdigest()
            steps = int(n_a[place] + n_b[place] - groups[place])
            found = _planes(numbers[starts[place] : last[place]])
            rows[at] = n_a[place], n_b[place], groups[place], steps, digest, found
    names = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "windows")
    values = dict(zip(names, map(list, zip(*rows))))
    yield _table(block=[number] * len(rows), doc_id=doc_ids, **values)
    yield _table(block=[number], sizes=[_planes(sizes)], links=[_planes(links)])
    if len(pairs):
        yield _table(block=np.full(len(pairs), number), pair=pairs, n=counts)


def _blocks(paths, block_size):
    def run(batches):
        tools = tokenizers(*paths)
        number = TaskContext.get().partitionId() << 33
        doc_ids, waiting, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(*(column.to_pylist() for column in batch.columns)):
                doc_ids.append(doc_id)
                waiting.append(text)
                size += len(text)
                if size >= block_size:
                    yield from _block(number, doc_ids, waiting, tools)
                    doc_ids, waiting, size = [], [], 0
                    number += 1
        if waiting:
            yield from _block(number, doc_ids, waiting, tools)

    return run


_SCORED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


def _score(rows, pairs):
    """Documents of a block, scored by the corpus-wide counts of the block's pairs."""
    pairs = pairs.sort_by("pair")
    counts = pairs.column("total").to_numpy()
    best = pairs.column("is_best").to_numpy(zero_copy_only=False).astype(np.int64)
    own = rows.filter(rows.column("links").is_valid())
    docs = rows.filter(rows.column("links").is_null())
    sums = bests = np.zeros(0, np.int64)
    if own.num_rows and len(counts):
        places = _numbers(own.column("links")[0].as_py())
        sizes = _numbers(own.column("sizes")[0].as_py()).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        sums = np.add.reduceat(counts[places], starts)
        bests = np.add.reduceat(best[places], starts)
    windows = [_numbers(ids.as_py()) for ids in docs.column("windows")]
    for name, values in (("n_best", bests), ("count_sum", sums)):
        found = pa.array([int(values[own].sum()) for own in windows], pa.int64())
        docs = docs.append_column(name, found)
    return docs.select([part.split()[0] for part in _SCORED.split(", ")])


def pair_counts(parts):
    """Links of each pair of ids over the corpus, and whether no pair of its second id has more."""
    counts = (
        parts.filter("pair is not null")
        .groupBy("pair")
        .agg(F.sum("n").alias("total"))
        .withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1))
    )
    most = counts.groupBy("b").agg(F.max("total").alias("most"))
    return counts.join(most, "b").select(
        F.shiftright("pair", 32).alias("a"),
        "b",
        "pair",
        "total",
        (F.col("total") == F.col("most")).alias("is_best"),
    )


def alignments(docs, byte_level=None, piece_model=None, block_size=BLOCK_SIZE):
    """The stored parts of an alignment: documents, blocks with their windows, and pairs."""
    paths = (
        byte_level or public_tokenizers.path("byte_bpe_50k.json"),
        piece_model or public_tokenizers.path("piece_bpe_32k.model"),
    )
    ddl = ", ".join(
        f"{field.name} {({pa.int64(): 'bigint', pa.string(): 'string'}).get(field.type, 'binary')}"
        for field in _PARTS
    )
    return stored(texts(docs).mapInArrow(_blocks(paths, block_size), ddl), "alignment")


def aligned(docs, **settings):
    """One row per document: tokens of either side, groups, links and how common the links are."""
    parts = alignments(docs, **settings)
    pairs = parts.filter("pair is not null").select(F.col("block").alias("in_block"), "pair")
    scored = pairs.join(pair_counts(parts), "pair").select("in_block", "pair", "total", "is_best")
    rows = parts.filter("pair is null").drop("pair", "n")
    return (
        rows.groupBy("block").cogroup(scored.groupBy("in_block")).applyInArrow(_score, _SCORED)
    )

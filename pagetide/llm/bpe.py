"""Byte-level BPE from a rank file: each match of the split pattern is merged on its own.

A segment tree over the byte positions of a match keeps, in its root, the smallest rank of a pair
of neighbouring live tokens and its leftmost place. A merge joins the pair, links the live
neighbours past the dead position, and updates three leaves, each along one path to the root.

Distinct matches are merged once per worker and remembered. Short ones are merged side by side, a
tree per row of one array; long ones have a tree of their own, so that a match of n bytes takes
n log n steps whatever it looks like.

Defined results: null text is empty and has no ids; a null `doc_id` and repeated rows are kept;
other columns are ignored.
"""

import base64
import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa

from pagetide.llm.tables import texts
from pagetide.llm.words import split

SIDE_BY_SIDE = 32
KEPT_WORDS = 400_000
SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Ranks:
    """Token bytes by id, and the id that each pair of ids merges into. The id is the rank."""

    def __init__(self, path):
        with open(path, "rb") as file:
            lines = (line.split() for line in file if line.strip())
            ids = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes = [b""] * (max(ids.values()) + 1)
        for token, rank in ids.items():
            self.bytes[rank] = token
        self.single = np.array([ids[bytes([value])] for value in range(256)], np.int64)
        self.none = len(self.bytes)
        self.pairs = {}
        for token, rank in ids.items():
            for at in range(1, len(token)):
                left, right = ids.get(token[:at]), ids.get(token[at:])
                if left is not None and right is not None:
                    self.pairs[left, right] = rank
        keys = np.array([left << 32 | right for left, right in self.pairs], np.int64)
        order = np.argsort(keys)
        self._keys = np.append(keys[order], np.iinfo(np.int64).max)
        self._ranks = np.append(np.array([*self.pairs.values()], np.int64)[order], self.none)

    def of_pairs(self, left, right):
        """Ranks of pairs side by side; `none` where a pair does not merge."""
        keys = left << 32 | right
        at = np.searchsorted(self._keys, keys)
        return np.where(self._keys[at] == keys, self._ranks[at], self.none)


def merge_long(word, ranks):
    """Ids of one match, with one tree in a list. A leaf is rank * size + place."""
    ids = ranks.single[np.frombuffer(word, np.uint8)].tolist()
    count, pair = len(ids), ranks.pairs.get
    size = 1 << max(0, count - 1).bit_length()
    nothing = ranks.none * size
    tree = [nothing] * (2 * size)
    for at in range(count - 1):
        rank = pair((ids[at], ids[at + 1]))
        if rank is not None:
            tree[size + at] = rank * size + at
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    following, previous = [*range(1, count + 1)], [*range(-1, count - 1)]

    def update(place, value):
        node = size + place
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least

    def leaf(place):
        other = following[place]
        rank = pair((ids[place], ids[other])) if other < count else None
        return nothing if rank is None else rank * size + place

    while tree[1] < nothing:
        rank, place = divmod(tree[1], size)
        dead = following[place]
        ids[place], ids[dead] = rank, -1
        after = following[dead]
        following[place] = after
        if after < count:
            previous[after] = place
        update(dead, nothing)
        update(place, leaf(place))
        if previous[place] >= 0:
            update(previous[place], leaf(previous[place]))
    return [token for token in ids if token >= 0]


def merge_short(words, ranks, size):
    """Ids of matches of at most `size` bytes, `size` a power of two: a tree per row."""
    count = np.array([len(word) for word in words], np.int64)
    rows = np.arange(len(words))
    padded = b"".join(word.ljust(size, b"\0") for word in words)
    ids = ranks.single[np.frombuffer(padded, np.uint8).reshape(len(words), size)]
    places = np.arange(size)
    ids[places >= count[:, None]] = -1
    nothing = ranks.none * size

    tree = np.full((len(words), 2 * size), nothing, np.int64)
    inside = places[:-1] + 1 < count[:, None]
    of_pairs = ranks.of_pairs(ids[:, :-1], ids[:, 1:])
    known = inside & (of_pairs < ranks.none)
    tree[:, size : 2 * size - 1] = np.where(known, of_pairs * size + places[:-1], nothing)
    width = size
    while width > 1:
        below = tree[:, width : 2 * width]
        width //= 2
        tree[:, width : 2 * width] = np.minimum(below[:, ::2], below[:, 1::2])
    following = np.broadcast_to(places + 1, ids.shape).copy()
    previous = np.broadcast_to(places - 1, ids.shape).copy()

    def update(at, place, value):
        node = size + place
        tree[at, node] = value
        while node[0] > 1:
            node = node >> 1
            tree[at, node] = np.minimum(tree[at, 2 * node], tree[at, 2 * node + 1])

    def leaf(at, place):
        other = following[at, place]
        last = other >= count[at]
        rank = ranks.of_pairs(ids[at, place], ids[at, np.where(last, place, other)])
        return np.where(last | (rank == ranks.none), nothing, rank * size + place)

    live = rows[tree[:, 1] < nothing]
    while len(live):
        rank, place = np.divmod(tree[live, 1], size)
        dead = following[live, place]
        ids[live, place], ids[live, dead] = rank, -1
        after = following[live, dead]
        following[live, place] = after
        linked = after < count[live]
        previous[live[linked], after[linked]] = place[linked]
        update(live, dead, nothing)
        update(live, place, leaf(live, place))
        before = previous[live, place]
        inner = before >= 0
        if inner.any():
            update(live[inner], before[inner], leaf(live[inner], before[inner]))
        live = live[tree[live, 1] < nothing]
    kept = ids >= 0
    flat = ids[kept].tolist()
    ends = np.cumsum(kept.sum(axis=1)).tolist()
    return [flat[start:end] for start, end in zip([0, *ends], ends)]


class Encoder:
    def __init__(self, path):
        self.ranks = Ranks(path)
        self._known = {}

    def _learn(self, words):
        by_size = {}
        for word in words:
            raw = word.encode()
            size = 1 << (len(raw) - 1).bit_length()
            if size > SIDE_BY_SIDE:
                self._known[word] = merge_long(raw, self.ranks)
            else:
                by_size.setdefault(max(2, size), []).append((word, raw))
        for size, group in by_size.items():
            merged = merge_short([raw for _, raw in group], self.ranks, size)
            for (word, _), ids in zip(group, merged):
                self._known[word] = ids

    def encode_all(self, texts):
        """A list of ids per text."""
        if len(self._known) > KEPT_WORDS:
            self._known = {}
        words = [split(text) for text in texts]
        self._learn(set().union(*words) - self._known.keys())
        known = self._known.__getitem__
        return [list(chain.from_iterable(map(known, found))) for found in words]

    def decode(self, ids):
        return b"".join(map(self.ranks.bytes.__getitem__, ids))


@lru_cache(maxsize=1)
def encoder(path):
    return Encoder(path)


def _pieces(columns, most=500, most_chars=2_000_000):
    """Slices of a batch that keep the ids of a slice small; one long text may be a slice."""
    start = chars = 0
    ids, batch = columns
    for at, text in enumerate(batch):
        chars += len(text)
        if at + 1 - start >= most or chars >= most_chars:
            yield ids[start : at + 1], batch[start : at + 1]
            start, chars = at + 1, 0
    if start < len(batch):
        yield ids[start:], batch[start:]


def encoded(docs, path=None):
    """`doc_id` and its `ids`."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    kinds = [pa.int64(), pa.list_(pa.int32())]

    def run(batches):
        work = encoder(path)
        for batch in batches:
            for doc_ids, some in _pieces([column.to_pylist() for column in batch.columns]):
                arrays = map(pa.array, [doc_ids, work.encode_all(some)], kinds)
                yield pa.RecordBatch.from_arrays([*arrays], names=["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def decoded(rows, path=None):
    """`doc_id` and the `decoded` bytes of its `ids`."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    kinds = [pa.int64(), pa.binary()]

    def run(batches):
        work = encoder(path)
        for batch in batches:
            doc_ids, ids = (column.to_pylist() for column in batch.columns)
            arrays = map(pa.array, [doc_ids, [work.decode(found) for found in ids]], kinds)
            yield pa.RecordBatch.from_arrays([*arrays], names=["doc_id", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded binary")


def digests(docs, path=None):
    """Per document: number of ids, and digests of the ids and of the bytes decoded from them.

    The round trip stays inside one task, so no ids are shuffled or stored.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def run(batches):
        work = encoder(path)
        decimal = [b"%d" % rank for rank in range(len(work.ranks.bytes))].__getitem__
        for batch in batches:
            for doc_ids, some in _pieces([column.to_pylist() for column in batch.columns]):
                rows = []
                for doc_id, ids in zip(doc_ids, work.encode_all(some)):
                    written = hashlib.sha256(b" ".join(map(decimal, ids))).hexdigest()
                    back = hashlib.sha256(work.decode(ids)).hexdigest()
                    rows.append((doc_id, len(ids), written, back))
                arrays = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return texts(docs).mapInArrow(run, SCHEMA)

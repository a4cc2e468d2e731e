"""Hierarchical packing of documents into sequences of several context sizes.

Every document is cut into whole windows of the longest size and a remainder. Remainders are routed
to the shortest tier that holds them. Each tier is packed from its own remainders first, the gaps of
long windows are filled with whole pieces of shorter tiers, and only what is left is filled by
cutting a piece. Windows of one tier are then dealt into step groups of equal token count and
similar attention cost.

A task packs what it reads, so nothing is shuffled. It holds one block of pieces; what does not
fill a window waits for the next block, and the end of the task is cut into powers of two, so no
sequence is padded.

Defined results: null text is an empty document and has the end id only; a null `doc_id` is kept as
it is; repeated rows are packed each; an empty table gives no pieces; other columns are ignored.
"""

import zlib

import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext

from pagetide.llm.tables import texts
from pagetide.llm.token_ids import encoder

TIERS = (1024, 512, 256, 128)
BLOCK_TOKENS = 1 << 20
STEP_TOKENS = 1 << 14


class Pool:
    """Pieces by length. A bit per length finds the best fit at once."""

    def __init__(self):
        self.pieces = {}
        self.lengths = 0
        self.tokens = 0

    def add(self, piece):
        length = piece[1]
        self.pieces.setdefault(length, []).append(piece)
        self.lengths |= 1 << length
        self.tokens += length

    def _take(self, length):
        found = self.pieces[length]
        piece = found.pop()
        if not found:
            del self.pieces[length]
            self.lengths ^= 1 << length
        self.tokens -= length
        return piece

    def longest(self, most):
        """The longest whole piece of at most `most` tokens."""
        fitting = self.lengths & ((1 << (most + 1)) - 1)
        return self._take(fitting.bit_length() - 1) if fitting else None

    def cut(self, length):
        """`length` tokens off the shortest longer piece; the rest goes back, to a shorter tier."""
        longer = self.lengths >> (length + 1)
        if not longer:
            return None
        at = (longer & -longer).bit_length() + length
        start, size, doc = self._take(at)
        self.add((start + length, size - length, doc))
        return (start, length, doc)


def fill(pool, size):
    """One full window, or None and an unchanged pool when too little is left."""
    if pool.tokens < size:
        return None
    window, gap = [], size
    while gap:
        piece = pool.longest(gap) or pool.cut(gap)
        window.append(piece)
        gap -= piece[1]
    return window


def step_groups(costs, per_group):
    """A group number per window: equal counts, costs dealt out and back from the dearest."""
    groups = -(-len(costs) // per_group)
    numbers = [0] * len(costs)
    for rank, at in enumerate(sorted(range(len(costs)), key=lambda i: -costs[i])):
        turn, place = divmod(rank, groups)
        numbers[at] = place if turn % 2 == 0 else groups - 1 - place
    return numbers


class Packer:
    """Packs the documents of one task; `sequence` numbers are unique in it."""

    def __init__(self, tiers=TIERS, block_tokens=BLOCK_TOKENS, step_tokens=STEP_TOKENS):
        self.tiers = sorted(tiers, reverse=True)
        self.block_tokens = block_tokens
        self.step_tokens = step_tokens
        self.pool = Pool()
        self.full = []
        self.waiting = 0
        self.sequences = 0
        self.groups = 0

    def add(self, doc_id, ids):
        """`ids` are serialised, four bytes each. Returns finished windows, often none."""
        tokens, longest = len(ids) // 4, self.tiers[0]
        whole = tokens - tokens % longest
        doc = (doc_id, tokens, ids)
        for start in range(0, whole, longest):
            self.full.append([(start, longest, doc)])
        if whole < tokens:
            self.pool.add((whole, tokens - whole, doc))
        self.waiting += tokens
        return self._pack() if self.waiting >= self.block_tokens else []

    def _emit(self, windows, size):
        """The windows as (sequence, size, step group, pieces)."""
        per_group = max(1, self.step_tokens // size)
        costs = [sum(piece[1] ** 2 for piece in window) for window in windows]
        made = [
            (self.sequences + at, size, self.groups + group, window)
            for at, (window, group) in enumerate(zip(windows, step_groups(costs, per_group)))
        ]
        self.sequences += len(windows)
        self.groups += -(-len(windows) // per_group)
        return made

    def _pack(self):
        made = []
        for tier, size in enumerate(self.tiers):
            shorter = self.tiers[tier + 1] if tier + 1 < len(self.tiers) else 0
            windows, self.full = self.full, []
            # A tier opens a window for each piece of its own; the gap takes shorter ones.
            while self.pool.lengths >> (shorter + 1):
                window = fill(self.pool, size)
                if window is None:
                    break
                windows.append(window)
            made += self._emit(windows, size)
        self.waiting = self.pool.tokens
        return made

    def finish(self):
        """The rest, in windows that are powers of two and so need no padding."""
        made = self._pack()
        while self.pool.tokens:
            size = 1 << (min(self.pool.tokens, self.tiers[0]).bit_length() - 1)
            made += self._emit([fill(self.pool, size)], size)
        return made


def _span(piece):
    """The serialised ids of a piece, without a copy."""
    start, length, (_, _, ids) = piece
    return memoryview(ids)[4 * start : 4 * (start + length)]


def _pieces(windows, base):
    for sequence, size, group, window in windows:
        offset = 0
        for piece in window:
            start, length, (doc_id, tokens, _) = piece
            crc = zlib.crc32(_span(piece))
            yield doc_id, start, length, crc, tokens, base + sequence, offset, size, base + group
            offset += length


def _sequences(windows, base):
    for sequence, size, group, window in windows:
        spans = [
            {"doc_id": doc_id, "start": start, "length": length}
            for start, length, (doc_id, _, _) in window
        ]
        yield base + sequence, size, base + group, spans, b"".join(map(_span, window))


PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("window_size", pa.int32()),
        ("step_group", pa.int64()),
    ]
)
SEQUENCES = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("window_size", pa.int32()),
        ("step_group", pa.int64()),
        (
            "spans",
            pa.list_(
                pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
            ),
        ),
        ("ids", pa.binary()),
    ]
)


def _batches(path, settings, rows_of, schema):
    def run(batches):
        # Numbers are unique over tasks, and the same when a task is run again.
        base = TaskContext.get().partitionId() << 33
        encode, packer = encoder(path), Packer(**settings)

        def batch(windows):
            rows = list(rows_of(windows, base))
            columns = zip(*rows) if rows else [[] for _ in schema]
            arrays = [pa.array(list(column), field.type) for column, field in zip(columns, schema)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for incoming in batches:
            for doc_id, text in zip(*(column.to_pylist() for column in incoming.columns)):
                if windows := packer.add(doc_id, encode.document(text)):
                    yield batch(windows)
        yield batch(packer.finish())

    return run


def _packed(docs, rows_of, schema, ddl, path, settings):
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return texts(docs).mapInArrow(_batches(path, settings, rows_of, schema), ddl)


def pack(docs, path=None, **settings):
    """One row per piece. `settings` are `tiers`, powers of two, `block_tokens` and `step_tokens`."""
    ddl = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, window_size int, step_group bigint"
    )
    return _packed(docs, _pieces, PIECES, ddl, path, settings)


def pack_sequences(docs, path=None, **settings):
    """One row per sequence: its ids, four bytes each, and the spans of documents in it."""
    ddl = (
        "sequence_id bigint, window_size int, step_group bigint, "
        "spans array<struct<doc_id:bigint,start:bigint,length:bigint>>, ids binary"
    )
    return _packed(docs, _sequences, SEQUENCES, ddl, path, settings)

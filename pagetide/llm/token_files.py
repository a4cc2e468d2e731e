"""Token id files: documents compressed one by one with a shared dictionary, in id order.

Layout below a folder, all of it Parquet, so any file system that Spark knows holds it:

- `dictionary`: one row with the zstandard dictionary and its SHA-256. It is trained on the
  serialised ids of a bounded sample of documents.
- `blocks`: a row per block of documents in ascending `doc_id`. It holds the documents' frames one
  after the other, the offset index into them, and the hash of the dictionary they need. A single
  document is read by its block's id range and its offsets, and decompressed alone.
- `parts`: first id position of each written part, so that positions of blocks are global.

Defined results: null text is an empty document and has the end id only; null ids come first; rows
that repeat a `doc_id` are kept, in order of their text; an empty table gives empty files.
"""

import hashlib
import warnings
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Window, functions as F

from pagetide.llm.tables import texts
from pagetide.llm.token_ids import encoder

# The sample for the dictionary: so many documents, at most so much of each. Everything is encoded.
SAMPLE_DOCUMENTS = 1_000
SAMPLE_CHARACTERS = 16_384
DICTIONARY_BYTES = 65_536
BLOCK_BYTES = 1 << 20
LEVEL = 3

BLOCKS = (
    "part int, block int, tokens_before bigint, tokens bigint, first_doc bigint, last_doc bigint, "
    "doc_ids array<bigint>, n_tokens array<bigint>, offsets array<bigint>, id_bytes int, "
    "dictionary_sha256 string, frames binary"
)
BLOCKS_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("tokens_before", pa.int64()),
        ("tokens", pa.int64()),
        ("first_doc", pa.int64()),
        ("last_doc", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("id_bytes", pa.int32()),
        ("dictionary_sha256", pa.string()),
        ("frames", pa.binary()),
    ]
)


def _serialised(ids, id_bytes):
    """Four-byte ids, narrowed where the vocabulary allows it."""
    return ids if id_bytes == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _widened(raw, id_bytes):
    return raw if id_bytes == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def _id_bytes(path):
    return 2 if encoder(path).vocabulary <= 1 << 16 else 4


def train_dictionary(docs, path, sample=SAMPLE_DOCUMENTS, size=DICTIONARY_BYTES):
    """Dictionary bytes; empty, with a warning, where the sample is too small to train on.

    The sample is the documents whose hashed ids are smallest, and of a long one a piece from a place
    that its id decides. At most `sample` pieces of `SAMPLE_CHARACTERS` reach the driver. Ids are
    picked without reading a text.
    """
    ids = docs.select("doc_id").dropna().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    wanted = {row.doc_id for row in ids.collect()}
    # Texts are fetched by id: sorting them would send each task's first ones to the driver.
    spare = F.greatest(F.char_length("text") - SAMPLE_CHARACTERS, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("doc_id"), spare).cast("int") + 1
    piece = F.substr("text", start, F.lit(SAMPLE_CHARACTERS)).alias("piece")
    rows = docs.filter(F.col("doc_id").isin(wanted)).select(piece).limit(sample)
    narrow = _id_bytes(path)
    ids = [_serialised(encoder(path).document(row.piece), narrow) for row in rows.collect()]
    try:
        return zstandard.train_dictionary(size, ids).as_bytes()
    except zstandard.ZstdError as error:
        warnings.warn(f"no dictionary from {len(ids)} documents: {error}", stacklevel=2)
        return b""


def _compressor(dictionary):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)


def _decompressor(dictionary):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=shared)


class _Block:
    """Frames and offsets of consecutive documents, until the block is large enough."""

    def __init__(self, part, number, tokens_before):
        self.part, self.number, self.tokens_before = part, number, tokens_before
        self.docs, self.tokens, self.frames, self.offsets = [], [], [], [0]

    def add(self, doc_id, tokens, frame):
        self.docs.append(doc_id)
        self.tokens.append(tokens)
        self.frames.append(frame)
        self.offsets.append(self.offsets[-1] + len(frame))

    def row(self, id_bytes, dictionary_hash):
        known = [doc for doc in self.docs if doc is not None]
        return {
            "part": self.part,
            "block": self.number,
            "tokens_before": self.tokens_before,
            "tokens": sum(self.tokens),
            "first_doc": known[0] if known else None,
            "last_doc": known[-1] if known else None,
            "doc_ids": self.docs,
            "n_tokens": self.tokens,
            "offsets": self.offsets,
            "id_bytes": id_bytes,
            "dictionary_sha256": dictionary_hash,
            "frames": b"".join(self.frames),
        }

    def next(self):
        return _Block(self.part, self.number + 1, self.tokens_before + sum(self.tokens))


def _to_blocks(path, dictionary, block_bytes):
    digest = hashlib.sha256(dictionary).hexdigest()

    def run(batches):
        encode, narrow, pack = encoder(path), _id_bytes(path), _compressor(dictionary)
        block = _Block(TaskContext.get().partitionId(), 0, 0)
        for batch in batches:
            for doc_id, text in zip(*(column.to_pylist() for column in batch.columns)):
                ids = encode.document(text)
                block.add(doc_id, len(ids) // 4, pack.compress(_serialised(ids, narrow)))
                if block.offsets[-1] >= block_bytes:
                    yield pa.RecordBatch.from_pylist([block.row(narrow, digest)], BLOCKS_ARROW)
                    block = block.next()
        if block.docs:
            yield pa.RecordBatch.from_pylist([block.row(narrow, digest)], BLOCKS_ARROW)

    return run


def write(docs, out, path=None, block_bytes=BLOCK_BYTES):
    """Encode every document and write the files below `out`.

    Texts are dealt by ranges of `doc_id` before they are encoded, so each is encoded once and parts
    follow each other in order.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    docs = texts(docs)
    dictionary = train_dictionary(docs, path)
    spark.createDataFrame(
        [(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))],
        "dictionary_sha256 string, dictionary binary",
    ).write.mode("overwrite").parquet(f"{out}/dictionary")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    blocks = ordered.mapInArrow(_to_blocks(path, dictionary, block_bytes), BLOCKS)
    # Frames are compressed already.
    blocks.write.mode("overwrite").option("compression", "none").parquet(f"{out}/blocks")

    # One row per part; their number is that of the written files.
    sizes = read_blocks(spark, out).groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select(
        "part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first")
    ).write.mode("overwrite").parquet(f"{out}/parts")


def read_blocks(spark, out):
    return spark.read.schema(BLOCKS).parquet(f"{out}/blocks")


def read_dictionary(spark, out):
    """The dictionary, at most `DICTIONARY_BYTES`, checked against its hash."""
    row = spark.read.parquet(f"{out}/dictionary").first()
    dictionary = bytes(row.dictionary)
    if hashlib.sha256(dictionary).hexdigest() != row.dictionary_sha256:
        raise ValueError(f"the dictionary of {out} does not fit its hash")
    return dictionary


def _from_blocks(dictionary, columns, make):
    """Rows of `make(doc_id, tokens before it, ids)` for each document of the blocks."""
    digest = hashlib.sha256(dictionary).hexdigest()

    def run(batches):
        unpack = _decompressor(dictionary)
        for batch in batches:
            for block in batch.to_pylist():
                if block["dictionary_sha256"] != digest:
                    raise ValueError("a block needs another dictionary")
                frames, offsets, rows = memoryview(block["frames"]), block["offsets"], []
                before = block["tokens_before"]
                for at, doc_id in enumerate(block["doc_ids"]):
                    raw = unpack.decompress(frames[offsets[at] : offsets[at + 1]])
                    ids = _widened(raw, block["id_bytes"])
                    if len(ids) != 4 * block["n_tokens"][at]:
                        raise ValueError(f"document {doc_id} has another length than its index")
                    rows.append((block["part"], *make(doc_id, before, ids)))
                    before += len(ids) // 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), kind.type) for c, kind in zip(zip(*rows), columns)],
                    schema=columns,
                )

    return run


def _read(spark, out, blocks, columns, ddl, make):
    found = blocks.mapInArrow(
        _from_blocks(read_dictionary(spark, out), columns, make), f"part int, {ddl}"
    )
    parts = spark.read.parquet(f"{out}/parts")
    return (
        found.join(parts, "part")
        .withColumn("start", F.col("start") + F.col("first"))
        .drop("part", "first")
    )


def read_index(spark, out):
    """Per document: its place among all ids, its number of ids and their CRC-32, from the files."""
    columns = pa.schema(
        [
            ("part", pa.int32()),
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_crc32", pa.int64()),
        ]
    )
    return _read(
        spark,
        out,
        read_blocks(spark, out),
        columns,
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
        lambda doc_id, before, ids: (doc_id, before, len(ids) // 4, zlib.crc32(ids)),
    )


def read_documents(spark, out, first=None, last=None):
    """Ids of the documents with `first <= doc_id <= last`; other blocks are not read."""
    blocks = read_blocks(spark, out)
    if first is not None:
        blocks = blocks.filter(F.col("last_doc") >= first)
    if last is not None:
        blocks = blocks.filter(F.col("first_doc") <= last)
    columns = pa.schema(
        [
            ("part", pa.int32()),
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("ids", pa.list_(pa.int64())),
        ]
    )
    rows = _read(
        spark,
        out,
        blocks,
        columns,
        "doc_id bigint, start bigint, ids array<bigint>",
        lambda doc_id, before, ids: (doc_id, before, np.frombuffer(ids, "<u4").tolist()),
    )
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    return rows if last is None else rows.filter(F.col("doc_id") <= last)


def read_document(spark, out, doc_id):
    """Ids of one document. Only its frame is decompressed, found by the offset index."""
    at = F.array_position("doc_ids", F.lit(doc_id).cast("bigint")).cast("int")
    frame = F.substring(
        "frames",
        (F.get("offsets", at - 1) + 1).cast("int"),
        (F.get("offsets", at) - F.get("offsets", at - 1)).cast("int"),
    )
    rows = (
        read_blocks(spark, out)
        .filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
        .filter(at > 0)
        .select(frame.alias("frame"), "id_bytes")
        .take(1)
    )
    if not rows:
        return None
    raw = _decompressor(read_dictionary(spark, out)).decompress(bytes(rows[0].frame))
    return np.frombuffer(_widened(raw, rows[0].id_bytes), "<u4").tolist()

"""Packing, token files and byte-level BPE against the public tokenizers."""

import base64
import hashlib
import zlib
from array import array

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from pagetide.llm import bpe, packing, token_files, words
from pagetide.llm.queries import QUERIES
from pagetide.llm.token_ids import TextEncoder

FOLDER = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    "", None, " ", "\n\n  x\n", "a", "it's we'll 'tis", "aaaa" * 40, " " * 300 + "x", "é" * 200,
    "日本語テキスト" * 9, "\x00\x1c\x1f\x85\xa0", "½²٣ ﬁ", "<|endoftext|> end", "ab" * 20_000,
    "a <|endoftext|> b", "end<|endoftext|>", "<|endoftext|><|endoftext|>", "<|endoftext|", "<|endoftext|>",
    "same", "same", "😀 é",
]


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(JSON)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def serial(ids):
    return array("I", ids).tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text(st.characters(max_codepoint=0x300), max_size=60))
def test_quick_split_is_the_public_one(text):
    assert words.split(text) == words._find(text)
    assert "".join(words.split(text)) == text


def test_whole_and_by_word_encoding_agree(reference):
    encode = TextEncoder(JSON)
    for text in ODD:
        assert encode.document(text or "") == serial([*reference(text), 0])
    plain = Tokenizer.from_file(JSON)
    plain.encode_special_tokens = True
    as_text = TextEncoder(JSON, plain=True)
    for text in ODD:
        assert as_text(text or "") == serial(plain.encode(text or "", add_special_tokens=False).ids)
    other = TextEncoder(public_tokenizers.path("word_bpe_49k.json"))
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert other("Some Words") == serial(whole.encode("Some Words", add_special_tokens=False).ids)


def check_packing(rows, expected):
    """Every id in one piece, sequences without gaps, lengths of 1024 or a power of two."""
    pieces, sequences = {}, {}
    for row in rows:
        pieces.setdefault(row.doc_id, []).append(row)
        sequences.setdefault(row.sequence_id, []).append(row)
    assert set(pieces) == set(expected)
    for doc_id, own in pieces.items():
        copies = expected[doc_id]
        tokens = len(copies[0])
        assert all(row.doc_tokens == tokens for row in own)
        covered = sorted(at for row in own for at in range(row.start, row.start + row.length))
        assert covered == sorted(at for ids in copies for at in range(len(ids)))
        for row in own:
            ids = serial(copies[0][row.start : row.start + row.length])
            assert zlib.crc32(ids) == row.ids_crc32
    for own in sequences.values():
        own.sort(key=lambda row: row.offset)
        total = 0
        for row in own:
            assert row.offset == total
            total += row.length
        assert total <= 1024 and total & (total - 1) == 0
        assert total <= own[0].window_size
    return sequences


def test_packing_of_odd_documents(docs, clashing, reference):
    ids = [*range(len(ODD) - 1), None]
    frame = clashing(docs(ODD, ids))
    rows = packing.pack(frame).collect()
    expected = {i: [[*reference(t), 0]] for i, t in zip(ids, ODD)}
    check_packing(rows, expected)


def test_packing_of_the_table(spark, reference):
    rows = QUERIES["op1_pack_documents"](spark, FOLDER).collect()
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    sequences = check_packing(rows, {r.doc_id: [[*reference(r.text), 0]] for r in table})
    # Few documents are cut below the window, and groups of a size hold equally many windows.
    full = [own for own in sequences.values() if own[0].window_size == 1024]
    assert len(full) > 0.8 * len(sequences)
    groups = {}
    for own in sequences.values():
        groups.setdefault((own[0].window_size, own[0].step_group), []).append(own)
    assert all(len(found) <= packing.STEP_TOKENS // size for (size, _), found in groups.items())


def test_empty_table_packs_to_nothing(docs):
    assert packing.pack(docs([])).collect() == []


def test_gaps_are_filled_by_whole_pieces_of_shorter_tiers():
    packer = packing.Packer()
    packer.add("long", bytes(4 * 900))
    packer.add("short", bytes(4 * 124))
    packer.add("tiny", bytes(4 * 3))
    first = packer.finish()[0]
    assert [(piece[2][0], piece[1]) for piece in first[3]] == [("long", 900), ("short", 124)]


def test_sequences_hold_the_ids_of_their_spans(docs, reference):
    rows = packing.pack_sequences(docs(ODD), tiers=(64, 16), block_tokens=100).collect()
    texts = dict(enumerate(ODD))
    tokens = 0
    for row in rows:
        want = b""
        for span in row.spans:
            ids = [*reference(texts[span.doc_id]), 0]
            want += serial(ids[span.start : span.start + span.length])
        assert bytes(row.ids) == want and len(want) <= 4 * row.window_size <= 256
        tokens += len(want) // 4
    assert tokens == sum(len(reference(text)) + 1 for text in ODD)


def test_step_groups_are_even():
    costs = [float(i * i) for i in range(64)]
    numbers = packing.step_groups(costs, 16)
    sums = [sum(c for c, n in zip(costs, numbers) if n == group) for group in range(4)]
    assert [numbers.count(group) for group in range(4)] == [16] * 4
    assert max(sums) < 1.1 * min(sums)


def test_token_files_of_odd_documents(spark, docs, clashing, reference, tmp_path):
    ids = [*range(len(ODD) - 3, -1, -1), 5, None]
    out = str(tmp_path / "files")
    token_files.write(clashing(docs(ODD, ids)), out, block_bytes=200)
    order = sorted(zip(ids, ODD), key=lambda row: (row[0] is not None, row[0], row[1] or ""))
    want, start = [], 0
    for doc_id, text in order:
        found = [*reference(text), 0]
        want.append((doc_id, start, len(found), zlib.crc32(serial(found))))
        start += len(found)
    rows = token_files.read_index(spark, out).orderBy("start").collect()
    assert [tuple(row) for row in rows] == want
    assert token_files.read_document(spark, out, 3) == [*reference(ODD[ids.index(3)]), 0]
    assert token_files.read_document(spark, out, 999) is None
    some = token_files.read_documents(spark, out, 3, 4).orderBy("start").collect()
    assert [row.doc_id for row in some] == [3, 4]


def test_token_files_of_the_table(spark, reference):
    rows = QUERIES["op2_token_files"](spark, FOLDER).orderBy("doc_id").collect()
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for row, source in zip(rows, table, strict=True):
        ids = [*reference(source.text), 0]
        assert tuple(row) == (source.doc_id, start, len(ids), zlib.crc32(serial(ids)))
        start += len(ids)


def test_empty_token_files(spark, docs, tmp_path):
    token_files.write(docs([]), str(tmp_path / "none"))
    assert token_files.read_index(spark, str(tmp_path / "none")).collect() == []


def test_a_dictionary_is_trained_and_checked(spark, tmp_path):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = str(tmp_path / "files")
    token_files.write(table, out)
    assert len(token_files.read_dictionary(spark, out)) > 1000
    hashes = token_files.read_blocks(spark, out).select("dictionary_sha256").distinct().collect()
    assert [row[0] for row in hashes] == [
        hashlib.sha256(token_files.read_dictionary(spark, out)).hexdigest()
    ]


@pytest.fixture(scope="module")
def tiktoken_reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def check_digests(rows, texts, encoding):
    found = sorted(tuple(row)[1:] for row in rows)
    want = []
    for text in texts:
        ids = encoding.encode_ordinary(text or "")
        want.append(
            (
                len(ids),
                hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest(),
            )
        )
    assert found == sorted(want)


def test_bpe_of_odd_documents(docs, clashing, tiktoken_reference):
    rows = bpe.digests(clashing(docs(ODD))).collect()
    check_digests(rows, ODD, tiktoken_reference)
    assert bpe.digests(docs([])).collect() == []


def test_bpe_of_the_table(spark, tiktoken_reference):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = QUERIES["op4_byte_bpe"](spark, FOLDER).collect()
    check_digests(rows, [row.text for row in table.collect()], tiktoken_reference)


def test_bpe_decodes_what_it_encodes(docs):
    frame = docs(ODD)
    back = bpe.decoded(bpe.encoded(frame)).collect()
    assert {row.doc_id: bytes(row.decoded).decode() for row in back} == {
        i: text or "" for i, text in enumerate(ODD)
    }


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=32), min_size=1, max_size=20))
def test_both_forms_of_the_tree_agree(raws):
    ranks = bpe.encoder(RANKS).ranks
    size = 1 << max(1, (max(map(len, raws)) - 1).bit_length())
    assert bpe.merge_short(raws, ranks, size) == [bpe.merge_long(raw, ranks) for raw in raws]


def test_a_very_long_match_is_not_quadratic(tiktoken_reference):
    raw = b"ab" * 100_000
    ids = bpe.merge_long(raw, bpe.encoder(RANKS).ranks)
    assert ids == tiktoken_reference.encode_ordinary(raw.decode())


def test_the_quick_split_tests_sets_of_characters():
    """No classes, which are slow; and the same matches as by the public pattern, for any of them."""
    found = [words._find_ascii.__self__.pattern, words._find_quick.__self__.pattern]
    for pattern in found:
        assert not {r"\s", r"\S", r"\w", r"\W", r"\d"} & {
            pattern[at : at + 2] for at in range(len(pattern))
        }
    characters = [chr(code) for code in range(0x250)]
    for before in ("", " ", "a", "1", "'", "\n ", "é"):
        for after in ("", "s", " ", " b", "\t"):
            texts = [before + character + after for character in characters]
            assert [words.split(text) for text in texts] == [words._find(text) for text in texts]

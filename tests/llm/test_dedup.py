"""Exact and near dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetide.llm import exact_dedup, near_dedup, shingles
from pagetide.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LOWER = {code: code + 32 for code in range(65, 91)}


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def brute_exact(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    found = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        found += [(i, keep, len(ids), i == keep, sha(text)) for i in ids]
    return sorted(found, key=str)


ROWS = [(1, "a"), (2, "A"), (3, "a"), (4, None), (5, ""), (6, " "), (7, "a"), (7, "a"), (None, "x"),
        (None, "a"), (8, "é" * 50_000), (9, "é" * 50_000), (-3, "b")]


def test_exact_dedup_of_odd_documents(docs, clashing):
    ids, texts = zip(*ROWS)
    frame = clashing(docs(texts, ids))
    rows = exact_dedup.dedup(*exact_dedup.halves(frame)).collect()
    assert sorted(map(tuple, rows), key=str) == brute_exact(ROWS)


@pytest.mark.parametrize("cut", [0, 4, len(ROWS)])
def test_any_history_gives_the_same_groups(docs, cut):
    old, new = ROWS[:cut], ROWS[cut:]
    frames = [docs([t for _, t in part], [i for i, _ in part]) for part in (old, new)]
    rows = exact_dedup.dedup(*frames).collect()
    assert sorted(map(tuple, rows), key=str) == brute_exact(ROWS)


def test_exact_dedup_of_nothing(docs):
    assert exact_dedup.dedup(*exact_dedup.halves(docs([]))).collect() == []


def test_exact_dedup_of_the_table(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = QUERIES["op5_exact_dedup"](spark, FOLDER).collect()
    assert sorted(map(tuple, rows), key=str) == brute_exact([(r.doc_id, r.text) for r in table])


@pytest.mark.parametrize("size", [1, 2, 5, 1000, 5000])
def test_the_hash_is_perfect_and_minimal(size):
    digests = np.frombuffer(
        b"".join(hashlib.sha256(b"%d" % i).digest() for i in range(size)), np.uint8
    )
    slots = exact_dedup._slots(
        exact_dedup._words(digests), exact_dedup.build_bucket(digests), size
    )
    assert sorted(slots.tolist()) == list(range(size))


def test_lookups_compare_all_bytes(docs):
    """A digest that the history does not hold lands in some slot and is told apart there."""
    old = exact_dedup.distinct_digests(exact_dedup.digested(docs([f"old {i}" for i in range(500)])))
    new = exact_dedup.distinct_digests(
        exact_dedup.digested(docs([f"new {i}" for i in range(300)] + ["old 7"], range(500, 801)))
    )
    found = exact_dedup.look_up(exact_dedup.build_index(old, 3), new, 3)
    assert found.filter("known").count() == 500
    assert found.filter("not known").count() == 300
    assert [tuple(r) for r in found.filter("copies = 2").select("winner").collect()] == [(800,)]


def test_unique_documents_keep_their_columns(docs):
    ids, texts = zip(*ROWS)
    kept = exact_dedup.unique_documents(docs(texts, ids))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([2, 5, 6, 7, 9, -3, None], key=str)


def test_texts_under_one_id_or_none_stay_beside_an_exact_repeat(docs):
    rows = [(1, "one"), (1, "two"), (None, "three"), (None, "four"), (2, "five"), (2, "five"),
            (None, "six"), (None, "six"), (None, "five"), (3, None), (3, "")]
    ids, texts = zip(*rows)
    kept = exact_dedup.unique_documents(docs(texts, ids)).collect()
    assert sorted(((r.doc_id, r.text or "") for r in kept), key=str) == sorted(
        [(1, "one"), (1, "two"), (None, "three"), (None, "four"), (2, "five"), (None, "six"), (3, "")], key=str
    )


def test_ids_near_the_largest(docs):
    largest = 2**63 - 1
    rows = [(largest, "one"), (largest - 1, "two"), (largest - 2, "one"), (-largest, "two")]
    ids, texts = zip(*rows)
    frame = docs(texts, ids)
    found = exact_dedup.dedup(*exact_dedup.halves(frame)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in found) == [
        (-largest, largest - 1, 2), (largest - 2, largest, 2), (largest - 1, largest - 1, 2),
        (largest, largest, 2),
    ]
    assert {r.doc_id for r in exact_dedup.unique_documents(frame).collect()} == {largest, largest - 1}


def check_values(kept, frame, names):
    """Whole rows of the frame come back, with the values of extra columns."""
    assert kept.columns == frame.columns
    rows = kept.collect()
    assert not Counter(map(tuple, rows)) - Counter(map(tuple, frame.collect()))
    assert all(row[name] == str(row.n_chars) for row in rows for name in names)
    return rows


def test_extra_columns_of_any_name(docs, clashing):
    ids, texts = zip(*ROWS)
    frame = clashing(docs(texts, ids))
    rows = check_values(exact_dedup.unique_documents(frame), frame, clashing.names)
    assert sorted((r.doc_id for r in rows), key=str) == sorted([2, 5, 6, 7, 9, -3, None], key=str)
    ids, texts = zip(*family_rows(3))
    frame = clashing(docs(texts, ids))
    check_values(near_dedup.unique_documents(frame), frame, clashing.names)


# Near duplicates.


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_set(text):
    words = word_list(text)
    if not words:
        return frozenset()
    size = min(5, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_near(rows, percent=85):
    """Component ids by comparing all pairs."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for i, left in enumerate(sets):
        for j in range(i):
            right = sets[j]
            if left and right and 100 * len(left & right) >= percent * len(left | right):
                parent[find(i)] = find(j)
    firsts = {}
    for at, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            root = find(at)
            firsts[root] = min(firsts.get(root, doc_id), doc_id)
    found = []
    for at, (doc_id, _) in enumerate(rows):
        component = firsts.get(find(at)) if sets[at] else doc_id
        found.append((doc_id, len(sets[at]), component, doc_id == component))
    return sorted(found, key=str)


def test_words_and_shingles():
    text = "The  quick\tbrown\x0bFOX é\xa0x\x1fy jumps\nover the quick brown fox"
    hashes = shingles.word_hashes(text.encode()).tolist()
    words = word_list(text)
    assert len(hashes) == len(words)
    assert [hashes.index(h) for h in hashes] == [words.index(w) for w in words]
    long = (text + " ") * 40_000
    assert shingles.word_hashes(long.encode()).tolist() == hashes * 40_000
    for sample in (text, "a b c", "a", "", " \n"):
        found = shingles.shingle_hashes(shingles.word_hashes(sample.encode()))
        assert len(found) == len(shingle_set(sample))


def edited(pick, words, edits):
    words = list(words)
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"edit{pick.randrange(10**6)}"
    return " ".join(words)


def family_rows(seed):
    """Families of edited copies, a passage that most documents share, and odd texts."""
    pick = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for family in range(6):
        base = [f"w{pick.randrange(5000)}" for _ in range(pick.choice([40, 120, 300]))]
        for _ in range(pick.choice([2, 10, 25])):
            texts.append(edited(pick, base, pick.choice([0, 1, 2, 4])))
    for _ in range(40):
        own = [f"u{pick.randrange(10**6)}" for _ in range(pick.choice([0, 3, 8, 40]))]
        texts.append(" ".join(passage + own))
    texts += ["", None, " \n ", "one", "ONE", "one two", "a b c d e", "A B C D E", "one"]
    rows = [(at * 3, text) for at, text in enumerate(texts)]
    pick.shuffle(rows)
    return [*rows, (rows[0][0], rows[0][1]), (None, rows[1][1])]


def test_near_duplicates_of_odd_documents(docs, clashing):
    rows = family_rows(1)
    frame = clashing(docs([t for _, t in rows], [i for i, _ in rows]))
    found = sorted(map(tuple, near_dedup.near_duplicates(frame).collect()), key=str)
    assert found == brute_near(rows)


def test_large_buckets_are_searched_whole(docs, monkeypatch):
    """With tiny limits every bucket is large: finer levels, then blocks, find the same links."""
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    monkeypatch.setattr(near_dedup, "LEVELS", 2)
    monkeypatch.setattr(near_dedup, "MOST_BROADCAST", 0)
    rows = family_rows(2)[:70]
    found = near_dedup.near_duplicates(docs([t for _, t in rows], [i for i, _ in rows]))
    assert sorted(map(tuple, found.collect()), key=str) == brute_near(rows)


def test_a_large_bucket_goes_on_whole(spark):
    """Classes that share no band but the one of the bucket still meet."""
    known = spark.createDataFrame([(n, [7, 100 + n]) for n in range(5)], "node bigint, bands array<bigint>")
    rows = known.select(F.lit(7).cast("bigint").alias("key"), "node")
    for _ in range(near_dedup.LEVELS - 1):
        rows = near_dedup._finer(rows, known)
        sizes = [row["count"] for row in rows.groupBy("key").count().collect()]
        assert max(sizes) == 5


def test_near_duplicates_of_nothing(docs):
    assert near_dedup.near_duplicates(docs([])).collect() == []
    only = near_dedup.near_duplicates(docs([None, "", "x"])).collect()
    assert sorted(map(tuple, only)) == [(0, 0, 0, True), (1, 0, 1, True), (2, 1, 2, True)]


def test_near_duplicates_of_the_table(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = QUERIES["op6_near_dedup"](spark, FOLDER).collect()
    assert sorted(map(tuple, rows), key=str) == brute_near([(r.doc_id, r.text) for r in table])


def test_posterior_bounds_miss_what_was_chosen():
    bounds = near_dedup.least_matches()
    assert bounds == sorted(bounds)
    random_ = np.random.default_rng(5)
    chance = 0.85 + 0.15 / 256
    matches = random_.random((20_000, near_dedup.HASHES)) < chance
    left = matches.astype(np.uint8)
    assert len(near_dedup.survivors(left, np.ones_like(left), bounds)) == 20_000
    far = (random_.random((20_000, near_dedup.HASHES)) < 0.7).astype(np.uint8)
    assert len(near_dedup.survivors(far, np.ones_like(far), bounds)) < 200


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    links = spark.createDataFrame([*chain, *star, (300, 200), (7, 7)], "a bigint, b bigint")
    found = {r.node: r.component for r in near_dedup.components(links).collect()}
    assert {found[i] for i in range(1, 41)} == {0}
    assert {found[i] for i in range(101, 160)} == {100} and found[300] == 200


def test_near_unique_documents(docs):
    rows = family_rows(3)
    frame = docs([t for _, t in rows], [i for i, _ in rows])
    kept = near_dedup.unique_documents(frame)
    assert kept.columns == frame.columns
    want = sorted({i for i, _, _, own in brute_near(rows) if own}, key=str)
    assert sorted({r.doc_id for r in kept.select("doc_id").collect()}, key=str) == want


def test_one_row_of_a_group_without_ids_or_under_one_id(docs, clashing):
    word = [f"w{n}" for n in range(200)]
    copies = [" ".join(word[:at] + ["x"] + word[at:]) for at in (0, 50, 199)]
    other = " ".join(reversed(word))
    texts = [*copies, *copies, other, other, "", "", None]
    for ids in ([None] * 11, [7] * 11, [7, None, 7, 3, 3, None, 7, 7, 3, None, None]):
        frame = clashing(docs(texts, ids))
        rows = check_values(near_dedup.unique_documents(frame), frame, clashing.names)
        kept = [row.text for row in rows]
        # Texts without shingles are linked with nothing, so each of them stays.
        assert sum(text in copies for text in kept) == 1 and kept.count(other) == 1
        assert sum(not text for text in kept) == 3
        assert len(rows) == 5
        least = min((i for i in ids[:6] if i is not None), default=None)
        assert [row.doc_id for row in rows if row.text in copies] == [least]


def test_many_rows_of_one_id_and_text(docs):
    """Sets are made once per class, so k and m rows of two linked classes make no k x m pairs."""
    word = [f"w{n}" for n in range(100)]
    first, second = " ".join(word), " ".join(["x", *word])
    rows = near_dedup.near_duplicates(docs([first, second] * 1500, [1, None] * 1500)).collect()
    assert len(rows) == 3000 and {row.component_id for row in rows} == {1}


def test_no_lineage_is_kept_on_executors(spark):
    """Intermediate tables are read from the shared folder."""
    frame = QUERIES["op6_near_dedup"](spark, FOLDER)
    base = spark.conf.get("spark.checkpoint.dir")
    assert all(base in name for name in frame.inputFiles())
    assert frame.filter(F.col("kept")).count() <= frame.count()

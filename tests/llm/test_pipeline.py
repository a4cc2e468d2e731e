"""The pipeline stage by stage against brute force on what the stage before kept."""

import corpus_pipeline
import public_tokenizers
import pytest
from test_dedup import brute_exact, brute_near
from test_native import base_failed, brute_counts
from test_tokens import check_packing
from tokenizers import Tokenizer

from pagetide.llm import pseudonyms, quality_rules
from pagetide.llm.queries import TEST_KEY
from pagetide.llm.tables import documents, stored

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """Rows that each stage returned."""
    docs, found = documents(spark, FOLDER), {}
    columns = docs.columns
    found["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        if name != "packing":
            assert result.columns == columns
            result = docs = stored(result, "stage")
        found[name] = result.collect()
    return found


def pairs(rows):
    return [(row.doc_id, row.text) for row in rows]


def test_quality(spark, kept):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    verdicts = quality_rules.judged(documents(spark, FOLDER), labels).collect()
    texts = dict(pairs(kept["documents"]))
    want = {
        row.doc_id for row in verdicts
        if not base_failed(brute_counts(texts[row.doc_id])) and row.rejected_by is None
    }
    assert {row.doc_id for row in kept["quality rules"]} == want


def test_exact(kept):
    want = {row[0] for row in brute_exact(pairs(kept["quality rules"])) if row[3]}
    assert sorted(row.doc_id for row in kept["exact dedup"]) == sorted(want)


def test_near(kept):
    rows = pairs(kept["exact dedup"])[:300]
    stay = {row.doc_id for row in kept["near dedup"]}
    assert stay <= {row.doc_id for row in kept["exact dedup"]}
    dropped = {row.doc_id for row in kept["exact dedup"]} - stay
    chosen = [row for row in pairs(kept["exact dedup"]) if row[0] in dropped] + rows
    linked = {row[0]: row[2] for row in brute_near(list(dict(chosen).items()))}
    assert all(linked[doc_id] == doc_id or doc_id in dropped for doc_id in linked)


def test_privacy(spark, kept):
    before = dict(pairs(kept["near dedup"]))
    after = dict(pairs(kept["pseudonyms"]))
    assert set(before) == set(after)
    changed = {doc_id for doc_id in before if before[doc_id] != after[doc_id]}
    frame = spark.createDataFrame(kept["near dedup"], documents(spark, FOLDER).schema)
    found = pseudonyms.pseudonymised(frame, TEST_KEY).filter("size(kinds) > 0").collect()
    assert changed == {row.doc_id for row in found} and changed
    assert all(row.n_chars == len(row.text) for row in kept["pseudonyms"] if row.doc_id in changed)


def test_packing(kept):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {
        row.doc_id: [[*tokenizer.encode(row.text, add_special_tokens=False).ids, 0]]
        for row in kept["pseudonyms"]
    }
    check_packing(kept["packing"], expected)


def test_run_is_the_stages_in_order(spark, kept):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "exact dedup", "near dedup", "pseudonyms", "packing"]
    assert sum(row.length for row in rows) == sum(row.length for row in kept["packing"])
    assert {row.doc_id for row in rows} == {row.doc_id for row in kept["packing"]}

"""The registered queries of this package, with SQL where SQL can say the same."""

from functools import wraps

from pyspark.sql import functions as F

from pagetide.llm import (
    bpe,
    exact_dedup,
    lm_score,
    near_dedup,
    packing,
    prefix_trie,
    pseudonyms,
    quality_rules,
    secret_scan,
    sharding,
    token_alignment,
    token_files,
    transcripts,
)
from pagetide.llm.tables import documents
from pagetide.session import query_run, scratch_folder, utc

QUERIES = {}

# For the test tables only; a key of real documents is a secret.
TEST_KEY = "pagetide"


def query(function):
    @wraps(function)
    def run(spark, folder):
        with query_run(spark, function.__name__):
            return function(utc(spark), folder)

    QUERIES[function.__name__] = run
    return run


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_pack_documents(spark, folder):
    return packing.pack(documents(spark, folder))


@query
def op2_token_files(spark, folder):
    out = scratch_folder(spark, "token-files")
    token_files.write(documents(spark, folder), out)
    return token_files.read_index(spark, out)


@query
def op3_shard_documents(spark, folder):
    rows = documents(spark, folder).select("doc_id")
    return sharding.place(rows, F.col("doc_id")).select("doc_id", "slot", "shard")


@query
def op4_byte_bpe(spark, folder):
    return bpe.digests(documents(spark, folder))


@query
def op5_exact_dedup(spark, folder):
    return exact_dedup.dedup(*exact_dedup.halves(documents(spark, folder)))


@query
def op6_near_dedup(spark, folder):
    return near_dedup.near_duplicates(documents(spark, folder))


@query
def op7_cross_entropy(spark, folder):
    rows = documents(spark, folder)
    return lm_score.cross_entropy_difference(rows, _table(spark, folder, "labels"))


@query
def op8_pseudonyms(spark, folder):
    rows = pseudonyms.pseudonymised(documents(spark, folder), TEST_KEY)
    return rows.select(
        "doc_id",
        F.size("kinds").cast("bigint").alias("n_values"),
        F.array_join("kinds", ",").alias("kinds"),
        "text",
    )


@query
def op9_chat_turns(spark, folder):
    return transcripts.chat_turns(_table(spark, folder, "conversations"))


@query
def op10_quality_rules(spark, folder):
    rows = quality_rules.judged(documents(spark, folder), _table(spark, folder, "labels"))
    return rows.select("doc_id", *quality_rules.BASE, "base_failed", "rejected_by", "kept")


@query
def op11_prefix_trie(spark, folder):
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"))


@query
def op12_secret_scan(spark, folder):
    return secret_scan.digests(documents(spark, folder))


@query
def op13_token_alignment(spark, folder):
    return token_alignment.aligned(documents(spark, folder))


ORACLE = {
    "op3_shard_documents": f"""
        WITH RECURSIVE
        shards AS (
            SELECT n, 'shard-' || lpad(n::VARCHAR, 2, '0') AS shard FROM range({len(sharding.SHARDS)}) t(n)
        ),
        hashed AS (
            SELECT n, ('0x' || left(md5('offset ' || shard), 8))::BIGINT % {sharding.SLOTS} AS first,
                ('0x' || left(md5('skip ' || shard), 8))::BIGINT % {sharding.SLOTS - 1} + 1 AS skip
            FROM shards
        ),
        preferences AS (
            SELECT n, list((first + j * skip) % {sharding.SLOTS} ORDER BY j) AS slots
            FROM hashed, range({sharding.SLOTS}) t(j) GROUP BY n
        ),
        turns AS (
            SELECT 0 AS turn, NULL::BIGINT AS slot,
                list_transform(range({sharding.SLOTS}), lambda x: true) AS free
            UNION ALL
            SELECT turn + 1, slot, free[:slot] || [false] || free[slot + 2:]
            FROM (
                SELECT turn, free, list_filter(slots, lambda x: free[x + 1])[1] AS slot
                FROM turns JOIN preferences ON n = turn % {len(sharding.SHARDS)}
                WHERE turn < {sharding.SLOTS}
            )
        ),
        placed AS (
            SELECT slot, 'shard-' || lpad(((turn - 1) % {len(sharding.SHARDS)})::VARCHAR, 2, '0') AS shard
            FROM turns WHERE turn > 0
        )
        SELECT doc_id, slot::INTEGER AS slot, shard
        FROM (
            SELECT doc_id,
                ('0x' || left(md5(coalesce(doc_id::VARCHAR, 'null key')), 8))::BIGINT % {sharding.SLOTS}
                    AS slot
            FROM documents
        ) JOIN placed USING (slot)
    """,
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        WINDOW same AS (PARTITION BY t)
    """,
}

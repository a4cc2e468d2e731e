"""The corpus pipeline: stages over `documents`, each written and read again before the next.

A stage takes (spark, docs, folder of tables) and returns the documents it keeps, with the columns
of `documents`; the last one returns the packed pieces.
"""

from pagetide.llm import exact_dedup, near_dedup, packing, pseudonyms, quality_rules
from pagetide.llm.queries import TEST_KEY
from pagetide.llm.tables import documents, stored
from pagetide.session import query_run, utc


def quality(spark, docs, sf_dir):
    """Documents that the base rule or a learned rule rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.kept_documents(docs, labels)


def exact(spark, docs, sf_dir):
    """One document per text stays, the one with the largest id."""
    return exact_dedup.unique_documents(docs)


def near(spark, docs, sf_dir):
    """One document per group of near duplicates stays, the one with the smallest id."""
    return near_dedup.unique_documents(docs)


def privacy(spark, docs, sf_dir):
    """Personal numbers, dates and addresses become pseudonyms.

    A session brings its secret in `spark.pagetide.pseudonyms.key`; without one, this is a test.
    """
    key = spark.conf.get("spark.pagetide.pseudonyms.key", TEST_KEY)
    return pseudonyms.pseudonymised_documents(docs, key)


def pack(spark, docs, sf_dir):
    """What is left, as pieces of training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("pseudonyms", privacy),
    ("packing", pack),
]

# Learned rules, near duplicates and packing are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    with query_run(spark, "pipeline"):
        docs = documents(utc(spark), sf_dir)
        for name, stage in STAGES[:-1]:
            docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        return STAGES[-1][1](spark, docs, sf_dir)

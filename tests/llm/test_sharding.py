from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from pagetide.llm import sharding
from pagetide.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_shares_differ_by_one_slot_and_few_slots_move():
    table = sharding.fill_table()
    shares = Counter(table).values()
    assert len(shares) == len(sharding.SHARDS) and max(shares) - min(shares) <= 1
    left = sharding.SHARDS[:-1]
    after = sharding.fill_table(left)
    gone = len(sharding.SHARDS) - 1
    moved = sum(a != b for a, b in zip(table, after) if a != gone)
    assert moved < 0.1 * len(table)


def test_the_table_does_not_depend_on_the_order_of_names():
    names = ("b", "c", "a")
    by_name = [names[n] for n in sharding.fill_table(names, 101)]
    assert by_name == [sorted(names)[n] for n in sharding.fill_table(tuple(sorted(names)), 101)]


def test_bad_tables_are_refused():
    for shards, slots in ((("a",), 100), ((), 101), (("a", "a"), 101), (("a", "b", "c"), 2)):
        with pytest.raises(ValueError):
            sharding.fill_table(shards, slots)


def test_placement_of_odd_rows(docs, clashing):
    frame = docs(["x", "x", None, "y"], [1, 1, None, 2])
    rows = sharding.place(frame, F.col("doc_id")).collect()
    assert len(rows) == 4
    table = sharding.fill_table()
    for row in rows:
        key = "null key" if row.doc_id is None else str(row.doc_id)
        slot = sharding._number(key) % sharding.SLOTS
        assert (row.slot, row.shard) == (slot, sharding.SHARDS[table[slot]])
    assert sharding.place(docs([]), F.col("doc_id")).collect() == []
    clashes = sharding.place(clashing(frame).drop("slot", "shard"), F.col("doc_id"))
    assert clashes.count() == 4


def test_placement_is_a_broadcast_join_without_python(spark):
    plan = QUERIES["op3_shard_documents"](spark, FOLDER)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "BroadcastHashJoin" in text and "Python" not in text and "ExistingRDD" not in text


def test_sql_says_the_same(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS FROM '{FOLDER}/documents.parquet'")
    want = connection.sql(ORACLE["op3_shard_documents"]).select("doc_id, slot, shard").fetchall()
    rows = QUERIES["op3_shard_documents"](spark, FOLDER).select("doc_id", "slot", "shard")
    assert Counter(map(tuple, rows.collect())) == Counter(want)

"""Time the registered queries on one machine and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES (comma separated) a choice of
queries, BENCH_RUNS how often each runs; the best time counts. BENCH_TIMES multiplies the events into
a scratch copy first, with a third of them in one user and one domain, or, with BENCH_DOMAINS, spread
over that many domains.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from pagetide.plans.queries import QUERIES
from pagetide.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
TIMES = int(os.environ.get("BENCH_TIMES", "1"))
DOMAINS = int(os.environ.get("BENCH_DOMAINS", "0"))


def seconds(spark, name, folder):
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def multiplied(spark, scratch):
    """The events `TIMES` over, with new ids and times, beside the tables that give keys."""
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    copy = F.explode(F.sequence(F.lit(0), F.lit(TIMES - 1))).alias("copy")
    rows = events.repartition(int(CPUS)).select("*", copy)
    pick = F.pmod(F.xxhash64("event_id", "copy"), F.lit(3))
    kind = F.when(pick == 0, F.lit("click")).otherwise(F.col("event_type"))
    if DOMAINS:
        kind = F.concat(F.lit("d"), F.pmod(F.xxhash64("copy", "event_id"), F.lit(DOMAINS)))
    shift = F.make_interval(secs=F.pmod(F.xxhash64("event_id", "copy"), F.lit(86_400)))
    rows.withColumns(
        {
            "event_id": F.col("event_id") * TIMES + F.col("copy"),
            "ts": F.when(F.col("copy") == 0, F.col("ts")).otherwise(F.col("ts") + shift),
            "user_id": F.when(pick == 0, F.lit(7)).otherwise(F.col("user_id")).cast("bigint"),
            "event_type": kind,
        }
    ).drop("copy").write.parquet(f"{scratch}/events.parquet")
    for name in ("customer", "pages"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{scratch}/{name}.parquet")
    return scratch


def main():
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)
    scratch = tempfile.mkdtemp(prefix="pagetide-bench-")
    spark = local_session(CPUS, "bench", spark__driver__memory="8g", spark__checkpoint__dir=scratch)
    spark.sparkContext.setLogLevel("ERROR")
    folder = multiplied(spark, f"{scratch}/tables") if TIMES > 1 else FOLDER
    spark.read.parquet(f"{folder}/events.parquet").count()
    times = {}
    for name in names:
        times[name] = round(min(seconds(spark, name, folder) for _ in range(RUNS)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "times": TIMES,
            }
        )
    )


if __name__ == "__main__":
    main()

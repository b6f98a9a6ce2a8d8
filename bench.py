"""Time the registered queries and print one line of JSON.

Besides the queries it times other ways to get the same rows: the six-join form of the extremes
and an arbitrary-survivor dedupe. Shuffle volumes come from Spark's event log.
"""

from __future__ import annotations

import glob
import json
import os
import tempfile
import time
from collections import defaultdict
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stationlake import operators as op
from stationlake.plans import registry
from stationlake.schemas import READING_KEYS
from stationlake.session import scratch_path
from stationlake.sources import stand_in as src

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "daily_extremes",
    "daily_extremes_lineitem",
    "dedupe_readings",
    "dedupe_lineitem",
    "merge_insert_only",
    "silver_batch",
    "gold_from_silver",
]


def six_join_events(spark, sf):
    return op.daily_extremes_joined(src.events_as_silver(spark, sf))


def six_join_lineitem(spark, sf):
    keys = registry.SHIPMENT_KEYS
    return op.daily_extremes_joined(
        registry.shipments(spark, sf), keys, "l_extendedprice", 3, keys, keys
    )


def drop_duplicates_lineitem(spark, sf):
    return src.table(spark, sf, "lineitem").dropDuplicates(["l_orderkey", "l_linenumber"])


def stored_merge(spark, sf):
    """A batch of three days against a stored target: all of it, and the batch's days only."""
    silver = src.events_as_silver(spark, sf).drop("event_id")
    path = scratch_path(spark, "silver")
    silver.where("anomesdia < 20240130").write.partitionBy("anomesdia").parquet(path)
    batch = silver.where("anomesdia >= 20240128")
    target = spark.read.schema(silver.schema).parquet(path)

    def full(*_):
        return op.merge_insert_only(target, batch, READING_KEYS)

    def pruned(*_):
        met = op.days_met(batch, F.col("anomesdia"))
        return op.merge_insert_only(target.where(met), batch, READING_KEYS)

    return {"merge_full_target": full, "merge_pruned_target": pruned}


def measure(spark, name, query):
    best = None
    for run in range(RUNS + 1):
        spark.sparkContext.setJobGroup(f"{name}/{run}", name)
        start = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        taken = time.perf_counter() - start
        if run:  # the first run warms up
            best = taken if best is None else min(best, taken)
    return round(best, 3)


def shuffle_bytes(log_dir):
    """Bytes written to shuffles in the last run of every query."""
    group_of, written = {}, defaultdict(int)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path) or os.path.basename(path).startswith("."):
            continue
        with open(path, encoding="utf-8") as log:
            for line in log:
                if '"SparkListenerJobStart"' in line:
                    event = json.loads(line)
                    group = event.get("Properties", {}).get("spark.jobGroup.id")
                    for stage in event["Stage IDs"]:
                        group_of.setdefault(stage, group)
                elif '"SparkListenerTaskEnd"' in line:
                    event = json.loads(line)
                    metrics = event.get("Task Metrics") or {}
                    moved = metrics.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
                    written[group_of.get(event["Stage ID"])] += moved
    last = f"/{RUNS}"
    return {g[: -len(last)]: n for g, n in written.items() if g and g.endswith(last)}


def main():
    log_dir = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("stationlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{log_dir}")
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE:  # a JVM that has compiled the common parts
        registry.queries()[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    queries = {name: measure(spark, name, q) for name, q in registry.queries().items()}
    others = {
        "six_join_events": six_join_events,
        "six_join_lineitem": six_join_lineitem,
        "drop_duplicates_lineitem": drop_duplicates_lineitem,
        **stored_merge(spark, SF_DIR),
    }
    compare = {name: measure(spark, name, q) for name, q in others.items()}
    spark.stop()
    moved = shuffle_bytes(log_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries[name] for name in HEADLINE), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "compare": compare,
                "shuffle_bytes": {n: moved[n] for n in [*queries, *compare] if n in moved},
                "date": date.today().isoformat(),
            }
        )
    )


if __name__ == "__main__":
    main()

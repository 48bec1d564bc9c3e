"""Skew experiment on the driver's lineitem table: a third of the rows moved to one hot key.

    python tools/skew_check.py [sf_dir] [scratch_dir] [min_item_support]

Runs co-occurrence counting and dense ids with Spark's event log written to ``scratch_dir``,
then reports, per stage, the number of tasks and the largest and median records read by a task.
Co-occurrence is also checked against a plain self-join (which forms every pair of the hot
owner) for exactness.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def stage_task_records(log_dir: str) -> dict[int, list[int]]:
    """Records read (input + shuffle) per task, grouped by stage, from the JSON event log."""
    per_stage: dict[int, list[int]] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("."):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                n = (m.get("Input Metrics", {}).get("Records Read", 0)
                     + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
                per_stage.setdefault(ev["Stage ID"], []).append(n)
    return per_stage


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-")
    min_item = int(sys.argv[3]) if len(sys.argv) > 3 else 35
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir, exist_ok=True)
    spark = (SparkSession.builder.master("local[8]").appName("skew-check")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.eventLog.rolling.enabled", "false")
             .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from citeweave.operators.counts import co_occurrence_counts
    from citeweave.operators.keys import dense_ids

    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_orderkey"))
    inc = lines.select(hot.alias("owner"), F.col("l_partkey").alias("item"))
    total = inc.count()
    hot_rows = inc.where("owner = -1").count()
    print(f"rows={total} hot_owner_rows={hot_rows} ({hot_rows / total:.0%})")

    t0 = time.perf_counter()
    ours = co_occurrence_counts(inc, "owner", "item", None, min_item, 2, block_size=2048)
    got = {(r.item_a, r.item_b): r.n for r in ours.collect()}
    t_ours = time.perf_counter() - t0
    hot_items = inc.where("owner = -1").select("item").distinct().join(
        inc.distinct().groupBy("item").count().where(f"count >= {min_item}"), "item").count()
    print(f"hot owner holds {hot_items} supported items ({hot_items * (hot_items - 1) // 2} "
          f"pairs if formed)")
    print(f"co-occurrence: {len(got)} pairs in {t_ours:.1f}s")

    t0 = time.perf_counter()
    pairs = inc.distinct()
    sup = pairs.groupBy("item").count().where(f"count >= {min_item}").select("item")
    p = pairs.join(sup, "item", "left_semi")
    naive = (p.alias("a").join(p.alias("b"), "owner").where(F.col("a.item") < F.col("b.item"))
             .groupBy(F.col("a.item").alias("item_a"), F.col("b.item").alias("item_b"))
             .count().where("count >= 2"))
    want = {(r.item_a, r.item_b): r["count"] for r in naive.collect()}
    t_naive = time.perf_counter() - t0
    print(f"plain self-join: {len(want)} pairs in {t_naive:.1f}s; equal={got == want}")

    hot_key = F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).otherwise(
        F.md5(F.col("l_orderkey").cast("string")))
    keyed = lines.select(hot_key.alias("k"), "l_orderkey", "l_linenumber", "l_partkey")
    ids = dense_ids(keyed, ["k", "l_orderkey", "l_linenumber", "l_partkey"], "i",
                    num_partitions=16)
    n_ids = ids.agg(F.count("*"), F.min("i"), F.max("i"), F.count_distinct("i")).first()
    print(f"dense ids: rows={n_ids[0]} min={n_ids[1]} max={n_ids[2]} distinct={n_ids[3]}")

    spark.stop()
    print("stage | tasks | max records/task | median records/task")
    for stage, recs in sorted(stage_task_records(log_dir).items()):
        if len(recs) > 1 and max(recs) > 0:
            print(f"{stage} | {len(recs)} | {max(recs)} | {int(statistics.median(recs))}")


if __name__ == "__main__":
    main()

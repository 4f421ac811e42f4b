"""Measure how work spreads over tasks when one group holds a third of the rows.

Reads the driver tables, derives skewed inputs (one pull, one key or one node
holding a third of all rows), runs the skew-sensitive operators with
broadcasts switched off (so the shuffle paths are the ones measured) and many
map tasks (as at scale), and prints, per stage, the largest and the median
number of records a task read, from Spark's event log written to a fresh
scratch folder.

    python tools/skewcheck.py /root/testdata/sf0.1
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _events(logdir: str):
    import zstandard
    for f in sorted(glob.glob(f"{logdir}/*/events_*")):
        if f.endswith(".zstd"):
            with zstandard.ZstdDecompressor().stream_reader(open(f, "rb"), read_across_frames=True) as r:
                text = r.read().decode()
        else:
            text = open(f).read()
        for line in text.splitlines():
            if line.strip():
                yield json.loads(line)


def main(sf_dir: str) -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    logdir = tempfile.mkdtemp(prefix="skewcheck-")
    spark = (SparkSession.builder.master("local[8]").appName("skewcheck")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from lmplake.operators import merge as M
    from lmplake.operators import pulls as P
    from lmplake.operators import quality as Q
    from lmplake.operators.positions import positions_within
    from lmplake.plans import adapters as A
    from lmplake.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    p = A.events_prices(spark, sf_dir).repartition(16)
    hot = F.col("node_id") % 3 == 0
    hot_pull = p.withColumn("pull_id", F.when(hot, F.lit("hot")).otherwise(F.col("pull_id")))
    hot_key = (p.withColumn("utcbegin", F.when(hot, F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
                            .otherwise(F.col("utcbegin")))
                .withColumn("node_id", F.when(hot, F.lit(1)).otherwise(F.col("node_id"))))
    hot_node = p.withColumn("node_id", F.when(hot, F.lit(1)).otherwise(F.col("node_id")))
    lake = ["utcbegin", "pricedate", "hour", "node_id", "dalmp", "damcc", "damcl", "ingest_seq"]
    batch = A.arrival_batch()
    jobs = {
        "latest_wins/hot key": M.latest_wins(hot_key.select(*lake)),
        "merge_rows/hot key": M.merge_rows(hot_key.where(batch == 0).select(*lake),
                                           hot_key.where(batch == 1).select(*lake)),
        "first_day_filter/hot pull": P.first_day_filter(hot_pull, ["pull_id"]),
        "positions_within/hot pull": positions_within(hot_pull, ["pull_id"], "ingest_seq"),
        "gap_report/hot pull": Q.gap_report(hot_pull, ["pull_id"], 60),
        "day_completeness/hot pull": Q.day_completeness(hot_pull, ["pull_id"], 60),
        "carried_over_nodes/hot node": M.carried_over_nodes(hot_node.where(batch == 0), hot_node.where(batch == 1)),
        "next_cursor/hot pull": P.next_cursor(hot_pull.withColumn("feed", F.lit("da_hrl_lmps")), ["feed", "pull_id"]),
        # the landing write's partitioning (sinks.lake.land_intake), before the file writer
        "land_intake/hot key": hot_key.select(*lake).repartitionByRange("pricedate", "node_id", "ingest_seq"),
    }
    for name, df in jobs.items():
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_job, tasks = {}, {}
    for e in _events(logdir):
        if e["Event"] == "SparkListenerJobStart":
            for s in e["Stage IDs"]:
                stage_job[s] = e.get("Properties", {}).get("spark.job.description")
        elif e["Event"] == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            n += (m.get("Input Metrics") or {}).get("Records Read", 0)
            tasks.setdefault(e["Stage ID"], []).append(n)
    print(f"{'operator/skew':32s} {'stage':>5s} {'tasks':>5s} {'records':>8s} {'max':>7s} {'median':>7s}")
    for s, r in sorted(tasks.items()):
        d = stage_job.get(s)
        if not d or sum(r) == 0 or len(r) == 1:
            continue
        r = sorted(r)
        print(f"{d:32s} {s:5d} {len(r):5d} {sum(r):8d} {r[-1]:7d} {r[len(r) // 2]:7d}")
    print(f"event log: {logdir}")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")

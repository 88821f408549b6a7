"""Task balance with one shop holding a third of all payments.

    python tools/skew_probe.py [/root/testdata/sf0.1] [event-log folder]

A third of the stand-in payments (chosen by a hash of the line) are moved to
one selected shop. The headline jobs then run on each of their plan paths
(broadcast selection, aggregate-first selection, sort-merge per-payment
join) through the ``noop`` sink, with Spark's event log on. From the log,
for every stage that reads at least a tenth of the payments, the largest
task's share of that stage's records is printed. A share near 1/tasks means
the hot shop's rows were spread; a share near 1/3 would mean one task got
the hot shop's rows.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from shopscope.functions.clean import pay_day  # noqa: E402
from shopscope.operators import select_shops, shop_with_pay_day  # noqa: E402
from shopscope.plans import jobs as J  # noqa: E402
from shopscope.session import build_session  # noqa: E402
from shopscope.sources.standin import STANDIN_CITIES, STANDIN_KEYWORD, standin_shops, standin_table  # noqa: E402


def skewed_pays(spark, sf_dir: str, hot: str):
    li = standin_table(spark, sf_dir, "lineitem")
    ts = F.col("l_shipdate").cast("string")
    moved = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
    return li.select(
        F.when(moved, F.lit(hot)).otherwise(F.col("l_suppkey").cast("string")).alias("shop_id"),
        ts.alias("time_stamp"),
        pay_day(ts).alias("day"),
    )


def task_records(log_dir: str) -> dict[str, dict[int, list[int]]]:
    """job description -> stage id -> records read by each task."""
    stage_job: dict[int, str] = {}
    out: dict[str, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    # Spark 4 writes one folder per application (eventlog_v2_*/events_*);
    # a plain log file is one file per application.
    paths = glob.glob(os.path.join(log_dir, "eventlog_v2_*", "events_*"))
    paths += glob.glob(os.path.join(log_dir, "local-*")) + glob.glob(os.path.join(log_dir, "app-*"))
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    n = (m.get("Input Metrics") or {}).get("Records Read", 0) + (
                        m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    desc = stage_job.get(ev["Stage ID"])
                    if desc:
                        out[desc][ev["Stage ID"]].append(n)
    return out


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    log_dir = args[1] if len(args) > 1 else tempfile.mkdtemp(prefix="skew-probe-")
    spark = build_session("local[8]", app_name="shopscope-skew-probe", shuffle_partitions=16, conf={
        "spark.sql.session.timeZone": "UTC",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
        # AQE's thresholds are absolute bytes, sized for a cluster (128 MB
        # partitions, 256 MB skew threshold). A whole sf0.1 input is ~10 MB,
        # so the thresholds are scaled down with the data; otherwise AQE
        # would coalesce everything into a few tasks and never see skew.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    })
    spark.sparkContext.setLogLevel("ERROR")
    shops = standin_shops(spark, sf_dir)
    hot = select_shops(shops, STANDIN_CITIES, STANDIN_KEYWORD).agg(F.min("shop_id")).first()[0]
    pays = skewed_pays(spark, sf_dir, hot)
    n_pays = pays.count()
    runs = {
        "turnover top 10": lambda: J.turnover_top(shops, pays),
        "popularity, broadcast selection": lambda: J.popularity_scores(
            shops, pays, STANDIN_CITIES, STANDIN_KEYWORD),
        "popularity, aggregate-first": lambda: J.popularity_scores(
            shops, pays, STANDIN_CITIES, STANDIN_KEYWORD, broadcast_max_rows=0),
        "revenue, aggregate-first": lambda: J.revenue_report(
            shops, pays, STANDIN_CITIES, STANDIN_KEYWORD, broadcast_max_rows=0),
        "per-payment join, sort-merge": lambda: shop_with_pay_day(shops, pays, broadcast_max_rows=None),
    }
    for name, build in runs.items():
        if name.endswith("sort-merge"):
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.sparkContext.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    print(f"payments: {n_pays}, hot shop {hot} holds about a third")
    print("(a 3-task stage whose largest task reads every payment is the parquet scan:")
    print("each test file is a single row group, so one split holds all rows)\n")
    print("| job | stage | tasks | records | largest task | share |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, stages in task_records(log_dir).items():
        for sid, recs in sorted(stages.items()):
            total = sum(recs)
            if total < n_pays / 10:
                continue
            print(f"| {name} | {sid} | {len(recs)} | {total} | {max(recs)} | {max(recs) / total:.3f} |")


if __name__ == "__main__":
    main()

"""Skew probe: one merchant owns ~30 % of sf0.1 payments; for each operator,
report the largest share of a stage's shuffle input read by a single task,
from Spark's event log in a scratch folder (no UI).

    python tests/skew_probe.py [sf_dir] [event-log dir]
"""
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    evd = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="evlog-", dir="/tmp")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", evd)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "32")
             .config("spark.sql.adaptive.enabled", "false")      # measure the plan, not AQE's rescue
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerlake.operators import cleanse as cl
    from ledgerlake.operators import features as fe
    from ledgerlake.operators import gold as go
    from ledgerlake.operators import reconcile as rc
    from ledgerlake.sources import fixtures as fx
    hot = F.col("transaction_id").rlike("_[12]$")
    p = fx.li_payments(spark, sf).withColumn(
        "merchant_id", F.when(hot, F.lit("hot")).otherwise(F.col("merchant_id")))
    st = fx.li_settlements(spark, sf).withColumn(
        "merchant_id", F.when(F.col("batch_id").rlike("_[12]$"), F.lit("hot")).otherwise(F.col("merchant_id")))
    # children whose parent key is hot for ~30 % of rows (refunds of one payment)
    kids = p.select(F.when(hot, F.lit("hot")).otherwise(F.col("transaction_id")).alias("ref"),
                    "amount_decimal", "event_ts")
    parents = p.select(F.col("transaction_id").alias("tx")).unionByName(
        spark.createDataFrame([("hot",)], "tx string")).distinct()
    runs = {
        "j7 parent lookup, plain join": lambda: kids.join(parents, kids["ref"] == parents["tx"], "left"),
        "j7 parent lookup, salted": lambda: rc.parent_lookup(kids, parents, "ref", "tx", "left"),
        "n2 rolling, plain window": lambda: fe.rolling_features(p, "merchant_id", method="window"),
        "n2 rolling, bucketed": lambda: fe.rolling_features(p, "merchant_id", method="bucketed"),
        "n4 features, per-event window + latest": lambda: fe.merchant_features(p, method="window"),
        "n4 features, latest": lambda: fe.merchant_features(p, method="latest"),
        "u1 dedup on the hot key": lambda: cl.dedup_latest(p, ["merchant_id"], ["event_ts"]),
        "a1 daily summary": lambda: go.daily_merchant_summary(p),
        "a5 ledger": lambda: rc.reconcile(p, st),
    }
    for name, fn in runs.items():
        spark.sparkContext.setJobDescription(name)
        fn().write.format("noop").mode("overwrite").save()
    spark.stop()
    stage_desc, tasks = {}, {}
    files = [x for x in glob.glob(os.path.join(evd, "**", "*"), recursive=True)
             if os.path.isfile(x) and "appstatus" not in os.path.basename(x)]
    for f in files:
        for line in open(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                d = (e.get("Properties") or {}).get("spark.job.description")
                for s in e["Stage IDs"]:
                    stage_desc[s] = d
            elif e["Event"] == "SparkListenerTaskEnd":
                r = ((e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {})
                tasks.setdefault(e["Stage ID"], []).append(r.get("Total Records Read", 0))
    for name in runs:
        worst = max((max(r) / sum(r) for s, r in tasks.items()
                     if stage_desc.get(s) == name and sum(r) > 0), default=0.0)
        print(f"{name}: {worst:.1%}")


if __name__ == "__main__":
    main()

"""Time per fact row and largest task of the headline steps on the fact replicated 1, 4 and 16 times.

    python tools/scale_report.py [sf_dir] [copies ...]

Copies get keys of their own (unique ids, stores kept), so the key space grows with
the fact.  R8 is measured in the registered form (repeated keys joined back) and in
the older one (pre-aggregation, then a window by key), on mostly unique keys, with a
third of all rows NULL, and with a third on one key.  Task figures come from Spark's
event log, written to a scratch folder.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlint.operators import keycount  # noqa: E402
from ledgerlint.plans import dq_queries, mf_queries  # noqa: E402
from ledgerlint.plans import missing_files as mf  # noqa: E402
from ledgerlint.plans import rules as R  # noqa: E402
from ledgerlint.session import DEFAULTS, ensure_checkpoint_dir  # noqa: E402
from ledgerlint.sources.fixtures import FixtureSet, dim_pos  # noqa: E402


def window_form(fact, key, group_cols, sum_cols):
    """The older form of ``fact_key_count``."""
    pre = fact.groupBy(key, *group_cols).agg(F.count(F.lit(1)).alias(keycount.ROWS), *[F.sum(c).alias(c) for c in sum_cols])
    return pre.withColumn(keycount.CNT, F.sum(keycount.ROWS).over(Window.partitionBy(key)))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = [int(x) for x in sys.argv[2:]] or [1, 4, 16]
    events = tempfile.mkdtemp(prefix="run-events-", dir="/tmp")
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{events}")
    builder = builder.config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
    builder = builder.config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "32")
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    root = f"{ensure_checkpoint_dir(spark)}/{spark.sparkContext.applicationId}-scale"
    f = FixtureSet.of(spark, sf)
    pos, product = dim_pos(f.pos()), f.product()
    p = dq_queries.RunParams("X", dq_queries.RUN_TS)
    rows = {}

    def timed(name, make):
        spark.sparkContext.setJobDescription(name)
        make().write.format("noop").mode("overwrite").save()
        t = time.time()
        make().write.format("noop").mode("overwrite").save()
        rows[name] = time.time() - t

    for n in copies:
        path = f"{root}/fact-{n}"
        more = spark.range(n).select(F.col("id").alias("copy"))
        big = f.fact_sellout().join(F.broadcast(more)).withColumn("unique_id", F.concat("unique_id", F.lit("/"), "copy")).drop("copy")
        big.repartition(32).write.parquet(path)
        fact = spark.read.parquet(path)
        third = F.xxhash64("unique_id") % 3 == 0
        facts = {"unique": fact, "null third": fact.withColumn("unique_id", F.when(~third, F.col("unique_id"))),
                 "hot third": fact.withColumn("unique_id", F.when(third, "-1").otherwise(F.col("unique_id")))}
        for kind, one in facts.items():
            timed(f"{n} R8 join, {kind}", lambda: R.fact_uniqueness_sellout(spark, p, one, pos))
            kept, R.fact_key_count = R.fact_key_count, window_form
            timed(f"{n} R8 window, {kind}", lambda: R.fact_uniqueness_sellout(spark, p, one, pos))
            R.fact_key_count = kept
        timed(f"{n} R5", lambda: R.product_uniqueness_sellout(spark, p, fact, product, pos))
        inp = mf_queries.replace(mf_queries.inputs(spark, sf), fact=fact)
        timed(f"{n} M1", lambda: mf.deliveries(inp, mf_queries.SP, mf_queries.AS_OF))
        timed(f"{n} missing files SP", lambda: mf.missing_files(inp, mf_queries.AS_OF, mf_queries.SP).result)
    total = f.fact_sellout().count()
    spark.stop()
    described, tasks, read = {}, defaultdict(int), defaultdict(int)
    for line in (x for path in glob.glob(f"{events}/*") for x in open(path, errors="replace")):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            for s in e["Stage IDs"]:
                described[s] = (e.get("Properties") or {}).get("spark.job.description")
        elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            name, m = described.get(e["Stage ID"]), e["Task Metrics"]
            tasks[name] = max(tasks[name], m["Executor Run Time"])
            r = m["Shuffle Read Metrics"]
            read[name] = max(read[name], r["Remote Bytes Read"] + r["Local Bytes Read"])
    print("| step | fact rows | s | µs a row | largest task s | most read by a task, MB |\n|---|---|---|---|---|---|")
    for name, s in rows.items():
        n, _, step = name.partition(" ")
        print(f"| {step} | {int(n) * total:,} | {s:.2f} | {s / (int(n) * total) * 1e6:.2f} | {tasks[name] / 1000:.2f} | {read[name] / 1e6:.2f} |")


if __name__ == "__main__":
    main()

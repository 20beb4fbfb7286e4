"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (timed runs per query, default 3; the median is
reported).  Fixtures are derived from the driver tables and materialised
once before timing ("prepare_sec"); every timed run executes the whole query
into Spark's no-op sink, so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlint.plans import dq_queries, mf_queries  # noqa: E402
from ledgerlint.plans import missing_files as mf  # noqa: E402
from ledgerlint.session import local_session  # noqa: E402
from ledgerlint.sources.fixtures import FixtureSet  # noqa: E402

def m6_plain(spark, d):
    """M6 as a day x store range join, for comparison with the month-collapsed form."""
    steps = mf_queries.run(spark, d)
    return mf.expected_daily_plain(steps.starts, steps.calendar, mf_queries.SP)


HEADLINE = {
    "r8_fact_uniqueness": dq_queries.q_uniq_1091,
    "r8_fact_uniqueness_hot_key": dq_queries.q_uniq_1091_hot_key,
    "r6_pos_uniqueness": dq_queries.q_uniq_1083,
    "r5_product_uniqueness": dq_queries.q_uniq_1032,
    "r9_distributor_uniqueness": dq_queries.q_uniq_1238,
    "r4_dimension_uniqueness": dq_queries.q_uniq_generic_pos,
    "r3_reference_integrity": dq_queries.q_ref_key_product,
    "r2_stock_integrity": dq_queries.q_ref_stock,
    "r1_attribute_condition": dq_queries.q_attr_dim,
    "m6_expected_daily": mf_queries.q_expected_daily,
    "m6_expected_daily_plain_range_join": m6_plain,
    "missing_files_sp": mf_queries.q_final_sp,
    "missing_files_mfs": mf_queries.q_final_mfs,
    "m22_upsert_two_runs": mf_queries.q_merge,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="ledgerlint-bench")
    t0 = time.time()
    fx = FixtureSet.of(spark, sf_dir)
    for name in ("pos", "fact_sellout", "fact_sellthrough", "datasource", "product", "product_sap", "signature",
                 "calendar", "store_start", "sku_traffic", "amz", "distributor", "stock", "ref_brand"):
        getattr(fx, name)()
    fx.distributor(duplicate=True)
    prepare = time.time() - t0

    times: dict[str, float] = {}
    for name, q in HEADLINE.items():
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            mf_queries.reset()  # cold run: no cached pipeline steps from the previous run
            spark.catalog.clearCache()
            t = time.time()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.time() - t)
        times[name] = round(statistics.median(samples), 3)
    mf_queries.reset()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "prepare_sec": round(prepare, 3),
        "runs_per_query": runs,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

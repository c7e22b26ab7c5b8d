"""Benchmark: prints one JSON line.

Headline metric (comparable to the published baseline): the weekly rollup,
join + aggregation over the materialised fact and station tables, keyed as
the baseline's timed query (week by date_trunc, state, city, product), median
of 5 runs after three warm-ups, every output column forced with the noop sink.
The stored rollup (calendar join, month from week start, edge flag) is timed
separately. The per-query section also times whole chains from
the raw TESTDATA tables (clean, dedup, SCD2 build, incremental apply, fact,
rollup), each forced to completion with the ``noop`` sink, once after one warm-up.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pricegrid.operators import rollup, scd2  # noqa: E402
from pricegrid.plans.model import SurveyModel  # noqa: E402
from pricegrid.plans.registry import QUERIES  # noqa: E402
from pricegrid.session import build_session, scratch_path  # noqa: E402
from pricegrid.sources import testdata as T  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPS = int(os.environ.get("BENCH_REPS", "5"))

CHAINS = ["clean_accepted", "dedup_kept", "scd2_build", "scd2_apply_range", "fact",
          "weekly_rollup", "weekly_rollup_raw_keys", "parity_by_region", "bench_broad"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, reps=REPS, warm=3):
    for _ in range(warm):
        fn()
    ts = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t0)
    return statistics.median(ts)


def main():
    spark = build_session(f"local[{CPUS}]", "pricegrid-bench", shuffle_partitions=CPUS,
                          extra={"spark.driver.memory": "16g"})
    m = SurveyModel(spark, SF_DIR)
    out = scratch_path(spark, "bench")
    # materialise the tables the rollup reads, as the survey build does
    staged = {}
    for name in ["fact", "dim_station", "dim_city", "dim_date"]:
        path = f"{out}/{name}"
        getattr(m, name).write.mode("overwrite").parquet(path)
        staged[name] = path
    read = {k: spark.read.parquet(v) for k, v in staged.items()}

    def rollup_query():
        run(rollup.weekly(read["fact"], read["dim_station"], read["dim_city"], read["dim_date"]))

    def raw_keys_query():
        run(rollup.weekly_raw_keys(read["fact"], read["dim_station"]))

    results = {
        # the baseline's timed query: week by date_trunc, state, city, product
        "weekly_rollup_join_agg": round(timed(raw_keys_query), 3),
        # the stored rollup: calendar join, month from week start, edge flag
        "weekly_rollup_calendar_edges": round(timed(rollup_query), 3),
    }
    # versioned dimension on staged snapshots: one-shot build, every later date
    # in one incremental pass, and one date (the per-date upsert unit)
    snaps_path = f"{out}/snapshots"
    m.snapshots.write.parquet(snaps_path)
    snaps = spark.read.parquet(snaps_path)
    cut = F.lit(T.CUT_DATE).cast("date")
    before = snaps.where(F.col("collection_date") < cut)
    later = snaps.where(F.col("collection_date") >= cut)
    scd2.build(before, m.attrs).write.parquet(f"{out}/base_dim")
    base = spark.read.parquet(f"{out}/base_dim")
    hw = before.agg(F.max("collection_date")).first()[0]
    first = later.agg(F.min("collection_date")).first()[0]
    n_dates = later.select("collection_date").distinct().count()
    results["scd2_one_shot_build"] = round(timed(lambda: run(scd2.build(snaps, m.attrs))), 3)
    results["scd2_apply_range_all_later_dates"] = round(timed(lambda: run(
        scd2.apply_range(base, later, m.attrs, high_water=F.lit(hw)))), 3)
    results["scd2_apply_batch_one_date"] = round(timed(lambda: run(scd2.apply_batch(
        base, later.where(F.col("collection_date") == F.lit(first)), m.attrs, F.lit(hw)))), 3)

    for q in CHAINS:
        results[f"chain_{q}"] = round(timed(lambda q=q: run(QUERIES[q](spark, SF_DIR)),
                                            reps=1, warm=1), 3)
    fact_rows = read["fact"].count()
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "weekly_rollup_join_agg",
        "value": results["weekly_rollup_join_agg"],
        "unit": "sec",
        "queries": results,
        "sf": float(sf.group(1)) if sf else None,
        "fact_rows": fact_rows,
        "scd2_dates_applied": n_dates,
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

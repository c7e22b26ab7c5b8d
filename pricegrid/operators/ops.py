"""Benchmark runs: recording, summaries and the layout experiment analysis.

Runs are rows (run_id, phase, query, attempt, seconds, num_files, size_bytes,
clustering_cols). The first attempt of each query is a cold start and is
dropped; the summary states median, mean, min and max explicitly (a mean is
never labelled as a median).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUNS_SCHEMA = ("run_id string, phase string, query string, attempt int, seconds double, "
               "num_files bigint, size_bytes bigint, clustering_cols string")
BASELINE, CONTROL = "baseline", "control"


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def record_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def summarise_runs(runs: DataFrame) -> DataFrame:
    """Per (run, phase, query): attempts kept, median, mean, min, max seconds."""
    warm = runs.where(F.col("attempt") > 1)
    return warm.groupBy("run_id", "phase", "query").agg(
        F.count(F.lit(1)).alias("executions"),
        F.percentile("seconds", 0.5).alias("median_seconds"),
        F.avg("seconds").alias("mean_seconds"),
        F.min("seconds").alias("min_seconds"),
        F.max("seconds").alias("max_seconds"),
        F.max("num_files").alias("num_files"),
        F.max("size_bytes").alias("size_bytes"),
    )


def layout_gain(summary: DataFrame, run_id: str, baseline: str = BASELINE,
                control: str = CONTROL) -> DataFrame:
    """Gain of each later phase, split into warm-up (baseline -> control, no
    change in between) and layout (control -> phase), as % of the baseline."""
    s = summary.where(F.col("run_id") == run_id)
    b = s.where(F.col("phase") == baseline).select("query", F.col("median_seconds").alias("base"))
    c = s.where(F.col("phase") == control).select("query", F.col("median_seconds").alias("ctrl"))
    r = s.where(~F.col("phase").isin(baseline, control))
    j = r.join(b, "query").join(c, "query")
    return j.select(
        "query", "phase",
        F.round("base", 2).alias("base_seconds"),
        F.round("ctrl", 2).alias("control_seconds"),
        F.round("median_seconds", 2).alias("phase_seconds"),
        F.round(F.try_divide(100 * (F.col("base") - F.col("ctrl")), F.col("base")), 1)
        .alias("warmup_gain_pct"),
        F.round(F.try_divide(100 * (F.col("ctrl") - F.col("median_seconds")), F.col("base")), 1)
        .alias("layout_gain_pct"),
    ).orderBy("query", "phase")


def break_even(rebuild_seconds: DataFrame, batch_seconds: DataFrame) -> DataFrame:
    """Dates of accumulated change after which a rebuild is cheaper than
    applying dates one by one: rebuild seconds / mean seconds per date batch.

    ``rebuild_seconds``: one row (seconds); ``batch_seconds``: one row per
    applied date batch (seconds)."""
    per = batch_seconds.agg(F.avg("seconds").alias("mean_batch_seconds"),
                            F.percentile("seconds", 0.5).alias("median_batch_seconds"),
                            F.min("seconds").alias("min_batch_seconds"),
                            F.count(F.lit(1)).alias("batches"))
    rb = rebuild_seconds.agg(F.max("seconds")).scalar()
    return per.select("*", rb.alias("rebuild_seconds"),
                      F.try_divide(rb, F.col("mean_batch_seconds")).alias("break_even_dates"))

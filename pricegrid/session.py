"""Session helpers.

Only two things live here: a builder with the settings every job in this
package relies on, and the shared folder used to cut lineage. Nothing else
about execution is decided by hand; Catalyst and AQE plan the rest.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package, whatever the cluster size.
#   * AQE re-plans joins at run time (broadcast only when the measured side is
#     under spark.sql.autoBroadcastJoinThreshold), coalesces small shuffle
#     partitions and splits skewed join partitions.
#   * ANSI stays on (Spark 4 default); ratios use try_divide.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "pricegrid",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables.

    Read from ``spark.checkpoint.dir`` as the cluster names it. Without that
    setting a ``local`` master (one machine, as in tests) gets a private
    folder; on any other master tasks of different machines could not see
    each other's files, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             "executors share")
        root = tempfile.mkdtemp(prefix="pricegrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/pricegrid/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, name: str = "cut"):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and return a DataFrame reading it.

    Used where a result is read several times (the observation table, the
    station dimension, the fact, a small aggregate): the plan below it runs
    once, downstream scans are columnar and prune columns, and a lost
    executor re-reads files instead of recomputing the lineage. One write
    pass, unlike an eager RDD checkpoint, which runs its last stage twice.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


TASK_ROWS = 1 << 19  # about so many rows of a sort or a collection in one task


def tasks_of(spark: SparkSession, rows: int) -> int:
    """Tasks for ``rows``, at most as many as the session shuffles to; 0 where the planner
    should decide, because its own number leaves few rows to a task."""
    most, least = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    return 0 if rows <= least * TASK_ROWS else max(1, min(most, -(-rows // TASK_ROWS)))


def dealt_to(spark: SparkSession, rows: int) -> int:
    """``tasks_of``, but no task gets more than about twice ``TASK_ROWS`` rows, however few
    partitions the session shuffles to: with more a sort spills."""
    n = tasks_of(spark, rows)
    return max(n, -(-rows // (2 * TASK_ROWS))) if n else 0


def spread(df, rows: int, *cols):
    """``df`` dealt by ``cols`` to tasks of about ``TASK_ROWS`` of its ``rows``, for the sort
    by these columns that follows. AQE joins partitions by their compressed bytes; rows that
    compress well would come by the million to one task, whose sort then spills. Fewer rows
    are left to AQE."""
    n = dealt_to(df.sparkSession, rows)
    return df.repartition(n, *cols) if n else df

"""Incremental bronze ingest with Structured Streaming, driven by a ledger of files.

What is ingested is what was checked. An ingest lists the landing folder (``*.csv``
only), drops the files that earlier ingests claimed, checks the headers of the rest
and writes them as *claims*: (path, length, modified, checked_at), one file of the
claim table for each micro-batch. The stream reads the claim table, not the folder, so
a file that arrives after the check, or a temporary file, waits for the next ingest.
Each micro-batch reads exactly the files of its claim (refusing one that has changed
since the check), writes their rows to a folder of its own, ``batch=<id>``, and then
records the files as committed.

Failure model: claims that no batch has taken are taken by the next run; a batch that
stops before its commit is replayed by the stream from the same claim into the same
folder (overwritten), so it ends with the same rows. Readers (``committed_rows``) see
committed batches only.

A full refresh opens a new *generation* (table, checkpoint and ledger together) beside
the current one and switches readers by appending to a pointer table once it is
complete; nothing is deleted, and a crash on the way leaves readers where they were.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid import constants as K
from pricegrid.session import cut_lineage
from pricegrid.sources import bronze, tables

MAX_FILES = 1000  # per micro-batch: bounds the rows of one commit, not the drain
CLAIM = "path string, length bigint, modified timestamp, checked_at timestamp"


def claims_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-claims"


def commits_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-files"


def claim(spark: SparkSession, landing: str, checkpoint: str, header: Sequence[str] = K.SOURCE_HEADER,
          max_files: int = MAX_FILES) -> int:
    """Check the files that no ingest has claimed yet and claim them, ``max_files`` to a
    micro-batch, oldest first. Returns how many. A wrong header raises and claims nothing."""
    known = tables.read_or_none(spark, claims_path(checkpoint))
    files = cut_lineage(bronze.new_files(spark, landing, known), "files")
    bronze.require_layout(files, header)
    count = files.count()
    if count:  # a writing task for each million files
        (files.repartitionByRange(-(-count // (1 << 20)), "modified", "path").sortWithinPartitions("modified", "path")
         .select("path", "length", "modified", F.current_timestamp().alias("checked_at"))
         .write.mode("append").option("maxRecordsPerFile", max_files).parquet(claims_path(checkpoint)))
    return count


def _rows(batch: DataFrame, header: Sequence[str], names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The claimed files of a micro-batch and their rows."""
    spark = batch.sparkSession
    claimed = batch.collect()  # at most max_files rows
    files, paths = spark.createDataFrame(claimed, CLAIM), [r["path"] for r in claimed]
    now = (spark.read.format("binaryFile").load(paths)
           .select("path", F.col("length").alias("_length"), F.col("modificationTime").alias("_modified")))
    changed = (files.join(now, "path", "left")
               .where(~(F.col("length").eqNullSafe(F.col("_length")) & F.col("modified").eqNullSafe(F.col("_modified")))))
    if bad := [r["path"] for r in changed.take(20)]:
        raise ValueError(f"files changed after their header was checked: {bad}")
    checked = F.lit(max(r["checked_at"] for r in claimed))
    return files, bronze.rows_of(spark.read, paths, header, names).withColumn("ingested_at", checked)


def read_stream(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stream of claims; each micro-batch is one file of the claim table. A claim that
    a lost run left behind is taken however old it is."""
    return (spark.readStream.schema(CLAIM).option("maxFilesPerTrigger", 1).option("maxFileAge", "36500d")
            .parquet(claims_path(checkpoint)))


def load(batch: DataFrame, batch_id: int, table_path: str, checkpoint: str,
         header: Sequence[str] = K.SOURCE_HEADER, names: Sequence[str] = K.BRONZE_COLUMNS) -> None:
    """Write the rows of one claim and commit its files; done again, it gives the same."""
    files, rows = _rows(batch, header, names)
    rows.write.mode("overwrite").parquet(f"{table_path.rstrip('/')}/batch={batch_id}")
    files.write.mode("overwrite").parquet(f"{commits_path(checkpoint)}/batch={batch_id}")


def ingest(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
           header: Sequence[str] = K.SOURCE_HEADER, max_files: int = MAX_FILES) -> int:
    """Claim the new files of the landing folder, drain the claims into a Parquet table and
    stop. Returns the number of micro-batches the checkpoint has committed so far."""
    claim(spark, landing, checkpoint, header, max_files)
    if tables.read_or_none(spark, claims_path(checkpoint)) is None:
        return 0  # nothing has ever been claimed
    q = (read_stream(spark, checkpoint).writeStream
         .foreachBatch(lambda batch, i: load(batch, i, table_path, checkpoint, header))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return tables.read_or_none(spark, commits_path(checkpoint)).select("batch").distinct().count()


def committed_rows(spark: SparkSession, table_path: str, checkpoint: str) -> DataFrame:
    """The rows of the committed batches, without the batch number."""
    done = tables.read_or_none(spark, commits_path(checkpoint))
    if done is None:
        raise ValueError(f"no batch of {table_path} is committed")
    batches = done.select("batch").distinct()
    return spark.read.parquet(table_path).join(batches, "batch", "left_semi").drop("batch")


# ---------------------------------------------------------------- generations

def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the generation that readers see, None before the first."""
    pointer = tables.read_or_none(spark, f"{root.rstrip('/')}/current")
    last = None if pointer is None else pointer.orderBy(F.desc("opened")).first()
    return last and last["generation"]


def refresh(spark: SparkSession, landing: str, root: str, full_refresh: bool = False,
            header: Sequence[str] = K.SOURCE_HEADER, max_files: int = MAX_FILES) -> str:
    """Ingest into the current generation under ``root``; with ``full_refresh`` (or when
    there is none) into a new one, which readers see once it is complete. Returns its folder."""
    base, now = root.rstrip("/"), current(spark, root)
    opens = full_refresh or now is None
    generation = f"{base}/g-{uuid.uuid4().hex[:12]}" if opens else now
    ingest(spark, landing, f"{generation}/rows", f"{generation}/checkpoint", header, max_files)
    if opens:
        opened = spark.range(1).select(F.lit(generation).alias("generation"), F.current_timestamp().alias("opened"))
        opened.coalesce(1).write.mode("append").parquet(f"{base}/current")
    return generation


def read(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the current generation."""
    generation = current(spark, root)
    if generation is None:
        raise ValueError(f"no generation of {root} is complete")
    return committed_rows(spark, f"{generation}/rows", f"{generation}/checkpoint")

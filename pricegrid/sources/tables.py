"""Table lifecycle on plain Parquet: namespaces, typed empty tables, versioned
replacement, comments, physical layout facts, compaction and clustering.

A version is a folder, or a *manifest*: a Parquet table (path, length) of the data files
that make it up, which may lie in folders of earlier versions.

Tables are never overwritten in place: a replacement is written to a new
version folder and the caller switches to the returned path, so a table that
is being read is never truncated under its readers.
"""

from __future__ import annotations

import bisect
import math
import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pricegrid.session import cut_lineage

TARGET_FILE_BYTES = 128 * 1024 * 1024
LISTED = 10_000  # files that one task packs into bins
FILE_ROWS = 1 << 20  # of a clustered file, which one task sorts, however well its rows compress
RANK_BITS, RANK_SAMPLE = 8, 100_000  # of a column's place in an interleaved key


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is none yet. Any other
    failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def setup(spark: SparkSession, schemas: dict[str, str]) -> None:
    """CREATE SCHEMA IF NOT EXISTS ... COMMENT ... for each namespace."""
    for name, comment in schemas.items():
        text = comment.replace("'", "\\'")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT '{text}'")


def create_empty(spark: SparkSession, table: str, ddl: str, location: str | None = None) -> None:
    """Typed empty table if absent (DDL declared, Parquet)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet{loc}")


def replace(df: DataFrame, root: str, name: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new version of table ``name`` under ``root``; return
    the version path. The previous version stays readable."""
    path = f"{root.rstrip('/')}/{name}/v-{uuid.uuid4().hex[:12]}"
    w = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def comment(spark: SparkSession, tables: dict[str, str] | None = None,
            columns: Iterable[tuple[str, str, str]] = ()) -> list[tuple[str, str]]:
    """Table and column comments; a failing item is reported, not fatal."""
    errors = []
    for table, text in (tables or {}).items():
        try:
            spark.sql(f"COMMENT ON TABLE {table} IS '{text.replace(chr(39), chr(92) + chr(39))}'")
        except Exception as e:  # noqa: BLE001 - reported per item
            errors.append((table, f"{type(e).__name__}: {str(e)[:150]}"))
    for table, col, text in columns:
        try:
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN {col} COMMENT "
                      f"'{text.replace(chr(39), chr(92) + chr(39))}'")
        except Exception as e:  # noqa: BLE001
            errors.append((f"{table}.{col}", f"{type(e).__name__}: {str(e)[:150]}"))
    return errors


def files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Data files of a table with their sizes (listing only; no file is read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(path).select("path", "length"))


def register(spark: SparkSession, table: str, path: str) -> None:
    """Point catalog table ``table`` at the version in ``path``. The table is
    external: re-creating its entry moves no data, and readers see this version."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)


def layout_stats(spark: SparkSession, path: str) -> DataFrame:
    """num_files and size_bytes of a table (re-aimed DESCRIBE DETAIL)."""
    return files(spark, path).agg(F.count(F.lit(1)).alias("num_files"),
                                  F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"))


def target_files(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    row = layout_stats(spark, path).first()
    return max(1, math.ceil(row.size_bytes / target_bytes))


def sorted_files(spark: SparkSession, path: str, target_bytes: int) -> int:
    """``target_files``, and enough of them that none has more than about ``FILE_ROWS`` rows."""
    return max(target_files(spark, path, target_bytes), -(-spark.read.parquet(path).count() // FILE_ROWS))


def compact(spark: SparkSession, path: str, out_root: str, name: str,
            target_bytes: int = TARGET_FILE_BYTES) -> str:
    """Rewrite a table into files of about ``target_bytes`` (re-aimed OPTIMIZE). Tasks that
    read no more than a file's bytes are joined to files without a shuffle; to files smaller
    than what a task reads, rows are dealt."""
    n, df = target_files(spark, path, target_bytes), spark.read.parquet(path)
    read = re.fullmatch(r"(\d+)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower())
    whole = read and int(read[1]) <= target_bytes  # then at least n tasks read
    return replace(df.coalesce(n) if whole else df.repartition(n), out_root, name)


def cluster(spark: SparkSession, path: str, cols: Sequence[str], out_root: str, name: str,
            target_bytes: int = TARGET_FILE_BYTES) -> str:
    """Range-partition and sort by ``cols`` (re-aimed CLUSTER BY + full rewrite):
    each file then covers a narrow key range, and Parquet row-group min/max
    statistics let filters on ``cols`` skip files and row groups."""
    n = sorted_files(spark, path, target_bytes)
    df = spark.read.parquet(path).repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    return replace(df, out_root, name)


def file_ranges(spark: SparkSession, path: str, col: str) -> DataFrame:
    """Per data file: rows and min/max of ``col`` (one aggregate by file path). Spark sorts
    all rows for the min and max of text, so values of text are counted by hash first."""
    df, file = spark.read.parquet(path), F.col("_metadata.file_path").alias("file")
    if not isinstance(df.schema[col].dataType, StringType):
        return df.groupBy(file).agg(F.count(F.lit(1)).alias("rows"), F.min(col).alias("lo"), F.max(col).alias("hi"))
    counts = df.groupBy(file, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("file").agg(F.sum("n").alias("rows"), F.min("value").alias("lo"), F.max("value").alias("hi"))


# ---------------------------------------------------------------- manifests and packing

def _plain(path) -> Column:
    """A file's name as it is listed: file:/x, file:///x and /x are the same."""
    return F.regexp_replace(path, r"^file:/+", "/")


def write_manifest(listing: DataFrame, root: str, name: str) -> str:
    return replace(listing.select("path", "length"), root, f"{name}-manifest")


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """The rows of a manifest's files. Their names pass through the driver, as those of
    any table's files do when Spark plans a scan."""
    return spark.read.parquet(*[r["path"] for r in spark.read.parquet(manifest).select("path").collect()])


def bins(listing: DataFrame, target_bytes: int) -> DataFrame:
    """(path, length, bin) of files (path, length): runs of neighbouring names of about
    ``target_bytes``, bins numbered from 0 without gaps. Packed in shards of about
    ``LISTED`` files, each a task."""
    listing = cut_lineage(listing.select("path", "length"), "listing")
    shards = max(1, -(-listing.count() // LISTED))
    before = Window.partitionBy("shard").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    packed = (listing.withColumn("shard", F.pmod(F.xxhash64("path"), F.lit(shards)))
              .withColumn("at", F.coalesce(F.sum("length").over(before), F.lit(0)))
              .withColumn("full", F.floor(F.col("at") / target_bytes)))
    packed = cut_lineage(packed.withColumn("n", F.dense_rank().over(Window.partitionBy("shard").orderBy("full"))), "bins")
    counts = packed.groupBy("shard").agg(F.max("n").alias("n")).orderBy("shard").collect()  # one row for each shard
    starts, total = [], 0
    for r in counts:
        starts.append((r["shard"], total - 1))
        total += r["n"]
    offsets = listing.sparkSession.createDataFrame(starts, "shard long, before long")
    return packed.join(offsets, "shard").select("path", "length", (F.col("n") + F.col("before")).cast("int").alias("bin"))


def pack_small(spark: SparkSession, path: str, out_root: str, name: str, target_bytes: int = TARGET_FILE_BYTES,
               small_bytes: int | None = None) -> tuple[str, int]:
    """Merge the files under ``small_bytes`` (half the target, if not given) into files of
    about ``target_bytes``: each bin becomes one file and crosses one exchange. All other
    files, and a small one that is alone in its bin, are taken over by the manifest as
    they are, so their clustering stays. Returns the manifest and the bytes rewritten."""
    listing = cut_lineage(files(spark, path), "listing")
    small = F.col("length") < (target_bytes // 2 if small_bytes is None else small_bytes)
    packed = cut_lineage(bins(listing.where(small), target_bytes), "packed")
    crowd = packed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")).where("n > 1")
    # merged bins numbered anew, so that each is one task and one file
    numbered = cut_lineage(crowd.withColumn("task", F.row_number().over(Window.orderBy("bin")) - 1), "tasks")
    merged = cut_lineage(packed.join(numbered.select("bin", "task"), "bin").select("path", "task"), "merged")
    kept = listing.join(merged, "path", "left_anti").select("path", "length")
    tasks, rewritten = numbered.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    if not tasks:
        return write_manifest(kept, out_root, name), 0
    rows = spark.read.parquet(*[r["path"] for r in merged.select("path").collect()])
    of = merged.select(_plain(F.col("path")).alias("_from"), F.col("task").alias("_task"))
    rows = rows.withColumn("_from", _plain(F.col("_metadata.file_path"))).join(of, "_from")
    new = replace(rows.repartitionById(tasks, F.col("_task")).drop("_from", "_task"), out_root, name)
    return write_manifest(kept.unionByName(files(spark, new).select("path", "length")), out_root, name), rewritten


# ---------------------------------------------------------------- interleaved clustering

def rank(df: DataFrame, col: str, bits: int = RANK_BITS) -> Column:
    """The place of ``col`` among ``2**bits`` ranges of about equal row counts. The bounds
    come from at most about ``RANK_SAMPLE`` rows, as those of a range exchange do; they
    decide where a row is put, never whether."""
    share = min(1.0, RANK_SAMPLE / max(1, df.count()))
    taken = sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).sample(share, seed=7).limit(2 * RANK_SAMPLE).collect())
    if not taken:
        return F.lit(0)
    bounds = [taken[len(taken) * i >> bits] for i in range(1, 1 << bits)]  # a frequent value bounds several ranges
    kind = df.schema[col].dataType
    edges = [(b, bisect.bisect_right(bounds, b)) for b in sorted(set(bounds))]  # a bound, how many are up to it

    def place(low: int, high: int) -> Column:
        """Halving: a row is compared with as many edges as the tree is deep."""
        if low == high:
            return F.lit(edges[low - 1][1] if low else 0)
        middle = (low + high) // 2
        return F.when(F.col(col) >= F.lit(edges[middle][0]).cast(kind), place(middle + 1, high)).otherwise(place(low, middle))

    return place(0, len(edges))  # a null is at 0


def interleaved(df: DataFrame, cols: Sequence[str], name: str = "_z", bits: int = RANK_BITS) -> DataFrame:
    """``df`` with its Z-order key ``name``: the bits of the columns' ranks in turn, highest
    first. Ranks are columns first, so each is found once for a row, not once for each bit."""
    ranks = {f"{name}{i}": rank(df, c, bits).cast("long") for i, c in enumerate(cols)}
    key = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for r in ranks:
            key = key * 2 + F.shiftright(r, bit).bitwiseAND(F.lit(1))
    return df.withColumns(ranks).withColumn(name, key).drop(*ranks)


def cluster_interleaved(spark: SparkSession, path: str, cols: Sequence[str], out_root: str, name: str,
                        target_bytes: int = TARGET_FILE_BYTES) -> str:
    """Range-partition and sort by the interleaved ranks of ``cols``: each file covers a
    narrow range of every column, so a filter on any one of them skips files."""
    n = sorted_files(spark, path, target_bytes)
    df = interleaved(spark.read.parquet(path), cols)
    return replace(df.repartitionByRange(n, "_z", *cols).sortWithinPartitions("_z", *cols).drop("_z"), out_root, name)


def share_met(spark: SparkSession, path: str, col: str) -> DataFrame:
    """share: of the files, how many a filter ``col = value`` has to open, on average over
    the values of the column. Values are numbered once; a file meets those from its lowest
    to its highest."""
    ranges = cut_lineage(file_ranges(spark, path, col).where(F.col("lo").isNotNull()), "ranges")
    # numbered by range: a value's place in its part, after all earlier parts
    ordered = (spark.read.parquet(path).select(F.col(col).alias("value")).where(F.col(col).isNotNull()).distinct()
               .repartitionByRange("value").withColumn("part", F.spark_partition_id()))
    ordered = cut_lineage(ordered.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy("value"))), "values")
    sizes = ordered.groupBy("part").agg(F.max("nth").alias("n"))  # one row for each part
    starts = sizes.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "before")
    place = ordered.join(starts, "part").select("value", (F.col("before") + F.col("nth")).alias("place"))
    lows, highs = (place.select(F.col("value").alias(c), F.col("place").alias(f"{c}_place")) for c in ("lo", "hi"))
    met = ranges.join(lows, "lo").join(highs, "hi").agg(F.sum(F.col("hi_place") - F.col("lo_place") + 1).alias("met"), F.count(F.lit(1)).alias("files"))
    return met.select((F.col("met") / (F.col("files") * F.lit(ordered.count()))).alias("share"))


def overlapping_files(ranges: DataFrame) -> DataFrame:
    """Files of ``ranges`` (file, lo, hi) that begin below the highest value of the files
    before them, by a sweep from the lowest start on. Ranges that share only an end don't
    overlap. The sweep runs within range partitions; only their highest values (a row for
    each) are carried from one to the next."""
    parts = ranges.where(F.col("lo").isNotNull()).repartitionByRange("lo", "hi", "file").withColumn("part", F.spark_partition_id())
    parts = cut_lineage(parts, "sweep")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tops = parts.groupBy("part").agg(F.max("hi").alias("top")).withColumn("carried", F.max("top").over(earlier)).drop("top")
    before = Window.partitionBy("part").orderBy("lo", "hi", "file").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.max("hi").over(before), F.col("carried"))  # greatest skips nulls
    return parts.join(tops, "part").withColumn("reached", reached).where(F.col("lo") < F.col("reached")).drop("part", "carried", "reached")

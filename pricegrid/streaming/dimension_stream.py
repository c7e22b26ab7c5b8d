"""Incremental station dimension fed by a stream of observations, copy on write.

The dimension is kept in ``buckets`` key-hash buckets. A version is a manifest: for each
bucket the folder that holds its rows. A micro-batch (``foreachBatch``) stores its
snapshots under ``<root>/snapshots/batch=<id>/bucket=<b>``, reads and rewrites only the
buckets its keys fall into (``<root>/data/batch=<id>/bucket=<b>``) and writes a manifest
that names those folders and, for all other buckets, the folders of the version before.

Snapshots later than the high-water mark are applied by ``scd2.apply_later``; only when
a batch holds an earlier one (a date split over two files, late files) the keys
concerned are rebuilt, from the stored snapshots of the touched buckets. The log holds a
row for each committed batch with its manifest, ``<log>-dates`` what each date opened
and closed; every logged version stays readable (``version``), and two of them are
compared by reading only the buckets whose folders differ (``difference``).

Folders hold no hashes; station_key and attribute_hash are computed where rows are read.

Failure model: a batch replayed after a crash either finds its id in the log
(skipped: no double apply) or recomputes the same folders from the same previous
manifest (deterministic overwrite) and then logs it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.functions.keys import attribute_hash, version_key
from pricegrid.operators import scd2
from pricegrid.session import cut_lineage
from pricegrid.sources import tables

LOG_SCHEMA = ("batch_id bigint, version_path string, high_water date, snapshots bigint, "
              "versions bigint, buckets int, buckets_written int, columns string")
MANIFEST = "bucket int, folder string, versions bigint"
BUCKETS = 64  # set it so that a bucket of the largest dimension fits a task


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    log = tables.read_or_none(spark, log_path)
    return spark.createDataFrame([], LOG_SCHEMA) if log is None else log


def _entry(spark: SparkSession, log_path: str, batch_id: int | None = None) -> Row | None:
    """The log row of the last batch, or of the last up to ``batch_id``."""
    log = read_log(spark, log_path)
    if batch_id is not None:
        log = log.where(F.col("batch_id") <= batch_id)
    return log.orderBy(F.desc("batch_id")).first()


def _manifest(spark: SparkSession, entry: Row) -> dict[int, Row]:
    """At most one row for each bucket."""
    return {r["bucket"]: r for r in spark.read.schema(MANIFEST).parquet(entry["version_path"]).collect()}


def _rows(spark: SparkSession, entry: Row, folders: Sequence[str]) -> DataFrame:
    columns = T.StructType.fromJson(json.loads(entry["columns"]))
    attrs = [c for c in columns.names if c not in (scd2.KEY, "valid_from", "valid_to", "is_current")]
    if not folders:
        return scd2.restored(spark.createDataFrame([], columns), attrs)
    # the folders are read as they are named, not searched for partitions
    return scd2.restored(spark.read.schema(columns).option("recursiveFileLookup", "true").parquet(*folders), attrs)


def current(spark: SparkSession, root: str, log_path: str):
    """(dimension DataFrame or None, high-water date or None, last batch id)."""
    last = _entry(spark, log_path)
    if last is None:
        return None, None, -1
    return _rows(spark, last, [r["folder"] for r in _manifest(spark, last).values()]), last.high_water, last.batch_id


def version(spark: SparkSession, log_path: str, batch_id: int) -> DataFrame:
    """The dimension as it was after ``batch_id`` (the last logged batch up to it)."""
    entry = _entry(spark, log_path, batch_id)
    if entry is None:
        raise ValueError(f"no version is logged up to batch {batch_id}")
    return _rows(spark, entry, [r["folder"] for r in _manifest(spark, entry).values()])


def difference(spark: SparkSession, log_path: str, earlier: int, later: int) -> DataFrame:
    """What changed from one logged version to another: station_key, reseller_cnpj,
    valid_from, change (opened, closed, changed or dropped) and valid_to before and after.
    Buckets that both manifests take from the same folder are not read."""
    entries = [_entry(spark, log_path, b) for b in (earlier, later)]
    if None in entries:
        raise ValueError(f"no version is logged up to batch {min(earlier, later)}")
    held = [{r["folder"] for r in _manifest(spark, e).values()} for e in entries]
    before, after = (_rows(spark, e, sorted(mine - other)) for e, mine, other in zip(entries, held, held[::-1]))
    mark = F.unhex(F.substring("attribute_hash", 1, 32)).alias("mark")  # as sure as the whole hash
    state = F.struct("valid_to", mark, "is_current")
    was, now = (rows.select(F.col(scd2.KEY).alias(f"{x}_key"), F.col("valid_from").alias(f"{x}_from"), state.alias(x))
                for x, rows in (("was", before), ("now", after)))
    # versions meet by the natural key that station_key digests
    same = was["was_key"].eqNullSafe(now["now_key"]) & was["was_from"].eqNullSafe(now["now_from"])
    key, start = F.coalesce("now_key", "was_key"), F.coalesce("now_from", "was_from")
    change = (F.when(F.col("was").isNull(), "opened").when(F.col("now").isNull(), "dropped")
              .when(F.col("was.is_current") & ~F.col("now.is_current"), "closed").otherwise("changed"))
    return (was.join(now, same, "full").where(~F.col("was").eqNullSafe(F.col("now")))
            .select(version_key(key, start).alias("station_key"), key.alias(scd2.KEY), start.alias("valid_from"),
                    change.alias("change"), F.col("was.valid_to").alias("valid_to_before"), F.col("now.valid_to").alias("valid_to_after")))


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(scd2.KEY), F.lit(buckets)).cast("int"))


def _write(rows: DataFrame, path: str, buckets: int) -> None:
    """One file for each bucket, in a folder of its own, written by a task of its own: tasks of
    several buckets sort more rows by bucket than they hold."""
    (_bucketed(rows, buckets).repartitionById(buckets, F.col("bucket")).write.mode("overwrite").option("compression", "zstd")
     .partitionBy("bucket").parquet(path))


def _commit(spark: SparkSession, root: str, log_path: str, batch_id: int, kept: dict[int, Row], columns: T.StructType, buckets: int,
            high_water: Column, snapshots: DataFrame) -> DataFrame:
    """Writes the manifest and the log entry of data already written; the rows written."""
    folder = f"{root.rstrip('/')}/data/batch={batch_id}"
    entry = Row(columns=columns.json())
    held = _files(spark, folder)
    written = _rows(spark, entry, [f"{folder}/bucket={b}" for b in held])
    counts = {r["bucket"]: r["n"] for r in _bucketed(written, buckets).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = [tuple(r) for b, r in kept.items()] + [(b, f"{folder}/bucket={b}", counts[b]) for b in held]
    path = f"{root.rstrip('/')}/manifest/batch={batch_id}"
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(path)
    stats = snapshots.agg(F.max(scd2.DATE).alias("last"), F.count(F.lit(1)).alias("snapshots"))
    values = {"batch_id": F.lit(batch_id).cast("bigint"), "version_path": F.lit(path), "high_water": F.greatest("last", high_water),
              "snapshots": F.col("snapshots"), "versions": F.lit(sum(r[2] for r in rows)).cast("bigint"), "buckets": F.lit(buckets),
              "buckets_written": F.lit(len(held)), "columns": F.lit(columns.json())}
    stats.select(*(v.alias(k) for k, v in values.items())).write.mode("append").parquet(log_path)
    return written


def _files(spark: SparkSession, folder: str) -> list[int]:
    """The buckets that a batch has written (at most one row for each)."""
    number = F.regexp_extract("path", r"/bucket=([0-9]+)/", 1).cast("int").alias("bucket")
    return sorted(r["bucket"] for r in tables.files(spark, folder).select(number).distinct().collect())


def applied(dim: DataFrame, snaps: DataFrame, history: DataFrame, attrs: Sequence[str],
            high_water) -> DataFrame:
    """``dim`` with a batch of snapshots: later ones applied, keys with a late
    one rebuilt from ``history`` (all their snapshots, this batch included)."""
    late = cut_lineage(scd2.late_keys(snaps, high_water), "late")  # read by five joins, planned by its size
    on_time = snaps.join(late, scd2.KEY, "left_anti")
    new = scd2.apply_later(dim, on_time, attrs)  # keys without a late date
    return scd2.rebuild_keys(new, scd2.one_state(history.join(late, scd2.KEY, "left_semi"), attrs),
                             late, attrs, rows=history.count())


def start(spark: SparkSession, observations: DataFrame, attrs: Sequence[str], root: str,
          log_path: str, checkpoint: str, canonical=None, available_now: bool = True, buckets: int = BUCKETS):
    """Start the stream; ``observations`` is a streaming DataFrame of clean
    observation rows, ``canonical`` an optional function applied per batch
    (label aliasing) before snapshots are taken. ``buckets`` counts for a new dimension."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        if read_log(s, log_path).where(F.col("batch_id") == batch_id).limit(1).count():
            return  # already committed: replay is a no-op
        last = _entry(s, log_path)
        n = buckets if last is None else last["buckets"]
        obs = canonical(batch) if canonical else batch
        stored = f"{root.rstrip('/')}/snapshots"
        taken = scd2.snapshots(obs, attrs)
        _write(taken.drop(scd2.HASH), f"{stored}/batch={batch_id}", n)
        touched = _files(s, f"{stored}/batch={batch_id}")
        if not touched:
            return  # no observations
        history = s.read.schema(T.StructType([*taken.drop(scd2.HASH).schema, *T.StructType.fromDDL("batch long, bucket int")])).parquet(stored)
        history = history.withColumn(scd2.HASH, attribute_hash(attrs))
        snaps = history.where(F.col("batch") == batch_id).drop("batch", "bucket")
        manifest = {} if last is None else _manifest(s, last)
        high_water = None if last is None else last["high_water"]
        if last is None:
            new, old = scd2.build(snaps, attrs), None
        else:
            old = _rows(s, last, [manifest[b]["folder"] for b in touched if b in manifest])
            first = snaps.agg(F.min(scd2.DATE)).first()[0]
            if high_water is None or first > high_water:
                new = scd2.apply_later(old, snaps, attrs)
            else:
                seen = history.where(F.col("bucket").isin(touched) & (F.col("batch") <= batch_id)).drop("batch", "bucket")
                new = applied(old, snaps, seen, attrs, high_water)
        _write(scd2.stored(new), f"{root.rstrip('/')}/data/batch={batch_id}", n)
        before = new.limit(0) if old is None else old
        written = _rows(s, Row(columns=scd2.stored(new).schema.json()), [f"{root.rstrip('/')}/data/batch={batch_id}"])
        (scd2.batch_log(before, written, snaps)
         .write.mode("overwrite").parquet(f"{log_path.rstrip('/')}-dates/batch={batch_id}"))
        kept = {b: r for b, r in manifest.items() if b not in touched}
        _commit(s, root, log_path, batch_id, kept, scd2.stored(new).schema, n, F.lit(high_water).cast("date"), snaps)

    w = (observations.writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def seed(spark: SparkSession, dim: DataFrame, snapshots: DataFrame, high_water, root: str,
         log_path: str, batch_id: int = -1, buckets: int = BUCKETS) -> str:
    """Commit an existing dimension (e.g. a one-shot build of the history) as
    the starting version, with the snapshots it was built from and the last
    date it covers as high-water mark. Returns its manifest."""
    _write(snapshots.drop(scd2.HASH), f"{root.rstrip('/')}/snapshots/batch={batch_id}", buckets)
    _write(scd2.stored(dim), f"{root.rstrip('/')}/data/batch={batch_id}", buckets)
    hw = high_water if isinstance(high_water, Column) else F.lit(high_water).cast("date")
    _commit(spark, root, log_path, batch_id, {}, scd2.stored(dim).schema, buckets, hw, snapshots.limit(0))
    return f"{root.rstrip('/')}/manifest/batch={batch_id}"

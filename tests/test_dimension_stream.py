"""Incremental station dimension over several micro-batches."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from pricegrid.operators import compare, scd2
from pricegrid.streaming import dimension_stream as DS

ATTRS = ["name", "brand"]
SCHEMA = "reseller_cnpj string, collection_date date, name string, brand string"


def rows(days, flip):
    base = dt.date(2024, 1, 1)
    return [(str(k), base + dt.timedelta(days=d), "P", "B" if (d + k) % flip == 0 else "A")
            for k in range(4) for d in days]


def test_stream_batches_equal_one_shot_and_replay_is_noop(spark, scratch):
    hist, feed = rows(range(0, 10), 4), scratch("feed")
    a, b = rows(range(10, 20), 3), rows(range(20, 30), 5)
    spark.createDataFrame(a, SCHEMA).coalesce(1).write.parquet(feed + "/a")
    time.sleep(1.2)
    spark.createDataFrame(b, SCHEMA).coalesce(1).write.parquet(feed + "/b")
    root, log, ckpt = scratch("dim"), scratch("log"), scratch("ckpt")
    h = spark.createDataFrame(hist, SCHEMA)
    DS.seed(spark, scd2.build(scd2.snapshots(h, ATTRS), ATTRS), scd2.snapshots(h, ATTRS), dt.date(2024, 1, 10), root, log)

    def start():
        stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
                  .option("recursiveFileLookup", "true").parquet(feed))
        q = DS.start(spark, stream, ATTRS, root, log, ckpt)
        q.awaitTermination()
        return q

    start()
    entries = DS.read_log(spark, log).orderBy("batch_id").collect()
    assert [e.batch_id for e in entries] == [-1, 0, 1]
    assert str(entries[-1].high_water) == "2024-01-30"
    dim, _, _ = DS.current(spark, root, log)
    full = scd2.build(scd2.snapshots(spark.createDataFrame(hist + a + b, SCHEMA), ATTRS), ATTRS)
    d = compare.symmetric_diff(full, dim, full.columns, multiset=True).first()
    assert (d.only_in_left, d.only_in_right) == (0, 0)
    start()  # same checkpoint: nothing new, nothing applied twice
    assert DS.read_log(spark, log).count() == 3


def test_late_and_split_dates_rebuild_their_keys(spark, scratch):
    """Dates before the high water, and one date in two files, end like a one-shot build."""
    hist = [r for r in rows(range(0, 10), 4) if not (r[0] == "1" and r[1].day in (4, 5, 6))]
    late = [r for r in rows(range(0, 10), 4) if r[0] == "1" and r[1].day in (4, 5, 6)]
    split = rows(range(10, 14), 2)
    root, log, ckpt, feed = scratch("dim"), scratch("log"), scratch("ckpt"), scratch("feed")
    h = spark.createDataFrame(hist, SCHEMA)
    DS.seed(spark, scd2.build(scd2.snapshots(h, ATTRS), ATTRS), scd2.snapshots(h, ATTRS), dt.date(2024, 1, 10), root, log)
    for part in (split[::2], late + split[1::2]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(SCHEMA).parquet(feed)
        DS.start(spark, stream, ATTRS, root, log, ckpt).awaitTermination()
    dim, high_water, _ = DS.current(spark, root, log)
    full = scd2.build(scd2.snapshots(spark.createDataFrame(hist + late + split, SCHEMA), ATTRS), ATTRS)
    d = compare.symmetric_diff(full, dim, full.columns, multiset=True).first()
    assert (d.only_in_left, d.only_in_right) == (0, 0) and str(high_water) == "2024-01-14"
    assert spark.read.parquet(log + "-dates").select("batch").distinct().count() == 2


def test_a_broken_log_is_not_taken_for_a_missing_one(spark, scratch):
    import os
    log = scratch("log")
    os.makedirs(log)  # a folder without a table
    with pytest.raises(Exception, match="(?i)schema"):
        DS.read_log(spark, log)
    assert DS.read_log(spark, scratch("none")).count() == 0


def _batches(spark, scratch, batches, buckets=8):
    """A seeded dimension and one micro-batch for each list of rows; (root, log)."""
    root, log, ckpt, feed = scratch("dim"), scratch("log"), scratch("ckpt"), scratch("feed")
    hist = spark.createDataFrame([(f"k{i}", dt.date(2024, 1, 1), "P", "A") for i in range(40)], SCHEMA)
    DS.seed(spark, scd2.build(scd2.snapshots(hist, ATTRS), ATTRS), scd2.snapshots(hist, ATTRS), dt.date(2024, 1, 1), root, log, buckets=buckets)
    for part in batches:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(feed)
        DS.start(spark, spark.readStream.schema(SCHEMA).parquet(feed), ATTRS, root, log, ckpt).awaitTermination()
    return root, log


def test_a_batch_of_one_key_rewrites_one_bucket(spark, scratch):
    import glob
    day = dt.date(2024, 1, 2)
    root, log = _batches(spark, scratch, [[("k3", day, "P", "B")], [("k3", day, "P", "C")], [("new", day, "P", "B")]])
    entries = {e.batch_id: e for e in DS.read_log(spark, log).collect()}
    assert [entries[i].buckets_written for i in (-1, 0, 1, 2)] == [8, 1, 1, 1]
    for i in (0, 1, 2):
        assert len(glob.glob(f"{root}/data/batch={i}/*/*.parquet")) == 1
        was, now = ({b: r["folder"] for b, r in DS._manifest(spark, entries[j]).items()} for j in (i - 1, i))
        assert sum(was[b] != now[b] for b in now) == 1 and len(now) == 8
    assert [entries[i].versions for i in (-1, 0, 1, 2)] == [40, 41, 41, 42]  # the second batch is late: smaller hash wins


def test_versions_and_their_difference_across_three_batches(spark, scratch):
    day = lambda i: dt.date(2024, 1, i)
    root, log = _batches(spark, scratch, [[("k1", day(2), "P", "B"), ("k2", day(2), "P", "A")], [("k1", day(3), "P", "B")],
                                          [("k1", day(4), "P", "A"), ("n", day(4), "P", "A")]])
    assert [DS.version(spark, log, i).count() for i in (-1, 0, 1, 2, 9)] == [40, 41, 41, 43, 43]
    changes = lambda a, b: sorted((r.reseller_cnpj, str(r.valid_from), r.change, str(r.valid_to_before), str(r.valid_to_after))
                                  for r in DS.difference(spark, log, a, b).collect())
    end = "9999-12-31"
    assert changes(-1, 0) == [("k1", "2024-01-01", "closed", end, "2024-01-02"), ("k1", "2024-01-02", "opened", "None", end)]
    assert changes(0, 1) == []
    assert changes(-1, 2) == [("k1", "2024-01-01", "closed", end, "2024-01-02"), ("k1", "2024-01-02", "opened", "None", "2024-01-04"),
                              ("k1", "2024-01-04", "opened", "None", end), ("n", "2024-01-04", "opened", "None", end)]
    with pytest.raises(ValueError, match="no version"):
        DS.version(spark, log, -2)

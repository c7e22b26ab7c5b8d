import zlib

import pytest
from pyspark.sql import functions as F

from pricegrid.llm import sharding as X
from pricegrid.session import scratch_path


def placed(df, **options):
    return X.shuffle(df, scratch_path(df.sparkSession, "test-shards"), bucket_bytes=2000, **options)


def test_every_row_once_with_equal_shards(docs, writing):
    rows = [(i, writing(1 + i % 30, i)) for i in range(203)] + [(None, None), (7, "again"), (7, "again"), (900, "é" * 9000), (901, "")]
    df = docs(rows)
    out = placed(df)
    assert set(out.columns) == {*df.columns, "shard", "slot"}
    assert out.select(df.columns).exceptAll(df).count() == df.exceptAll(out.select(df.columns)).count() == 0
    found = out.collect()
    by = {k: sorted(r.slot for r in found if r.shard == k) for k in range(X.SHARDS)}
    assert all(s == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    order = [r.doc_id for r in sorted(found, key=lambda r: (r.slot, r.shard)) if r.doc_id is not None and r.doc_id < 203]
    assert order != sorted(order)


def test_order_depends_on_rows_and_seed_alone(docs, writing, monkeypatch):
    df = docs([(i, writing(5, i)) for i in range(150)])
    key = lambda d: sorted((r.doc_id, r.shard, r.slot) for r in d.collect())
    usual = key(placed(df))
    with monkeypatch.context() as m:
        m.setattr(X, "BROADCAST_BUCKETS", 0)
        assert key(placed(df)) == usual
    assert key(placed(df)) == key(placed(df.repartition(5))) != key(placed(df, seed=1))
    assert {r.shard for r in placed(df, shards=3).collect()} == {0, 1, 2}


def test_shuffle_is_uniform(docs):
    """Where a row lands says nothing of its id."""
    df = docs([(i, "t") for i in range(2000)])
    half = [r.doc_id for r in placed(df).where("slot < 125").collect()]
    assert len(half) == 1000 and abs(sum(half) / 1000 - 999.5) < 60


def test_size_and_edges(docs):
    df = docs([(1, None), (2, ""), (3, "é")])
    assert [r[0] for r in df.orderBy("doc_id").select(X.size()).collect()] == [1, 1, 3]
    assert placed(docs([])).count() == 0
    for name in ("slot", "_order", "_bucket"):
        with pytest.raises(ValueError):
            placed(df.withColumn(name, F.lit(1)))
    crc = df.where("doc_id = 3").select(F.crc32(F.col("text").cast("binary"))).first()[0]
    assert crc == zlib.crc32("é".encode())

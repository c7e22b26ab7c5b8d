"""Sharding by a two-pass external shuffle.

Pass one scatters the rows over buckets by a seeded hash; the number of buckets
follows the bytes of the table, so a bucket's texts take about ``BUCKET_BYTES``.
Spark's shuffle is the external store. Pass two puts each bucket in a canonical
order (a second seeded hash, then doc_id and the text's hash), draws a seeded
Fisher-Yates permutation of its row numbers and writes the rows in that order.
Each bucket is one partition. Counting rows per bucket beforehand gives each bucket its first place in the
whole order; place ``p`` goes to shard ``p mod shards`` at slot ``p div shards``,
so shard sizes differ by one row at most (law ``rows``) and slots have no gap.

Only row numbers are permuted in memory (8 bytes a row); the rows themselves pass
through an external sort, so a bucket that outgrows its size, for instance rows
that repeat one doc_id and text, costs disk but not memory. The order depends on
seed, doc_id, text and the bucket count alone: a lost task is redone alike.

Edge cases: null text is size 1 and crc32 of no bytes; null doc_ids and repeated
rows are rows like any other; column names that clash with ``shard``, ``slot`` or an
inner column are refused; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pricegrid.session import scratch_path

BUCKET_BYTES = 32 << 20
BROADCAST_BUCKETS = 1 << 17  # a row of 24 bytes each; beyond, the join shuffles
SHARDS = 8
LAW = "rows"


def size(text: str = "text") -> Column:
    """UTF-8 bytes of the text plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _permuted(seed: int):
    """Rows sorted by bucket to rows with their place in the whole order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, order, at = None, None, 0
        for batch in batches:
            buckets, firsts, counts = (batch.column(i).to_numpy() for i in range(3))
            place = np.empty(len(buckets), np.int64)
            cuts = [0, *(np.flatnonzero(buckets[1:] != buckets[:-1]) + 1), len(buckets)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if buckets[a] != bucket:
                    bucket, at = buckets[a], 0
                    order = np.random.default_rng([seed, int(bucket)]).permutation(int(counts[a]))  # a Fisher-Yates shuffle
                place[a:b] = firsts[a] + order[at:at + b - a]
                at += b - a
            yield pa.RecordBatch.from_arrays([pa.array(place), *batch.columns[3:]], ["_place", *batch.schema.names[3:]])
    return run


def shuffle(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 0, doc_id: str = "doc_id", text: str = "text",
            bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` to ``path`` as ``shards`` folders ``shard=<k>``, each row with
    its ``slot``; a file is sorted by slot and a bucket's slots are one range.
    Returns the written table."""
    if clash := {"shard", "slot", "_place", "_bucket", "_order", "_first", "_count"} & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are the operator's own")
    spark = docs.sparkSession
    body = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    total = docs.agg(F.sum(size(text))).first()[0] or 0
    buckets = int(max(1, -(-total // bucket_bytes)))
    keyed = docs.withColumns({"_bucket": F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), body), F.lit(buckets)).cast("int"),
                              "_order": F.xxhash64(F.lit(seed + 1), F.col(doc_id), body)})
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_count"))  # a row per bucket of BUCKET_BYTES
    first = F.sum("_count").over(Window.orderBy("_bucket")) - F.col("_count")
    firsts = counts.withColumn("_first", first)
    rows = (keyed.join(F.broadcast(firsts) if buckets <= BROADCAST_BUCKETS else firsts, "_bucket")
            .repartitionById(buckets, "_bucket").sortWithinPartitions("_bucket", "_order", doc_id)
            .select("_bucket", "_first", "_count", *docs.columns))
    schema = StructType([StructField("_place", LongType()), *docs.schema.fields])
    placed = (rows.mapInArrow(_permuted(seed), schema)
              .select(*docs.columns, F.expr(f"int(_place % {shards})").alias("shard"), F.expr(f"_place div {shards}").alias("slot"))
              .sortWithinPartitions("shard", "slot"))
    placed.write.partitionBy("shard").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def shards(docs: DataFrame, count: int = SHARDS, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The shuffled shards, written to the shared checkpoint folder."""
    return shuffle(docs, scratch_path(docs.sparkSession, "shards"), count, seed, doc_id, text)

"""Layout rewrites, comparison and dealing keep a task's rows bounded, on rows of their own."""

import pytest
from pyspark.sql import functions as F

from pricegrid import session
from pricegrid.operators import compare
from pricegrid.plans import registry
from pricegrid.sources import tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def written(spark, scratch):
    path = scratch("rows")
    spark.range(4000).select((F.col("id") % 97).alias("a"), (F.col("id") * 31 % 53).alias("b"), "id").write.parquet(path)
    return path


def test_few_shuffle_partitions_do_not_make_large_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)  # the session shuffles to 4 partitions
    assert session.tasks_of(spark, 1000) == 4
    assert session.dealt_to(spark, 1000) == 50 and session.dealt_to(spark, 8) == 0
    assert session.spread(spark.range(1000), 1000, "id").rdd.getNumPartitions() == 50


@pytest.mark.parametrize("make", [tables.cluster, tables.cluster_interleaved])
def test_clustered_files_hold_a_bounded_number_of_rows(spark, written, scratch, monkeypatch, make):
    monkeypatch.setattr(tables, "FILE_ROWS", 400)  # by bytes one file would do
    out = make(spark, written, ["a", "b"], scratch("tables"), "t")
    sizes = [r["rows"] for r in tables.file_ranges(spark, out, "a").collect()]
    assert len(sizes) >= 8 and max(sizes) <= 800 and sum(sizes) == 4000
    assert compare.symmetric_diff(spark.read.parquet(written), spark.read.parquet(out), ["a", "b", "id"], multiset=True).first() == (0, 0)


def test_ranks_are_found_once_for_a_row(spark, written):
    df = spark.read.parquet(written)
    p = df.transform(lambda d: tables.interleaved(d, ["a", "b"]))._jdf.queryExecution().optimizedPlan().toString()
    edges = 53
    assert p.count("CASE WHEN") <= 2 * 97 + 2 * edges  # eight times as many, were they found for each bit
    z = tables.interleaved(df, ["a", "b"])
    assert z.columns == ["a", "b", "id", "_z"] and z.select("_z").distinct().count() > 1000


def test_station_keys_are_dealt_before_they_are_told_apart(spark):
    rows = [(f"{i % 7:064x}"[::-1], i) for i in range(20)] + [(None, None)]
    df = spark.createDataFrame(rows, "station_key string, sale_price int").withColumn("sale_price", F.col("sale_price").cast("decimal(10,3)"))
    got = registry._content(df)
    assert tuple(got.first()) == (21, 7, 190.0) and got.columns == ["rows", "station_keys", "price_sum"]
    p = plan(got)
    subquery = p[p.rindex("REPARTITION_BY_COL"):]  # below the exchange nothing is combined
    assert "REPARTITION_BY_COL" in p and "HashAggregate(keys=[key" not in subquery


@pytest.mark.parametrize("multiset", [False, True])
def test_equal_sides_are_not_shuffled_whole(spark, multiset):
    a = spark.createDataFrame([(i, f"v{i}") for i in range(200)] + [(1, "v1"), (None, None)], "k int, v string")
    b = a.where("k is null or k != 5").unionByName(spark.createDataFrame([(7, "w"), (5, None)], "k int, v string"))
    got = compare.symmetric_diff_by_checksum(a, b, ["k"], ["v"], multiset)
    assert got.columns == ["only_in_left", "only_in_right"]
    assert tuple(got.first()) == tuple(compare.symmetric_diff(a, b, ["k", "v"], multiset).first()) == (1, 2)
    same = compare.symmetric_diff_by_checksum(a, a, ["k"], ["v"], multiset)
    assert tuple(same.first()) == (0, 0) and "Scan" not in plan(same).replace("LocalTableScan", "")


def test_ranges_of_text_do_not_sort_all_rows(spark, scratch):
    path = scratch("text")
    values = F.when(F.col("id") % 5 != 0, F.concat(F.lit("v"), F.col("id") % 3))
    spark.range(0, 300, 1, 3).select("id", values.alias("v")).write.parquet(path)
    got = tables.file_ranges(spark, path, "v")
    assert sorted((r["rows"], r["lo"], r["hi"]) for r in got.collect()) == [(100, "v0", "v2")] * 3
    p = plan(got)
    assert "SortAggregate" not in p[p.rindex("Exchange"):] and "HashAggregate" in p[p.rindex("Exchange"):]
    assert sorted(r["rows"] for r in tables.file_ranges(spark, path, "id").collect()) == [100] * 3

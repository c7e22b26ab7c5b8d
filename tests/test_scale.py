"""What keeps shuffles, tasks and stored tables small, on rows of its own."""

import datetime as dt
import re

from pyspark.sql import functions as F

from pricegrid.operators import checks, compare, facts, rollup, scd2
from pricegrid.sources import tables
from pricegrid.sources import testdata as T
from pricegrid.streaming import dimension_stream as DS

ATTRS = ["name", "brand"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line]


def observed(spark):
    d = dt.date(2024, 1, 1)
    rows = [(str(k), d + dt.timedelta(days=n), f"n{k}", "AB"[(n // 3 + k) % 2] if n % 5 else None, f"p{p}", n + p) for k in range(4) for n in range(20) for p in range(3)]
    rows += [(None, d, "x", "A", "p0", 1), ("9", None, "x", "A", "p0", 1), ("9", d, "x", "A", "p0", 2)]
    return spark.createDataFrame(rows, "reseller_cnpj string, collection_date date, name string, brand string, product string, sale_price int")


def test_as_of_has_one_exchange_and_hot_keys_give_the_same(spark, scratch):
    path = scratch("obs")
    observed(spark).where("collection_date is not null").write.parquet(path)  # an interval join has no null start
    o = spark.read.parquet(path)
    dim_path = scratch("dim")
    scd2.build(scd2.snapshots(o, ATTRS), ATTRS).write.parquet(dim_path)
    dim = spark.read.parquet(dim_path)
    want = sorted(map(str, scd2.as_of_range(o, dim).select("reseller_cnpj", "collection_date", "product", "sale_price", "station_key").collect()))
    for hot_rows in (None, 0, 30):  # none, all and some of the keys are hot
        got = scd2.as_of(o, dim, hot_rows=hot_rows)
        assert got.columns == ["reseller_cnpj", "collection_date", "name", "brand", "product", "sale_price", "station_key"]
        assert sorted(map(str, got.select("reseller_cnpj", "collection_date", "product", "sale_price", "station_key").collect())) == want
    assert len(exchanges(scd2.as_of(o, dim))) == 1


def test_no_hash_crosses_an_exchange_of_snapshots_and_versions(spark, scratch):
    path = scratch("obs")
    observed(spark).write.parquet(path)
    o = spark.read.parquet(path)
    snaps = scd2.snapshots(o, ATTRS)
    dim = scd2.build(snaps, ATTRS)
    p = plan(dim)
    for line in p[p.rindex("Exchange hashpartitioning"):].splitlines()[1:]:
        assert "attribute_hash" not in line  # below the lowest exchange
    # the state chosen is the one of the smallest hash, a version opens where the hash changes
    whole = scd2.snapshots_raw(o, ATTRS)
    least = {(r[0], r[1]): r[2] for r in whole.groupBy("reseller_cnpj", "collection_date").agg(F.min("attribute_hash")).collect()}
    assert {(r[0], r[1]): r.attribute_hash for r in snaps.collect()} == least
    plain = scd2.versions_from_changes(scd2.changes(snaps), ATTRS)
    d = compare.symmetric_diff(dim, plain, dim.columns, multiset=True).first()
    assert (d.only_in_left, d.only_in_right) == (0, 0) and dim.count()
    again = scd2.restored(scd2.stored(dim), ATTRS)
    d = compare.symmetric_diff(dim, again, dim.columns, multiset=True).first()
    assert again.columns == dim.columns and (d.only_in_left, d.only_in_right) == (0, 0)


def test_literal_maps_shuffle_nothing(spark, scratch):
    path = scratch("obs")
    observed(spark).write.parquet(path)
    p = plan(scd2.canonicalise(spark.read.parquet(path), T.alias_map(spark)))
    assert "BroadcastHashJoin" in p and "hashpartitioning" not in p


def test_fact_joins_versions_by_their_natural_key(spark, scratch):
    path, products = scratch("obs"), spark.createDataFrame([("k0", "p0"), ("k1", "p1"), ("k2", "p2")], "product_key string, source_product_name string")
    observed(spark).withColumn("sale_price", F.col("sale_price").cast("decimal(10,3)")).withColumn("source_file", F.lit("f")).write.parquet(path)
    o = spark.read.parquet(path)
    dim = scd2.build(scd2.snapshots(o, ATTRS), ATTRS).withColumns({"state": F.lit("SP"), "city": F.col("name")})
    wide = facts.with_station_key(facts.build_stored(o, dim, products))
    narrow = wide.select(*facts.FACT_COLUMNS)
    assert facts.build(o, dim, products).columns == facts.FACT_COLUMNS
    by_natural, by_hash = (sorted(map(str, rollup.weekly_raw_keys(f, dim).collect())) for f in (wide, narrow))
    assert by_natural == by_hash and len(by_hash) > 10
    assert not any("station_key" in line for line in exchanges(rollup.weekly_raw_keys(wide, dim)))


def test_symmetric_diff_counts_rows_once_and_nulls_as_equal(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "z"), (None, "y")], "k int, v string")
    assert tuple(compare.symmetric_diff(a, b, ["k", "v"]).first()) == (1, 1)
    assert tuple(compare.symmetric_diff(a, b, ["k", "v"], multiset=True).first()) == (2, 1)
    assert tuple(compare.symmetric_diff(a.limit(0), b.limit(0), ["k", "v"], multiset=True).first()) == (0, 0)
    assert "SortMergeJoin" not in plan(compare.symmetric_diff(a, b, ["k", "v"]))


def test_duplicate_keys_are_counted_whole(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, None), (2, 2), (3, 3), (3, 3), (3, 3)], "a int, b int")
    assert checks.duplicate_key_count(df, ["a", "b"]).first()[0] == 2  # (1, null) and (null, 1) have one hash


def test_ranks_by_halving_count_the_bounds(spark):
    df = spark.range(0, 4000).select((F.col("id") % 50 * F.col("id") % 97).alias("a"), F.concat(F.lit("s"), (F.col("id") % 6).cast("string")).alias("b"))
    df = df.unionByName(spark.createDataFrame([(None, None)], df.schema))
    for c in ("a", "b"):
        found = df.select(F.col(c).alias("v"), tables.rank(df, c, 4).alias("r")).distinct().orderBy("v").collect()
        ranks = [r.r for r in found]
        assert ranks[0] == 0 and found[0].v is None and ranks == sorted(ranks) and 2 < ranks[-1] <= 15
        assert "lambda" not in plan(df.select(tables.rank(df, c, 4)))


def test_stored_dimension_holds_no_hashes(spark, scratch):
    o = observed(spark).where("reseller_cnpj < '9' and collection_date is not null")
    root, log = scratch("dim"), scratch("log")
    snaps = scd2.snapshots(o, ATTRS)
    dim = scd2.build(snaps, ATTRS)
    DS.seed(spark, dim, snaps, dt.date(2024, 1, 20), root, log, buckets=4)
    for part in ("data", "snapshots"):
        names = set(spark.read.parquet(f"{root}/{part}").columns)
        assert "name" in names and not names & {"station_key", "attribute_hash"}
    again = DS.version(spark, log, -1)
    d = compare.symmetric_diff(dim, again, dim.columns, multiset=True).first()
    assert again.columns == dim.columns and (d.only_in_left, d.only_in_right) == (0, 0)
    assert re.search("zstd", " ".join(again.inputFiles()))

"""Sorts and collections get tasks of a bounded number of rows, on rows of its own."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricegrid import session
from pricegrid.operators import compare, dedup, rollup, scd2
from pricegrid.streaming import dimension_stream as DS

ATTRS = ["name", "brand"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def observed(spark, scratch):
    d = dt.date(2024, 1, 1)
    rows = [(str(k), d + dt.timedelta(days=n), f"n{k}", "AB"[(n // 3 + k) % 2] if n % 5 else None, f"p{p % 2}", n + p) for k in range(4) for n in range(20) for p in range(4)]
    rows += [(None, d, "x", "A", "p0", 1), (None, d, "x", "B", "p0", 1), ("9", None, "x", "A", "p0", 1), ("9", None, None, "A", "p0", 1), ("9", d, "x", "A", "p0", 2)] * 2
    path = scratch("obs")
    spark.createDataFrame(rows, "reseller_cnpj string, collection_date date, name string, brand string, product string, sale_price int").write.parquet(path)
    return spark.read.parquet(path)


def same(a, b) -> bool:
    d = compare.symmetric_diff(a, b, b.columns, multiset=True).first()
    return a.columns == b.columns and tuple(d) == (0, 0)


@pytest.mark.parametrize("hot_rows", [None, 0, 5])  # no bucket of keys is hot, all are, some are
def test_first_of_groups_is_the_first(observed, hot_rows):
    key, order = ["reseller_cnpj", "collection_date"], ["sale_price", "product"]
    got = dedup.keep_first_of_groups(observed, key, order, hot_rows)
    assert same(got, dedup.keep_first(observed, key, order)) and got.count() > 80
    assert same(scd2.one_state(observed, ATTRS, hot_rows=hot_rows), scd2.one_state(observed, ATTRS))


def test_input_splits_are_sorted_only_for_hot_keys(observed):
    key = ["reseller_cnpj", "collection_date"]
    # the lowest operators: a scan and the exchange, no sort between them
    p = plan(dedup.keep_first_of_groups(observed, key, ["sale_price"]))
    assert "WindowGroupLimit" not in p[p.index("Exchange"):] and "Sort" not in p[p.index("Exchange"):]
    p = plan(scd2.one_state(observed, ATTRS))
    assert "Sort" not in p[p.index("Exchange"):] and "sha2" not in p[p.index("Exchange"):]
    p = plan(dedup.keep_first_of_groups(observed, key, ["sale_price"], hot_rows=0))
    assert p.count("WindowGroupLimit") > 2  # of hot keys, each map task ships one row


def test_many_rows_go_to_tasks_of_bounded_size(spark, observed, monkeypatch):
    snaps = scd2.snapshots(observed, ATTRS).where("reseller_cnpj < '9'").cache()
    dim = scd2.build(snaps, ATTRS)
    fact = scd2.as_of(observed.where("reseller_cnpj < '9'"), dim, carry=["valid_from"]).withColumn("product_key", F.col("product"))
    dim = dim.withColumns({"state": F.lit("SP"), "city": F.col("name")})
    fact = fact.withColumn("sale_price", F.col("sale_price").cast("decimal(10,3)")).drop(*ATTRS)
    raw = rollup.weekly_raw_keys(fact, dim)
    few = [(x, sorted(map(str, x.collect()))) for x in (dim, fact, raw)]
    assert "REPARTITION_BY_NUM" not in plan(few[0][0])
    monkeypatch.setattr(session, "TASK_ROWS", 10)  # 320 rows are many
    monkeypatch.setattr(type(spark.conf), "get", lambda self, k, *a, f=type(spark.conf).get: "50" if k == "spark.sql.shuffle.partitions" else f(self, k, *a))
    many_dim = scd2.build(snaps, ATTRS)
    many_fact = scd2.as_of(observed.where("reseller_cnpj < '9'"), many_dim, carry=["valid_from"]).withColumn("product_key", F.col("product"))
    many_dim = many_dim.withColumns({"state": F.lit("SP"), "city": F.col("name")})
    many_fact = many_fact.withColumn("sale_price", F.col("sale_price").cast("decimal(10,3)")).drop(*ATTRS)
    for x, (_, rows) in zip((many_dim, many_fact, rollup.weekly_raw_keys(many_fact, many_dim)), few):
        assert "REPARTITION_BY_NUM" in plan(x) and sorted(map(str, x.collect())) == rows and rows
    assert session.tasks_of(spark, 320) == 32 and session.tasks_of(spark, 10**9) == 50 and session.tasks_of(spark, 8) == 0


def test_undated_versions_meet_their_rows(spark):
    fact = spark.createDataFrame([("1", None, 5), ("1", dt.date(9999, 12, 31), 6), (None, None, 7)], "reseller_cnpj string, valid_from date, v int")
    dim = spark.createDataFrame([("1", None, "a"), ("1", dt.date(9999, 12, 31), "b"), (None, None, "c")], "reseller_cnpj string, valid_from date, state string")
    got = scd2.join_versions(fact, dim, ["state"])
    assert got.columns == ["reseller_cnpj", "valid_from", "v", "state"]
    assert sorted((r.v, r.state) for r in got.collect()) == [(5, "a"), (6, "b")]


def test_each_bucket_is_written_by_a_task_of_its_own(spark, observed, scratch):
    path = scratch("buckets")
    DS._write(scd2.snapshots(observed, ATTRS).drop(scd2.HASH), path, 3)
    written = spark.read.parquet(path)
    assert written.count() == scd2.snapshots(observed, ATTRS).count()
    files = [f.rsplit("/", 1)[1] for f in written.inputFiles()]
    assert len({f.split("-")[1] for f in files}) == len(files) > 1  # part-<task>-

"""Calendar, city key uniqueness, rollup month and edge semantics, comparisons."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricegrid.operators import checks, compare, dims, rollup


def test_calendar_iso_week_across_year(spark):
    d = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2025, 1, 5),)],
                              "collection_date date")
    cal = {r.full_date: r for r in dims.calendar(d).collect()}
    r = cal[dt.date(2024, 12, 30)]
    assert (r.survey_week_key, r.iso_year, r.iso_week) == (202501, 2025, 1)
    assert r.week_start_date == dt.date(2024, 12, 30)
    assert r.month_start_date == dt.date(2024, 12, 1) and r.day_of_week == 2
    assert min(cal) == dt.date(2024, 12, 30) and max(cal) == dt.date(2025, 1, 5)


def test_city_homonyms_and_key_check(spark):
    obs = spark.createDataFrame(
        [("Bonito", "MS", "CO", "1"), ("Bonito", "PE", "NE", "2"), ("Bonito", "PE", "NE", "3")],
        "city string, state string, region string, reseller_cnpj string")
    city = dims.city(obs)
    h = dims.homonyms(city).collect()
    assert [(r.city_name, r.ufs) for r in h] == [("Bonito", ["MS", "PE"])]
    checks.require_unique(city, ["city_key"], "dim_city")
    bad = obs.union(spark.createDataFrame([("Bonito", "PE", "N", "4")], obs.schema))
    with pytest.raises(checks.CheckFailed):
        checks.require_unique(dims.city(bad), ["city_key"], "dim_city")


def test_weekly_month_from_week_start_and_edges(spark):
    # week of 2024-07-29 crosses into August: one row, month = July
    fact = spark.createDataFrame(
        [(dt.date(2024, 7, 22), "s1", "p", 5.0), (dt.date(2024, 7, 30), "s1", "p", 6.0),
         (dt.date(2024, 8, 2), "s2", "p", 7.0), (dt.date(2024, 8, 6), "s2", "p", 8.0)],
        "collection_date date, station_key string, product_key string, sale_price double")
    station = spark.createDataFrame([("s1", "1", "SP", "X"), ("s2", "2", "SP", "X")],
                                    "station_key string, reseller_cnpj string, state string, city string")
    city = dims.city(station.withColumn("region", F.lit("SE")))
    cal = dims.calendar(fact)
    w = rollup.weekly(fact, station, city, cal).orderBy("week_start_date").collect()
    assert len(w) == 3
    mid = w[1]
    assert mid.week_start_date == dt.date(2024, 7, 29)
    assert mid.month_start_date == dt.date(2024, 7, 1)
    assert (mid.observations, mid.stations) == (2, 2)
    assert (mid.p10_price, mid.median_price, mid.p90_price) == pytest.approx((6.1, 6.5, 6.9))
    assert [r.is_edge_week for r in w] == [True, False, True]
    cov = {r.is_edge_week: r.pct_of_inner_median for r in rollup.edge_coverage(
        rollup.weekly(fact, station, city, cal)).collect()}
    assert cov == {False: 100.0, True: 50.0}


def test_compare_values_and_group_counts(spark):
    a = spark.createDataFrame([("k1", 1.0), ("k2", 2.0), ("k3", 3.0)], "k string, v double")
    b = spark.createDataFrame([("k1", 1.0), ("k2", 2.5), ("k4", 4.0)], "k string, v double")
    r = compare.values(a, b, ["k"], ["v"]).first()
    assert (r.compared_groups, r.divergent_groups, r.max_diff_v) == (4, 3, 0.5)
    g = {x.k: (x.n_left, x.n_right, x.differs)
         for x in compare.group_counts(a, b, ["k"]).collect()}
    assert g["k3"] == (1, 0, True) and g["k1"] == (1, 1, False)
    m = compare.missing_keys(a, b, ["k"]).first()
    assert (m.only_in_left, m.only_in_right) == (1, 1)


def test_large_groups_go_by_counts_and_give_the_same(spark, monkeypatch):
    """Groups over the limit (all, some or none of them) against the plain definition."""
    import statistics
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i % 9) for i in range(240)]
    rows = [(d, f"k{i % 7}", f"p{i % 2 if i % 5 else 0}", f"{(i * 37 % 101) / 10 + 1:.3f}") for i, d in enumerate(days)]
    fact = spark.createDataFrame(rows, "collection_date date, station_key string, product_key string, price string")
    fact = fact.withColumn("sale_price", F.col("price").cast("decimal(10,3)")).drop("price")
    dim = spark.createDataFrame([(f"k{i}", f"s{i % 4}", "SP", "A" if i < 5 else "B") for i in range(7)],
                                "station_key string, reseller_cnpj string, state string, city string")
    station = {r.station_key: r for r in dim.collect()}
    groups = {}
    for d, k, p, x in rows:
        key = (d - dt.timedelta(days=d.weekday()), station[k].city, p)
        groups.setdefault(key, []).append((float(x), station[k].reseller_cnpj))
    want = {}
    for key, found in groups.items():
        x = [v for v, _ in found]
        cuts = statistics.quantiles(x, n=10, method="inclusive") if len(x) > 1 else x * 9
        want[key] = (len(x), len({s for _, s in found}), *(round(cuts[i], 9) for i in (0, 4, 8)), min(x), max(x), round(sum(x) / len(x), 9))
    sizes = sorted(v[0] for v in want.values())
    assert sizes[0] < sizes[-1]
    for limit in (0, sizes[len(sizes) // 2], rollup.HOT_ROWS):
        monkeypatch.setattr(rollup, "HOT_ROWS", limit)
        got = {(r.week_start_date, r.city, r.product_key): (
            r.observations, r.stations, round(r.p10_price, 9), round(r.median_price, 9), round(r.p90_price, 9),
            float(r.min_price), float(r.max_price), round(r.avg_price, 9)) for r in rollup.weekly_raw_keys(fact, dim).collect()}
        assert got == want


def test_checksums_join_only_buckets_that_differ(spark):
    a = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("g"), (F.col("id") / 3).alias("x"))
    b = a.withColumn("x", F.when(F.col("k") == 77, F.col("x") + 1).otherwise(F.col("x"))).where("k <> 4000")
    left, right, equal = compare.differing(a, b, ["k", "g"], ["x"])
    assert 0 < left.count() <= 20 and right.count() == left.count() - 1 and equal + left.count() == 5000
    assert compare.values_by_checksum(a, b, ["k", "g"], ["x"]).first() == compare.values(a, b, ["k", "g"], ["x"]).first()
    assert compare.missing_keys_by_checksum(a, b, ["k", "g"]).first() == compare.missing_keys(a, b, ["k", "g"]).first()
    same = compare.values_by_checksum(a, a, ["k", "g"], ["x"]).first()
    assert (same.compared_groups, same.divergent_groups, same.max_diff_x) == (5000, 0, 0.0)
    none = a.limit(0)
    assert compare.values_by_checksum(a, none, ["k", "g"], ["x"]).first() == compare.values(a, none, ["k", "g"], ["x"]).first()

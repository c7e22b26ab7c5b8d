"""Versioned dimension: build semantics, as-of equivalences, incremental apply."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricegrid.operators import compare, scd2

ATTRS = ["name", "brand"]


def obs_df(spark, rows):
    return (spark.createDataFrame(rows, "reseller_cnpj string, d string, name string, brand string")
            .withColumn("collection_date", F.to_date("d")).drop("d"))


def test_aba_history_gives_three_versions(spark):
    o = obs_df(spark, [("1", "2024-01-01", "P", "A"), ("1", "2024-01-08", "P", "B"),
                       ("1", "2024-01-15", "P", "A"), ("1", "2024-01-22", "P", "A")])
    dim = scd2.build(scd2.snapshots(o, ATTRS), ATTRS).orderBy("valid_from").collect()
    assert [(str(r.valid_from), str(r.valid_to), r.is_current) for r in dim] == [
        ("2024-01-01", "2024-01-08", False), ("2024-01-08", "2024-01-15", False),
        ("2024-01-15", "9999-12-31", True)]
    assert dim[0].station_key != dim[2].station_key


def test_two_states_on_one_date_smallest_hash_wins(spark):
    o = obs_df(spark, [("1", "2024-01-01", "P", "A"), ("1", "2024-01-01", "P", "B")])
    raw = scd2.snapshots_raw(o, ATTRS)
    assert scd2.snapshot_conflicts(raw).first().states_on_day == 2
    snap = scd2.snapshots(o, ATTRS).collect()
    hashes = sorted(r.attribute_hash for r in raw.collect())
    assert len(snap) == 1 and snap[0].attribute_hash == hashes[0]


def test_null_and_empty_hash_alike(spark):
    o = obs_df(spark, [("1", "2024-01-01", None, "A"), ("1", "2024-01-02", "", "A")])
    dim = scd2.build(scd2.snapshots(o, ATTRS), ATTRS)
    assert dim.count() == 1  # parity: NULL and '' do not open a version


def random_obs(spark, n_keys=6, n_days=60, seed=7):
    import random
    rnd = random.Random(seed)
    rows = []
    base = dt.date(2024, 1, 1)
    for k in range(n_keys):
        for d in range(n_days):
            if rnd.random() < 0.6:
                rows.append((str(k), str(base + dt.timedelta(days=d)), "P",
                             rnd.choice(["A", "B", "C"]) if rnd.random() < 0.3 else "A"))
    return obs_df(spark, rows)


def test_as_of_forms_agree_with_range_join(spark):
    o = random_obs(spark)
    dim = scd2.build(scd2.snapshots(o, ATTRS), ATTRS)
    cols = ["reseller_cnpj", "collection_date", "station_key"]
    a = sorted(scd2.as_of(o, dim).select(cols).collect())
    b = sorted(scd2.as_of_range(o, dim).select(cols).collect())
    c = sorted(scd2.as_of_months(o, dim).select(cols).collect())
    assert a == b == c and len(a) == o.count()
    for name, df in [("single", scd2.check_single_current(dim)),
                     ("contiguous", scd2.check_contiguous(dim)),
                     ("coverage", scd2.check_coverage(o, dim))]:
        assert df.first()[0] == 0, name


@pytest.mark.parametrize("cut", ["2024-01-10", "2024-02-01", "2024-02-25"])
def test_incremental_equals_one_shot_for_any_cut(spark, cut):
    o = random_obs(spark, seed=11)
    snaps = scd2.snapshots(o, ATTRS)
    full = scd2.build(snaps, ATTRS)
    before = snaps.where(F.col("collection_date") < cut)
    base = scd2.build(before, ATTRS)
    hw = before.agg(F.max("collection_date")).first()[0]
    inc = scd2.apply_range(base, snaps.where(F.col("collection_date") >= cut), ATTRS,
                           high_water=F.lit(hw))
    cols = ["reseller_cnpj", "valid_from", "valid_to", "attribute_hash", "is_current",
            "station_key"]
    d = compare.symmetric_diff(full, inc, cols, multiset=True).first()
    assert (d.only_in_left, d.only_in_right) == (0, 0)


def test_apply_range_keeps_untouched_keys(spark):
    o = random_obs(spark, seed=3)
    snaps = scd2.snapshots(o, ATTRS)
    base = scd2.build(snaps.where("collection_date < '2024-02-01'"), ATTRS)
    later = snaps.where("collection_date >= '2024-02-01' AND reseller_cnpj IN ('1', '2')")
    inc = scd2.apply_range(base, later, ATTRS, high_water="2024-01-31")
    untouched = ["0", "3", "4", "5"]
    a = sorted(base.where(F.col("reseller_cnpj").isin(untouched)).collect())
    b = sorted(inc.where(F.col("reseller_cnpj").isin(untouched)).collect())
    assert a == b
    assert scd2.check_single_current(inc).first()[0] == 0
    assert scd2.check_contiguous(inc).first()[0] == 0


def test_late_snapshot_is_refused(spark):
    o = random_obs(spark, seed=5)
    snaps = scd2.snapshots(o, ATTRS)
    base = scd2.build(snaps.where("collection_date < '2024-02-01'"), ATTRS)
    late = snaps.where("collection_date >= '2024-01-20'")
    with pytest.raises(Exception, match="high-water"):
        scd2.apply_range(base, late, ATTRS, high_water="2024-01-31").count()
    with pytest.raises(Exception, match="high-water"):
        scd2.apply_batch(base, snaps.where("collection_date = '2024-01-20'"), ATTRS, "2024-01-31").count()
    with pytest.raises(TypeError):
        scd2.apply_range(base, late, ATTRS)  # the guard is not optional


def test_apply_batch_matches_rebuild_for_one_date(spark):
    o = random_obs(spark, seed=9)
    snaps = scd2.snapshots(o, ATTRS)
    base = scd2.build(snaps.where("collection_date < '2024-02-01'"), ATTRS)
    one = snaps.where("collection_date = '2024-02-01'")
    got = scd2.apply_batch(base, one, ATTRS, "2024-01-31")
    want = scd2.build(snaps.where("collection_date <= '2024-02-01'"), ATTRS)
    cols = ["reseller_cnpj", "valid_from", "valid_to", "attribute_hash", "is_current"]
    d = compare.symmetric_diff(want, got, cols).first()
    assert (d.only_in_left, d.only_in_right) == (0, 0)


def test_label_switches_need_predecessor(spark):
    o = obs_df(spark, [("1", "2024-01-01", "P", "A"), ("1", "2024-01-02", "Q", "A"),
                       ("1", "2024-01-03", "Q", "B"), ("2", "2024-01-01", "P", "B")])
    dim = scd2.build(scd2.snapshots(o, ATTRS), ATTRS)
    assert scd2.label_switches(dim).first()[0] == 1


def test_late_snapshots_rebuild_affected_keys(spark):
    o = random_obs(spark, seed=21)
    snaps = scd2.snapshots(o, ATTRS)
    # history up to Feb 1 was applied, but station 2 sends January days late
    applied = snaps.where("collection_date < '2024-02-01' AND NOT (reseller_cnpj = '2' "
                          "AND collection_date >= '2024-01-15')")
    dim = scd2.build(applied, ATTRS)
    late = snaps.where("reseller_cnpj = '2' AND collection_date >= '2024-01-15' "
                       "AND collection_date < '2024-02-01'")
    keys = scd2.late_keys(late, "2024-01-31")
    assert [r.reseller_cnpj for r in keys.collect()] == ["2"]
    fixed = scd2.rebuild_keys(dim, applied.unionByName(late), keys, ATTRS)
    want = scd2.build(snaps.where("collection_date < '2024-02-01'"), ATTRS)
    d = compare.symmetric_diff(want, fixed, want.columns, multiset=True).first()
    assert (d.only_in_left, d.only_in_right) == (0, 0)

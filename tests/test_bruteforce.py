"""Operators against brute-force Python definitions on small random fixtures."""

import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricegrid.operators import dedup, scd2

ATTRS = ["name", "brand"]
SETTINGS = dict(max_examples=15, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(
    st.tuples(st.integers(0, 3),                      # station
              st.integers(0, 20),                     # day offset
              st.sampled_from(["P", "Q"]),             # name
              st.sampled_from(["A", "B", None, ""]),  # brand (NULL and '' hash alike)
              st.integers(1, 5)),                     # price
    min_size=1, max_size=40)


def to_df(spark, rows):
    base = dt.date(2024, 1, 1)
    data = [(str(k), base + dt.timedelta(days=d), n, b, p) for k, d, n, b, p in rows]
    return spark.createDataFrame(
        data, "reseller_cnpj string, collection_date date, name string, brand string, price int")


def brute_keep_first(rows):
    best = {}
    for r in rows:
        k = (r[0], r[1])
        cand = (r[4], r[2], r[3] is not None, r[3] or "")   # price, name, brand (NULLs first)
        if k not in best or cand < best[k][0]:
            best[k] = (cand, r)
    return sorted((k[0], k[1], v[1][4], v[1][2]) for k, v in best.items())


@settings(**SETTINGS)
@given(rows_st)
def test_keep_first_matches_brute_force(spark, rows):
    df = to_df(spark, rows)
    key = ["reseller_cnpj", "collection_date"]
    kept = dedup.keep_first(df, key, ["price", "name"])
    disc = dedup.discarded(df, kept, key)
    got = sorted((int(r.reseller_cnpj), (r.collection_date - dt.date(2024, 1, 1)).days,
                  r.price, r.name) for r in kept.collect())
    assert got == brute_keep_first(rows)
    assert kept.count() + disc.count() == len(rows)
    assert kept.unionByName(disc).exceptAll(df).count() == 0


def _hash(name, brand):
    return hashlib.sha256(f"{name or ''}|{brand or ''}".encode()).hexdigest()


def brute_versions(rows):
    """Per station: one state per day (smallest hash, then attrs), a version
    at every change from the previous day's state, validity to the next one."""
    days = {}
    for k, d, n, b, _ in rows:
        cand = (_hash(n, b), n is not None, n or "", b is not None, b or "")
        if (k, d) not in days or cand < days[(k, d)]:
            days[(k, d)] = cand
    out = []
    for k in sorted({k for k, _ in days}):
        seq = sorted((d, days[(k, d)][0]) for kk, d in days if kk == k)
        starts = [(d, h) for i, (d, h) in enumerate(seq) if i == 0 or seq[i - 1][1] != h]
        for i, (d, h) in enumerate(starts):
            end = starts[i + 1][0] if i + 1 < len(starts) else None
            out.append((str(k), d, end, h))
    return sorted(out, key=lambda t: (t[0], t[1]))


@settings(**SETTINGS)
@given(rows_st)
def test_scd2_build_and_as_of_match_brute_force(spark, rows):
    df = to_df(spark, rows)
    dim = scd2.build(scd2.snapshots(df, ATTRS), ATTRS)
    base = dt.date(2024, 1, 1)
    got = sorted(((r.reseller_cnpj, (r.valid_from - base).days,
                   None if r.is_current else (r.valid_to - base).days, r.attribute_hash)
                  for r in dim.collect()), key=lambda t: (t[0], t[1]))
    assert got == brute_versions(rows)
    # every observation finds exactly one version, by either as-of form
    a = scd2.as_of(df, dim).count()
    b = scd2.as_of_range(df, dim).count()
    assert a == b == len(rows)
    assert scd2.check_contiguous(dim).first()[0] == 0


@settings(**SETTINGS)
@given(rows_st, st.integers(1, 19))
def test_incremental_matches_one_shot(spark, rows, cut_day):
    df = to_df(spark, rows)
    snaps = scd2.snapshots(df, ATTRS)
    cut = dt.date(2024, 1, 1) + dt.timedelta(days=cut_day)
    before = snaps.where(F.col("collection_date") < F.lit(cut))
    base = scd2.build(before, ATTRS)
    hw = before.agg(F.max("collection_date")).first()[0]
    later = snaps.where(F.col("collection_date") >= F.lit(cut))
    inc = scd2.apply_range(base, later, ATTRS, high_water=hw and F.lit(hw))
    cols = ["station_key", "valid_from", "valid_to", "attribute_hash", "is_current"]
    full = scd2.build(snaps, ATTRS)
    assert sorted(full.select(cols).collect()) == sorted(inc.select(cols).collect())

"""Dedup order, discards as a multiset, alias-map refusals, label transitions."""

import pytest
from pyspark.sql import functions as F

from pricegrid.operators import checks, dedup, labels


def test_keep_first_lowest_price_then_name_then_file(spark):
    rows = [("k1", 5.0, "B", "f2"), ("k1", 4.0, "Z", "f9"), ("k1", 4.0, "A", "f3"),
            ("k1", 4.0, "A", "f1"), ("k2", 7.0, "X", "f1"), ("k2", 7.0, "X", "f1")]
    df = spark.createDataFrame(rows, "k string, price double, name string, file string")
    kept = dedup.keep_first(df, ["k"], ["price", "name", "file"])
    disc = dedup.discarded(df, kept, ["k"])
    got = {r.k: (r.price, r.name, r.file) for r in kept.collect()}
    assert got == {"k1": (4.0, "A", "f1"), "k2": (7.0, "X", "f1")}
    # discards keep the duplicate copy of the winner
    assert disc.count() == 4
    assert disc.where("k = 'k2'").count() == 1


def test_keep_first_is_idempotent(spark):
    df = spark.createDataFrame([(i % 3, i % 5, str(i)) for i in range(40)], "k int, p int, v string")
    once = dedup.keep_first(df, ["k"], ["p"])
    twice = dedup.keep_first(once, ["k"], ["p"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_alias_chain_and_missing_target_raise(spark):
    data = spark.createDataFrame([("VIBRA",), ("ALE",)], "brand string")
    good = spark.createDataFrame([("VIBRA ENERGIA", "VIBRA", "r"), ("ALESAT", "ALE", "r")],
                                 "source_brand string, canonical_brand string, rationale string")
    labels.validate(good, data)
    chained = spark.createDataFrame([("A", "B", "r"), ("B", "VIBRA", "r")],
                                    "source_brand string, canonical_brand string, rationale string")
    with pytest.raises(checks.CheckFailed):
        labels.validate(chained, data.union(spark.createDataFrame([("B",)], "brand string")))
    missing = spark.createDataFrame([("X", "NOPE", "r")],
                                    "source_brand string, canonical_brand string, rationale string")
    with pytest.raises(checks.CheckFailed):
        labels.validate(missing, data)


def test_brand_dim_and_transitions(spark):
    obs = spark.createDataFrame(
        [("1", "2024-01-01", "VIBRA ENERGIA"), ("1", "2024-01-08", "VIBRA"),
         ("2", "2024-01-01", "BRANCA"), ("2", "2024-01-08", "VIBRA")],
        "reseller_cnpj string, d string, brand string").withColumn(
        "collection_date", F.to_date("d"))
    alias = spark.createDataFrame([("VIBRA ENERGIA", "VIBRA", "r")],
                                  "source_brand string, canonical_brand string, rationale string")
    bd = {r.brand_name: (r.stations, r.is_unbranded)
          for r in labels.brand_dim(obs, alias).collect()}
    assert bd == {"VIBRA": (2, False), "BRANCA": (1, True)}
    tr = {(r.from_label, r.to_label): (r.events, r.dates, r.stations)
          for r in labels.transitions(obs).collect()}
    assert tr == {("VIBRA ENERGIA", "VIBRA"): (1, 1, 1), ("BRANCA", "VIBRA"): (1, 1, 1)}


def test_discards_by_identity_equal_multiset_difference(spark):
    rows = [(i, i % 4, (i * 7) % 5, f"n{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, k int, price int, name string")
    kept = dedup.keep_first(df, ["k"], ["price", "name"])
    a = sorted(dedup.discarded(df, kept, ["k"]).collect())
    b = sorted(dedup.discarded(df, kept, ["k"], identity=["id"]).collect())
    assert a == b and len(a) == 56

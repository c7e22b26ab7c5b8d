"""Comparing two builds of the same table.

Both inputs are ordinary DataFrames, so the second side may come from Parquet,
another build of this package, or a JDBC read of another database.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrid.operators import scd2
from pricegrid.operators.checks import count_of
from pricegrid.session import cut_lineage

BUCKETS = 4096  # of key hashes, at most so many rows reach the driver


def _counts_row(left_name: str, left: DataFrame, right_name: str, right: DataFrame) -> DataFrame:
    base = left.agg(F.count(F.lit(1)).alias(left_name))
    return base.select(left_name, count_of(right).alias(right_name))


def symmetric_diff(a: DataFrame, b: DataFrame, cols: Sequence[str],
                   multiset: bool = False) -> DataFrame:
    """Rows of a not in b and of b not in a on ``cols`` (EXCEPT both ways).
    ``multiset`` counts repeated rows too (EXCEPT ALL)."""
    # one exchange for both directions: each row counted on both sides
    sides = (x.select(*cols, F.lit(int(one)).alias("_l"), F.lit(int(not one)).alias("_r")) for x, one in ((a, True), (b, False)))
    counted = next(sides).unionByName(next(sides)).groupBy(*cols).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    l, r = F.col("_l"), F.col("_r")
    if multiset:
        only = [F.coalesce(F.sum(F.greatest(x - y, F.lit(0))), F.lit(0)) for x, y in ((l, r), (r, l))]
    else:
        only = [F.count_if((x > 0) & (y == 0)) for x, y in ((l, r), (r, l))]
    return counted.agg(only[0].alias("only_in_left"), only[1].alias("only_in_right"))


def missing_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present on one side only, both directions (left anti joins)."""
    ka, kb = a.select(*keys), b.select(*keys)
    return _counts_row("only_in_left", ka.join(kb, list(keys), "left_anti"),
                       "only_in_right", kb.join(ka, list(keys), "left_anti"))


def group_counts(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts per key on both sides (full outer), with a difference flag."""
    ca = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_left"))
    cb = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_right"))
    j = ca.join(cb, list(keys), "full")
    nl, nr = F.coalesce("n_left", F.lit(0)), F.coalesce("n_right", F.lit(0))
    return j.select(*keys, nl.alias("n_left"), nr.alias("n_right"), (nl != nr).alias("differs"))


def values(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str],
           tol: float = 1e-6) -> DataFrame:
    """Value comparison with tolerance on a full outer join of ``keys``.

    One row: groups compared, groups divergent (present on one side only or
    any |diff| > tol) and the largest |diff| per column (rounded to 6 places).
    """
    la = a.select(*keys, *[F.col(c).cast("double").alias(f"_l_{c}") for c in cols],
                  F.lit(True).alias("_in_l"))
    rb = b.select(*keys, *[F.col(c).cast("double").alias(f"_r_{c}") for c in cols],
                  F.lit(True).alias("_in_r"))
    j = la.join(rb, list(keys), "full")
    diffs = {c: F.abs(F.col(f"_l_{c}") - F.col(f"_r_{c}")) for c in cols}
    one_side = F.col("_in_l").isNull() | F.col("_in_r").isNull()
    off = one_side
    for d in diffs.values():
        off = off | F.coalesce(d > tol, F.lit(False))
    return j.agg(
        F.count(F.lit(1)).alias("compared_groups"),
        F.count_if(off).alias("divergent_groups"),
        *[F.round(F.coalesce(F.max(d), F.lit(0.0)), 6).alias(f"max_diff_{c}")
          for c, d in diffs.items()],
    )


# ---------------------------------------------------------------- by checksums first

def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def _checksums(df: DataFrame, keys: Sequence[str], cols: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, n, mark) for each bucket of keys: the rows and an order-free checksum of
    their keys and columns, combined before the shuffle."""
    row = F.xxhash64(*keys, *cols)
    mark = F.struct(F.bit_xor(row).alias("x"), F.sum(row.cast("decimal(38,0)")).alias("s"))
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), mark.alias("mark"))


def differing(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str] = (), buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame, int]:
    """The rows of both sides in the buckets whose checksums differ, and how many rows the
    others hold (on either side). Two buckets that differ have one checksum with a chance of
    about 2**-64."""
    a, b = a.select(*keys, *cols), b.select(*keys, *cols)
    one, two = (_checksums(x, keys, cols, buckets).select("bucket", F.col("n").alias(f"n_{s}"), F.col("mark").alias(f"mark_{s}"))
                for x, s in ((a, "a"), (b, "b")))
    marks = cut_lineage(one.join(two, "bucket", "full"), "checksums")
    same = F.col("n_a").eqNullSafe(F.col("n_b")) & F.col("mark_a").eqNullSafe(F.col("mark_b"))
    open_ = [r["bucket"] for r in marks.where(~same).select("bucket").collect()]
    equal = marks.where(same).agg(F.coalesce(F.sum("n_a"), F.lit(0))).first()[0]
    inside = _bucket(keys, buckets).isin(open_) if open_ else F.lit(False)
    return a.where(inside), b.where(inside), equal


def symmetric_diff_by_checksum(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str], multiset: bool = False,
                               buckets: int = BUCKETS) -> DataFrame:
    """``symmetric_diff`` on ``keys`` and ``cols``, comparing row by row only in buckets of
    keys whose checksums differ."""
    left, right, _ = differing(a, b, keys, cols, buckets)
    return symmetric_diff(left, right, [*keys, *cols], multiset)


def missing_keys_by_checksum(a: DataFrame, b: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``missing_keys``, joining only buckets of keys whose checksums differ."""
    left, right, _ = differing(a, b, keys, buckets=buckets)
    return missing_keys(left, right, keys)


def values_by_checksum(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str], tol: float = 1e-6,
                       buckets: int = BUCKETS) -> DataFrame:
    """``values``, joining only buckets of keys whose checksums differ; the rows of the
    others are equal and count as compared. Keys must be unique on each side."""
    a, b = (x.select(*keys, *(F.col(c).cast("double").alias(c) for c in cols)) for x in (a, b))
    left, right, equal = differing(a, b, keys, cols, buckets)
    found = values(left, right, keys, cols, tol)
    return found.withColumn("compared_groups", F.col("compared_groups") + F.lit(equal).cast("long"))


def percentiles_by_rank(fact: DataFrame, dim_station: DataFrame,
                        pcts=(("p10_price", 0.1), ("median_price", 0.5))) -> DataFrame:
    """A second, independent exact-percentile implementation for ``values``.

    Prices are first counted per (group, price) (combined map-side), then a
    running count over the distinct prices of a group locates the two order
    statistics around (N-1)p and interpolates linearly. The window holds one
    row per distinct price of a group, never one per observation.
    """
    keys = ["week_start_date", "state", "city", "product_key"]
    e = (scd2.join_versions(fact, dim_station, ["state", "city"])
         .withColumn("week_start_date", F.date_trunc("week", "collection_date").cast("date")))
    c = e.groupBy(*keys, "sale_price").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy("sale_price")
    c = (c.withColumn("cum", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("total", F.sum("n").over(Window.partitionBy(*keys))))
    aggs = []
    for name, p in pcts:
        pos = (F.col("total") - 1) * F.lit(p)
        lo, hi = F.floor(pos), F.ceil(pos)
        price = F.col("sale_price").cast("double")
        aggs += [F.min(F.when(F.col("cum") > lo, price)).alias(f"_lo_{name}"),
                 F.min(F.when(F.col("cum") > hi, price)).alias(f"_hi_{name}"),
                 F.max(pos - lo).alias(f"_f_{name}")]
    g = c.groupBy(*keys).agg(*aggs)
    return g.select(*keys, *[
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n)
        for n, _ in pcts])

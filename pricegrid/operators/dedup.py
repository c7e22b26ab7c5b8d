"""Deterministic dedup on a natural key.

keep_first picks, per key, the row that sorts first on ``order`` (ascending,
NULLs first, as a Spark row_number would); discarded gives the other rows.

Plan shape, chosen for skew: the winner is ``row_number() = 1``, which Spark
limits to one row per key inside each map task before the shuffle
(WindowGroupLimit), so a key holding a third of the data ships one row per
task. Discards touch only keys seen more than once: the repeated keys come
from a map-side combined count, the few rows that have them are semi-joined
(AQE splits a hot key), and the winners are taken off by an anti-join or a
map-side combined multiset difference. No task holds a whole key group.

That limit sorts each input split. ``keep_first_of_groups`` limits only keys that may be
hot, by exact counts first; of all others a key's rows meet in a task of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrid.session import dealt_to

HOT_ROWS = 1 << 20  # of a bucket of keys, sorted in one task
HOT_BUCKETS = 1 << 16  # of key hashes, counted to find hot keys


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``.

    The order is total without any extra column: after ``order`` the whole
    row decides, column by column, so rows equal on ``order`` but different
    elsewhere are still chosen reproducibly (and fully identical rows are
    interchangeable).
    """
    rest = [c for c in df.columns if c not in {*key, *order}]
    w = Window.partitionBy(*key).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def split_hot(df: DataFrame, key: Sequence[str], hot_rows: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``df`` in two: the rows of keys that can't have more than ``hot_rows`` rows, dealt by
    key to tasks of bounded size, and those of the others, None if there are none. Rows are
    counted by buckets of key hashes; all rows of a key are in one bucket."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(HOT_BUCKETS))
    counts = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    full = F.col("n") > (HOT_ROWS if hot_rows is None else hot_rows)
    rows, hot = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.collect_list(F.when(full, F.col("b")))).first()  # at most HOT_BUCKETS numbers
    inside = bucket.isin(hot) if hot else F.lit(False)
    cold = df.where(~inside) if hot else df
    n = dealt_to(df.sparkSession, rows)
    return cold.repartition(n, *key) if n else cold.repartition(*key), df.where(inside) if hot else None


def keep_first_of_groups(df: DataFrame, key: Sequence[str], order: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """``keep_first`` where most keys have few rows: limiting them before the shuffle saves
    little and sorts whole input splits, which spills. Rows are dealt by key first; only keys
    that may have more than ``hot_rows`` rows are limited in the map tasks."""
    cold, hot = split_hot(df, key, hot_rows)
    kept = keep_first(cold, key, order)
    return kept if hot is None else kept.unionByName(keep_first(hot, key, order))


def _of_repeated_keys(df: DataFrame, repeated: DataFrame, key: Sequence[str]) -> DataFrame:
    r = repeated.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)])
    same = reduce(and_, [df[c].eqNullSafe(r[f"_k{i}"]) for i, c in enumerate(key)])
    return df.join(r, same, "left_semi")


def discarded(df: DataFrame, kept: DataFrame, key: Sequence[str],
              identity: Sequence[str] | None = None) -> DataFrame:
    """Every row of ``df`` not chosen, duplicates of the winner included.

    Only rows whose key occurs more than once are looked at. With a unique row
    ``identity`` the winners go by an anti-join on it; without one they go by
    the multiset difference of those rows.
    """
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    rows = _of_repeated_keys(df, repeated, key)
    if identity:
        return rows.join(kept.select(*identity), list(identity), "left_anti")
    return rows.exceptAll(_of_repeated_keys(kept.select(*df.columns), repeated, key))


def key_conflicts(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Keys seen more than once, with how far their values diverge."""
    return (
        df.groupBy(*key)
        .agg(
            F.count(F.lit(1)).alias("occurrences"),
            F.count_distinct(value).alias("distinct_prices"),
            F.min(value).alias("min_price"),
            F.max(value).alias("max_price"),
        )
        .where(F.col("occurrences") > 1)
    )


def key_conflict_summary(conflicts: DataFrame) -> DataFrame:
    return conflicts.agg(
        F.count(F.lit(1)).alias("repeated_keys"),
        F.coalesce(F.sum("occurrences") - F.count(F.lit(1)), F.lit(0)).alias("surplus_rows"),
        F.count_if(F.col("distinct_prices") > 1).alias("divergent_keys"),
    )

"""Invariant checks: each returns a small DataFrame and ``require`` raises.

All of them are aggregates over whole tables; nothing is collected except the
final one-row result when a caller asks to enforce it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_of(df: DataFrame):
    """Row count of ``df`` as a scalar-subquery Column."""
    return df.agg(F.count(F.lit(1))).scalar()


def reconcile(**named: DataFrame) -> DataFrame:
    """One row of named counts, e.g. reconcile(bronze=b, rejects=r, clean=c).

    The first count is an ordinary global aggregate; the others ride on it as
    scalar subqueries, so no join between the inputs is planned.
    """
    (first_name, first), *rest = named.items()
    base = first.agg(F.count(F.lit(1)).alias(first_name))
    return base.select(first_name, *[count_of(df).alias(n) for n, df in rest])


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys present more than once, with their count."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def duplicate_key_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many keys occur more than once. The keys' 64-bit hashes are counted first; only
    rows whose hash occurs again are compared by their whole keys."""
    mark = F.xxhash64(*key)
    again = df.groupBy(mark.alias("_mark")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_mark")
    rows = df.select(*key, mark.alias("_mark")).join(again, "_mark", "left_semi")
    return duplicate_keys(rows, key).agg(F.count(F.lit(1)).alias("duplicate_keys"))


class CheckFailed(AssertionError):
    pass


def require_empty(df: DataFrame, what: str, sample: int = 20) -> None:
    """Raise when ``df`` has rows; shows at most ``sample`` of them."""
    rows = df.take(sample)
    if rows:
        raise CheckFailed(f"{what}: {rows}")


def require_zero(df: DataFrame, what: str) -> None:
    """Raise when any column of the one-row ``df`` is not 0."""
    row = df.first()
    bad = {k: v for k, v in row.asDict().items() if v}
    if bad:
        raise CheckFailed(f"{what}: {bad}")


def require_unique(df: DataFrame, key: Sequence[str], what: str) -> None:
    require_empty(duplicate_keys(df, key), f"{what}: key {list(key)} not unique")

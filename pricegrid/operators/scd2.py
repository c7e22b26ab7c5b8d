"""Type-2 versioned dimension: one-shot build, as-of lookup, incremental apply.

Shapes and why they hold at scale:

* Snapshots are one row per (key, date): ``row_number() = 1`` by hash. Pairs that may
  have more than ``dedup.HOT_ROWS`` rows, found by counts first, are limited to one row in
  each map task before the shuffle; all others are dealt by pair and sorted behind it.
* Sorts get tasks of about ``session.TASK_ROWS`` rows: AQE joins partitions by their
  compressed bytes, and versions compress so well that such tasks spilled.
* All windows (change detection, validity end, switches, contiguity) are
  partitioned by the key alone and run on snapshots or versions, whose count
  per key is bounded by the number of distinct dates, not by observations.
* The as-of join never pairs every observation with every version of its
  key: observations and version starts are sorted together per key and the last
  start wins. Of a key with more than ``HOT_ROWS`` observations only the distinct
  (key, date) pairs are sorted, and equi-joined back on (key, date).
* Hashes are functions of narrow columns: the station key of (key, valid_from), the
  attribute hash of the attributes. Exchanges and stored tables (``stored``,
  ``restored``) hold those columns, the hashes are computed behind them.
* The incremental apply is one pass for any number of dates: work is
  proportional to the keys touched, with no per-date loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrid import constants as K
from pricegrid.functions.keys import attribute_hash, attribute_state, version_key
from pricegrid.operators import dedup
from pricegrid.session import cut_lineage, spread

KEY = "reseller_cnpj"
DATE = "collection_date"
HASH = "attribute_hash"
HOT_ROWS = 1 << 22  # observations of one key, sorted in one task


def _open_end():
    return F.lit(K.OPEN_END).cast("date")


# ---------------------------------------------------------------- labels / snapshots

def canonicalise(df: DataFrame, aliases: DataFrame, col: str = "brand") -> DataFrame:
    """Replace a label by its canonical form where the alias map has one. AQE
    broadcasts the map when its measured bytes allow it."""
    a = aliases.select(F.col("source_brand").alias("_src"),
                       F.col("canonical_brand").alias("_canon"))
    out = df.join(a, df[col] == a["_src"], "left")
    return out.select(*[F.coalesce("_canon", col).alias(col) if c == col else F.col(c)
                        for c in df.columns])


def snapshots_raw(obs: DataFrame, attrs: Sequence[str], key: str = KEY,
                  date: str = DATE) -> DataFrame:
    """Distinct attribute states per (key, date), with their hash."""
    return obs.select(key, date, *attrs, attribute_hash(attrs).alias(HASH)).distinct()


def snapshot_conflicts(raw: DataFrame, key: str = KEY, date: str = DATE) -> DataFrame:
    """(key, date) pairs that show more than one attribute state."""
    return (raw.groupBy(key, date).agg(F.count(F.lit(1)).alias("states_on_day"))
            .where(F.col("states_on_day") > 1))


def one_state(raw: DataFrame, attrs: Sequence[str], key: str = KEY,
              date: str = DATE, hot_rows: int | None = None) -> DataFrame:
    """One of the states per (key, date), with its hash: the smallest hash wins; equal
    hashes (NULL vs '') fall back to the attribute values so the choice is total. The
    first 128 bits of the hashes are compared, so that no whole hash is shuffled; states
    are told apart by them as surely as by the hash itself. Rows are dealt by (key, date)
    first and hashed there; only pairs that may be hot are limited in the map tasks."""
    mark = F.unhex(F.substring(attribute_hash(attrs), 1, 32))
    w = Window.partitionBy(key, date).orderBy("_mark", *attrs)

    def first(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_mark", mark).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(key, date, *attrs)

    cold, hot = dedup.split_hot(raw.select(key, date, *attrs), [key, date], hot_rows)
    states = first(cold) if hot is None else first(cold).unionByName(first(hot))
    return states.withColumn(HASH, attribute_hash(attrs))


def snapshots(obs: DataFrame, attrs: Sequence[str], key: str = KEY,
              date: str = DATE) -> DataFrame:
    """One attribute state per (key, date) of observations, with its hash."""
    return one_state(obs, attrs, key, date)


# ---------------------------------------------------------------- one-shot build

def changes(snaps: DataFrame, key: str = KEY, date: str = DATE) -> DataFrame:
    """Snapshots whose hash differs from the previous snapshot of the key."""
    w = Window.partitionBy(key).orderBy(date)
    prev = F.lag(HASH).over(w)
    return (snaps.withColumn("_prev", prev)
            .where(F.col("_prev").isNull() | (F.col("_prev") != F.col(HASH)))
            .drop("_prev"))


def versions_from_changes(ch: DataFrame, attrs: Sequence[str], key: str = KEY,
                          date: str = DATE) -> DataFrame:
    w = Window.partitionBy(key).orderBy(date)
    nxt = F.lead(date).over(w)
    return (ch.withColumn("_next", nxt)
            .select(version_key(key, date).alias("station_key"), key, *attrs, HASH,
                    F.col(date).alias("valid_from"),
                    F.coalesce("_next", _open_end()).alias("valid_to"),
                    F.col("_next").isNull().alias("is_current")))


def build(snaps: DataFrame, attrs: Sequence[str], key: str = KEY,
          date: str = DATE, rows: int | None = None) -> DataFrame:
    """Versions with half-open validity [valid_from, valid_to); the current one
    ends at 9999-12-31. lag and lead share one exchange on ``key``, which the attributes
    cross without their hash: the values it is made of are compared instead (``changes``
    compares hashes). ``rows``, counted if not given, sets the number of tasks."""
    w = Window.partitionBy(key).orderBy(date)
    before = [f"_before{i}" for i in range(len(attrs))]
    dealt = spread(snaps.select(key, date, *attrs), snaps.count() if rows is None else rows, key)
    states = dealt.select(key, date, *attrs, F.lag(F.lit(True)).over(w).alias("_prev"),
                          *[F.lag(a).over(w).alias(b) for a, b in zip(attrs, before)])
    changed = F.col("_prev").isNull() | (attribute_state(before) != attribute_state(attrs))
    ch = states.where(changed).select(key, date, *attrs, attribute_hash(attrs).alias(HASH))
    return versions_from_changes(ch, attrs, key, date)


def stored(dim: DataFrame) -> DataFrame:
    """A dimension without the columns that ``restored`` computes again."""
    return dim.drop("station_key", HASH)


def restored(rows: DataFrame, attrs: Sequence[str], key: str = KEY) -> DataFrame:
    """The dimension of ``stored`` rows, its hashes computed where they are read."""
    return rows.select(version_key(key, "valid_from").alias("station_key"), key, *attrs,
                       attribute_hash(attrs).alias(HASH), "valid_from", "valid_to", "is_current")


def join_versions(fact: DataFrame, dim: DataFrame, cols: Sequence, key: str = KEY) -> DataFrame:
    """``fact`` rows with ``cols`` of their station version. Where the fact holds the natural
    key of its version (key, valid_from), that is joined on, not its hash, the station key."""
    if not {key, "valid_from"} <= {*fact.columns} or "valid_from" not in dim.columns:
        return fact.join(dim.select("station_key", key, *cols), "station_key")
    start, undated = F.coalesce("valid_from", _open_end()), F.col("valid_from").isNull()
    n = fact.count()
    f = spread(fact.withColumns({"_fs": start, "_fn": undated}), n, key, "_fs", "_fn")
    d = spread(dim.select(F.col(key).alias("_vk"), start.alias("_vs"), undated.alias("_vn"), *cols), n, "_vk", "_vs", "_vn")
    return f.join(d, (f[key] == d["_vk"]) & (f["_fs"] == d["_vs"]) & (f["_fn"] == d["_vn"])).drop("_vk", "_fs", "_vs", "_fn", "_vn")


def profile(dim: DataFrame, key: str = KEY, label: str = "brand") -> DataFrame:
    return dim.agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_distinct(key).alias("stations"),
        F.count_distinct(label).alias("labels"),
        F.count_if("is_current").alias("current_versions"),
        F.min("valid_from").alias("first_valid_from"),
        F.max("valid_from").alias("last_valid_from"),
    )


# ---------------------------------------------------------------- as-of lookup

def _month(c):
    return F.year(c) * 12 + F.month(c) - 1


def resolve_pairs(pairs: DataFrame, dim: DataFrame, carry: Sequence[str],
                  key: str = KEY, date: str = DATE, how: str = "inner") -> DataFrame:
    """(key, date) pairs -> version(s) in force, by month bucket.

    A version is replicated into every month it covers, capped at the last
    pair date (a scalar subquery), so the equi-join is on (key, month) and
    the range test only compares rows of one key-month. Replication is at
    most versions + keys x months.
    """
    last = pairs.agg(F.max(date)).scalar()
    end = F.least(F.date_sub(F.col("valid_to"), 1), last)
    months = F.when(end >= F.col("valid_from"),
                    F.sequence(_month(F.col("valid_from")), _month(end)))
    ver = (dim.select(F.col(key).alias("_vk"), "valid_from", "valid_to", *carry)
           .withColumn("_m", F.explode(months)))
    p = pairs.withColumn("_pm", _month(F.col(date)))
    cond = ((p[key] == ver["_vk"]) & (p["_pm"] == ver["_m"])
            & (p[date] >= ver["valid_from"]) & (p[date] < ver["valid_to"]))
    return p.join(ver, cond, how).select(key, date, "valid_from", "valid_to", *carry)


def as_of_months(obs: DataFrame, dim: DataFrame, carry: Sequence[str] = ("station_key",),
          key: str = KEY, date: str = DATE, how: str = "inner") -> DataFrame:
    """The as-of lookup by month buckets: same rows as ``obs JOIN dim ON key AND
    date >= valid_from AND date < valid_to``, duplicates included if the
    dimension overlaps; per-key cost is pairs x versions-per-month."""
    carry = list(carry)
    pairs = obs.select(key, date).distinct()
    resolved = resolve_pairs(pairs, dim, carry, key, date, how="inner")
    resolved = resolved.select(key, date, *carry)
    return obs.join(resolved, [key, date], how)


def as_of_range(obs: DataFrame, dim: DataFrame, carry: Sequence[str] = ("station_key",),
                key: str = KEY, date: str = DATE, how: str = "inner") -> DataFrame:
    """Direct interval join (equi key + range residual), kept as the plain
    definition the faster forms are tested against."""
    d = dim.select(F.col(key).alias("_dk"), "valid_from", "valid_to", *carry)
    cond = (obs[key] == d["_dk"]) & (obs[date] >= d["valid_from"]) & (obs[date] < d["valid_to"])
    return obs.join(d, cond, how).drop("_dk", "valid_from", "valid_to")


def _as_of_rows(obs: DataFrame, versions: DataFrame, carry: Sequence[str], key: str, date: str, n: int) -> DataFrame:
    """Every row of ``obs``, about ``n``, sorted among the version starts of its key, in one
    exchange."""
    rest = [c for c in obs.columns if c not in (key, date)]
    v = versions.withColumn("_row", F.lit(None).cast(obs.select(F.struct(*rest).alias("_row")).schema["_row"].dataType) if rest else F.lit(None))
    o = obs.select(key, date, F.lit(None).cast(versions.schema["_v"].dataType).alias("_v"), F.lit(1).alias("_side"),
                   (F.struct(*rest) if rest else F.lit(None)).alias("_row"))
    w = (Window.partitionBy(key).orderBy(date, "_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = spread(v.unionByName(o.where(F.col(key).isNotNull())), n, key).withColumn("_cur", F.last("_v", ignorenulls=True).over(w))
    return (u.where((F.col("_side") == 1) & (F.col(date) < F.col("_cur._to")))
            .select(key, date, *[F.col(f"_row.{c}").alias(c) for c in rest],
                    *[F.col(f"_cur.{c}").alias(c) for c in carry]))


def _as_of_pairs(obs: DataFrame, versions: DataFrame, carry: Sequence[str], key: str, date: str, n: int) -> DataFrame:
    """The distinct (key, date) pairs sorted among the version starts, joined back."""
    resolved = _as_of_rows(obs.select(key, date).distinct(), versions, carry, key, date, n)
    return obs.join(resolved, [key, date], "inner")


def as_of(obs: DataFrame, dim: DataFrame, carry: Sequence[str] = ("station_key",),
                key: str = KEY, date: str = DATE, hot_rows: int | None = None) -> DataFrame:
    """Each observation with the version in force on its date.

    Union + window: versions and observations sorted per key, the last version start at
    or before each observation wins: one exchange. Keys of more than ``hot_rows``
    observations go by their distinct dates and a join back, so no task sorts all
    observations of a hot key. Equal to the interval join on a valid (contiguous,
    non-overlapping) dimension."""
    carry = list(carry)
    limit = HOT_ROWS if hot_rows is None else hot_rows
    versions = dim.select(key, F.col("valid_from").alias(date),
                          F.struct(F.col("valid_to").alias("_to"), *[F.col(c) for c in carry]).alias("_v"),
                          F.lit(0).alias("_side"))
    counts = obs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    n, most = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    if most <= limit:
        return _as_of_rows(obs, versions, carry, key, date, n)
    hot = cut_lineage(counts.where(F.col("_n") > limit).select(key), "hot-keys")
    cold, warm = ([x.join(hot, key, how) for x in (obs, versions)] for how in ("left_anti", "left_semi"))
    return _as_of_rows(*cold, carry, key, date, n).unionByName(_as_of_pairs(*warm, carry, key, date, n))


# ---------------------------------------------------------------- invariants

def check_single_current(dim: DataFrame, key: str = KEY) -> DataFrame:
    bad = dim.groupBy(key).agg(F.count_if("is_current").alias("n")).where(F.col("n") != 1)
    return bad.agg(F.count(F.lit(1)).alias("stations_violating"))


def check_contiguous(dim: DataFrame, key: str = KEY) -> DataFrame:
    w = Window.partitionBy(key).orderBy("valid_from")
    nxt = F.lead("valid_from").over(w)
    gaps = dim.select("valid_to", nxt.alias("_n")).where(
        F.col("_n").isNotNull() & (F.col("_n") != F.col("valid_to")))
    return gaps.agg(F.count(F.lit(1)).alias("intervals_violating"))


def check_coverage(obs: DataFrame, dim: DataFrame, key: str = KEY,
                   date: str = DATE) -> DataFrame:
    """(key, date) pairs of observations without exactly one version."""
    pairs = obs.select(key, date).distinct()
    res = resolve_pairs(pairs, dim, ["station_key"], key, date, how="left")
    bad = (res.groupBy(key, date).agg(F.count_distinct("station_key").alias("n"))
           .where(F.col("n") != 1))
    return bad.agg(F.count(F.lit(1)).alias("pairs_violating"))


def label_switches(dim: DataFrame, key: str = KEY, label: str = "brand") -> DataFrame:
    """Version changes where the label differs (NULL-safe) from the previous one."""
    w = Window.partitionBy(key).orderBy("valid_from")
    prev = F.lag(label).over(w)
    sw = dim.select(F.col(label), prev.alias("_p")).where(
        F.col("_p").isNotNull() & ~F.col(label).eqNullSafe(F.col("_p")))
    return sw.agg(F.count(F.lit(1)).alias("label_switches"))


# ---------------------------------------------------------------- incremental

def batches(snaps: DataFrame, after: str, date: str = DATE) -> DataFrame:
    """Distinct dates still to apply, ascending."""
    return (snaps.where(F.col(date) >= F.lit(after).cast("date"))
            .select(date).distinct().orderBy(date))


def changed_rows(dim: DataFrame, batch: DataFrame, key: str = KEY) -> DataFrame:
    """Batch snapshots of new keys or whose hash differs from the current version."""
    cur = dim.where("is_current").select(F.col(key).alias("_ck"), F.col(HASH).alias("_ch"))
    j = batch.join(cur, batch[key] == cur["_ck"], "left")
    return (j.where(F.col("_ck").isNull() | (F.col("_ch") != F.col(HASH)))
            .drop("_ck", "_ch"))


def _not_late(snaps: DataFrame, high_water, date: str) -> DataFrame:
    """``snaps``, failing inside the plan on one not later than the high water."""
    hw = F.lit(high_water).cast("date") if not isinstance(high_water, Column) else high_water
    late = F.raise_error(F.lit("snapshot not later than the applied high-water date; "
                               "rebuild these keys"))
    return (snaps.withColumn("_late", F.when(F.col(date) <= hw, late))
            .where(F.col("_late").isNull()).drop("_late"))


def apply_batch(dim: DataFrame, batch: DataFrame, attrs: Sequence[str], high_water,
                key: str = KEY, date: str = DATE) -> DataFrame:
    """Upsert of one date (at most one snapshot per key): close the current
    version of every changed key at the batch date, open the new one. Fails
    on a snapshot not later than ``high_water``, the last date applied."""
    batch = _not_late(batch, high_water, date)
    changed = changed_rows(dim, batch, key)
    closing = changed.select(F.col(key).alias("_k"), F.col(date).alias("_d"))
    cur = dim.where("is_current")
    closed = (cur.join(closing, cur[key] == closing["_k"], "inner")
              .withColumn("valid_to", F.col("_d"))
              .withColumn("is_current", F.lit(False))
              .drop("_k", "_d"))
    untouched_cur = cur.join(changed.select(key), key, "left_anti")
    history = dim.where(~F.col("is_current"))
    opened = changed.select(version_key(key, date).alias("station_key"), key, *attrs, HASH,
                            F.col(date).alias("valid_from"), _open_end().alias("valid_to"),
                            F.lit(True).alias("is_current"))
    cols = dim.columns
    return (history.select(cols).unionByName(untouched_cur.select(cols))
            .unionByName(closed.select(cols)).unionByName(opened.select(cols)))


def apply_range(dim: DataFrame, snaps: DataFrame, attrs: Sequence[str], high_water,
                key: str = KEY, date: str = DATE) -> DataFrame:
    """Apply any number of later dates in one pass.

    Closed versions and the versions of untouched keys are kept as they are.
    For touched keys the current version re-enters as a snapshot dated at its
    start, is unioned with the new snapshots, and the ordinary ``build`` runs
    over that union. Fails on a snapshot not later than ``high_water`` (the
    last date already applied): a late date needs a rebuild of its keys.
    """
    return apply_later(dim, _not_late(snaps, high_water, date), attrs, key, date)


def apply_later(dim: DataFrame, snaps: DataFrame, attrs: Sequence[str], key: str = KEY,
                date: str = DATE) -> DataFrame:
    """``apply_range`` for snapshots that the caller has already split from late ones."""
    touched = cut_lineage(snaps.select(key).distinct(), "touched")  # its size decides the joins
    keep = dim.join(touched, key, "left_anti")
    t = dim.join(touched, key, "left_semi")
    history = t.where(~F.col("is_current"))
    seed = t.where("is_current").select(key, F.col("valid_from").alias(date), *attrs, HASH)
    rows = snaps.count() + touched.count()  # of a touched key, one version is current
    rebuilt = build(seed.unionByName(snaps.select(key, date, *attrs, HASH)), attrs, key, date, rows)
    cols = dim.columns
    return (keep.select(cols).unionByName(history.select(cols))
            .unionByName(rebuilt.select(cols)))


def rebuild_keys(dim: DataFrame, snapshots: DataFrame, keys: DataFrame,
                 attrs: Sequence[str], key: str = KEY, date: str = DATE, rows: int | None = None) -> DataFrame:
    """Late data: rebuild the versions of ``keys`` from their full snapshot
    history (old snapshots plus the late ones) and keep every other key as
    is. Equal to a one-shot build for those keys; work is proportional to
    the keys rebuilt (semi-join, then the ordinary build)."""
    k = cut_lineage(keys.select(key).distinct(), "keys")
    keep = dim.join(k, key, "left_anti")
    rebuilt = build(snapshots.join(k, key, "left_semi"), attrs, key, date, rows)
    return keep.select(dim.columns).unionByName(rebuilt.select(dim.columns))


def late_keys(snaps: DataFrame, high_water, key: str = KEY, date: str = DATE) -> DataFrame:
    """Keys with a snapshot not later than the applied high-water date."""
    hw = F.lit(high_water).cast("date") if not isinstance(high_water, Column) else high_water
    return snaps.where(F.col(date) <= hw).select(key).distinct()


def batch_log(before: DataFrame, after: DataFrame, snaps: DataFrame,
              key: str = KEY, date: str = DATE) -> DataFrame:
    """One record per applied date: versions opened, versions closed and
    snapshots that changed nothing. max(batch_date) is the high-water mark."""
    def not_in(rows, old):  # by the natural key that station_key digests
        o = old.select(F.col(key).alias("_vk"), F.col("valid_from").alias("_vf"))
        same = rows[key].eqNullSafe(o["_vk"]) & rows["valid_from"].eqNullSafe(o["_vf"])
        return rows.join(o, same, "left_anti")

    new = not_in(after, before)
    opened = new.groupBy(F.col("valid_from").alias("batch_date")).agg(
        F.count(F.lit(1)).alias("opened"))
    closed_now = not_in(after.where(~F.col("is_current")), before.where(~F.col("is_current")))
    closed = closed_now.groupBy(F.col("valid_to").alias("batch_date")).agg(
        F.count(F.lit(1)).alias("closed"))
    seen = snaps.groupBy(F.col(date).alias("batch_date")).agg(
        F.count(F.lit(1)).alias("snapshots"))
    out = seen.join(opened, "batch_date", "left").join(closed, "batch_date", "left")
    return out.select(
        "batch_date",
        F.coalesce("opened", F.lit(0)).alias("opened"),
        F.coalesce("closed", F.lit(0)).alias("closed"),
        (F.col("snapshots") - F.coalesce("opened", F.lit(0))).alias("unchanged"),
    )

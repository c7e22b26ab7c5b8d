"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the whole TESTDATA tables through ``SurveyModel``. Output
columns are aliased to the names used by the DuckDB twins in ``oracle``;
floating values that two engines can compute with different last bits are
rounded the same way on both sides (percentiles to 4 places).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.operators import checks, clean, dedup, dims, facts, labels, rollup, scd2
from pricegrid.operators import compare, consumer, gold
from pricegrid.plans.model import SurveyModel
from pricegrid.session import cut_lineage, dealt_to
from pricegrid.sources import testdata as T

PART_ROWS = 250_000  # of the fact, in a part of a layout that appends leave

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _m(spark, sf_dir) -> SurveyModel:
    return SurveyModel(spark, sf_dir)


def _round_pcts(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 4).alias(c) if c in ("p10_price", "median_price", "p90_price")
                       else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ clean path

@query
def clean_accepted(spark, sf_dir):
    return _m(spark, sf_dir).accepted


@query
def clean_rejects(spark, sf_dir):
    return _m(spark, sf_dir).rejects


@query
def reject_reason_counts(spark, sf_dir):
    return clean.reason_counts(_m(spark, sf_dir).rejects)


@query
def clean_profile(spark, sf_dir):
    return clean.profile(_m(spark, sf_dir).accepted)


@query
def blank_rows(spark, sf_dir):
    return (clean.blank_rows(_m(spark, sf_dir).bronze).groupBy("source_file")
            .agg(F.count(F.lit(1)).alias("blank_rows")))


@query
def key_conflicts(spark, sf_dir):
    from pricegrid import constants as K
    return dedup.key_conflicts(_m(spark, sf_dir).accepted, K.OBSERVATION_KEY, "sale_price")


@query
def key_conflict_summary(spark, sf_dir):
    from pricegrid import constants as K
    c = dedup.key_conflicts(_m(spark, sf_dir).accepted, K.OBSERVATION_KEY, "sale_price")
    return dedup.key_conflict_summary(c)


@query
def row_balance(spark, sf_dir):
    from pricegrid import constants as K
    m = _m(spark, sf_dir)
    conf = dedup.key_conflicts(m.accepted, K.OBSERVATION_KEY, "sale_price")
    surplus = conf.agg(F.coalesce(F.sum("occurrences") - F.count(F.lit(1)), F.lit(0))).scalar()
    bal = checks.reconcile(bronze=m.bronze, rejects=m.rejects, clean=m.accepted)
    return bal.select("*", (F.col("clean") - surplus).alias("expected_after_dedup"))


# ------------------------------------------------------------------ dedup

@query
def dedup_kept(spark, sf_dir):
    return _m(spark, sf_dir).kept


@query
def dedup_discarded(spark, sf_dir):
    return _m(spark, sf_dir).discarded


# ------------------------------------------------------------------ labels

@query
def alias_missing_target(spark, sf_dir):
    m = _m(spark, sf_dir)
    planted = spark.createDataFrame([T.ABSENT_ALIAS], m.aliases.schema)
    return labels.check_targets(m.aliases.unionByName(planted), m.observations)


@query
def brand_dim(spark, sf_dir):
    return _m(spark, sf_dir).brand_dim


@query
def brand_top(spark, sf_dir):
    return labels.top(_m(spark, sf_dir).brand_dim, 15)


@query
def label_transitions(spark, sf_dir):
    return labels.transitions(_m(spark, sf_dir).kept)


# ------------------------------------------------------------------ versioned dimension

@query
def snapshot_unique(spark, sf_dir):
    return _m(spark, sf_dir).snapshots


@query
def snapshot_conflicts(spark, sf_dir):
    return scd2.snapshot_conflicts(_m(spark, sf_dir).snapshots_raw)


@query
def scd2_build(spark, sf_dir):
    return _m(spark, sf_dir).dim_station


@query
def scd2_profile(spark, sf_dir):
    return scd2.profile(_m(spark, sf_dir).dim_station)


@query
def scd2_single_current(spark, sf_dir):
    return scd2.check_single_current(_m(spark, sf_dir).dim_station)


@query
def scd2_contiguous(spark, sf_dir):
    return scd2.check_contiguous(_m(spark, sf_dir).dim_station)


@query
def scd2_coverage(spark, sf_dir):
    m = _m(spark, sf_dir)
    return scd2.check_coverage(m.kept, m.dim_station)


@query
def label_switches(spark, sf_dir):
    return scd2.label_switches(_m(spark, sf_dir).dim_station)


# ------------------------------------------------------------------ incremental dimension

@query
def scd2_batches(spark, sf_dir):
    return scd2.batches(_m(spark, sf_dir).snapshots, T.CUT_DATE)


@query
def scd2_changed_rows(spark, sf_dir):
    m = _m(spark, sf_dir)
    return scd2.changed_rows(m.base_dim, m.later_snapshots)


@query
def scd2_apply_batch(spark, sf_dir):
    """One date applied the way a per-date upsert would: the first date after
    the cut against the dimension built up to the cut."""
    m = _m(spark, sf_dir)
    first = m.later_snapshots.agg(F.min("collection_date")).scalar()
    batch = m.later_snapshots.where(F.col("collection_date") == first)
    return scd2.apply_batch(m.base_dim, batch, m.attrs, m.high_water)


@query
def scd2_apply_range(spark, sf_dir):
    return _m(spark, sf_dir).incremental_dim


@query
def scd2_symmetric_diff(spark, sf_dir):
    m = _m(spark, sf_dir)
    return compare.symmetric_diff_by_checksum(
        m.dim_station, m.incremental_dim,
        ["reseller_cnpj", "valid_from"], ["valid_to", "attribute_hash", "is_current"])


@query
def scd2_batch_log(spark, sf_dir):
    m = _m(spark, sf_dir)
    return scd2.batch_log(m.base_dim, m.incremental_dim, m.later_snapshots)


# ------------------------------------------------------------------ dimensions

@query
def calendar(spark, sf_dir):
    return _m(spark, sf_dir).dim_date


@query
def city_dim(spark, sf_dir):
    return _m(spark, sf_dir).dim_city


@query
def city_homonyms(spark, sf_dir):
    # stations whose tax id ends in 0 are placed in a city that several states have
    planted = F.when(F.col("reseller_cnpj").endswith("0"), F.lit(T.SHARED_CITY)).otherwise(F.col("city"))
    h = dims.homonyms(dims.city(_m(spark, sf_dir).kept.withColumn("city", planted)))
    return h.select("city_name", F.concat_ws(",", "ufs").alias("ufs"))


@query
def product_dim(spark, sf_dir):
    return _m(spark, sf_dir).dim_product


@query
def product_uncurated(spark, sf_dir):
    return dims.uncurated(_m(spark, sf_dir).dim_product)


# ------------------------------------------------------------------ fact and rollup

@query
def fact(spark, sf_dir):
    return _m(spark, sf_dir).fact


@query
def fact_duplicate_keys(spark, sf_dir):
    return checks.duplicate_key_count(_m(spark, sf_dir).fact,
                                      ["collection_date", "station_key", "product_key"])


@query
def fact_reconcile(spark, sf_dir):
    m = _m(spark, sf_dir)
    return facts.reconcile(m.kept, m.fact)


@query
def fact_as_of_union(spark, sf_dir):
    m = _m(spark, sf_dir)
    f = scd2.as_of(m.kept, m.dim_station, carry=["valid_from"])
    p = m.dim_product.select("product_key", F.col("source_product_name").alias("_pn"))
    return facts.with_station_key(f.join(p, f["product"] == p["_pn"])).select(*facts.FACT_COLUMNS)


@query
def weekly_rollup(spark, sf_dir):
    return _round_pcts(_m(spark, sf_dir).weekly)


@query
def rollup_reconcile(spark, sf_dir):
    m = _m(spark, sf_dir)
    return rollup.reconcile(m.fact, m.weekly)


@query
def rollup_profile(spark, sf_dir):
    return rollup.profile(_m(spark, sf_dir).weekly)


@query
def edge_coverage(spark, sf_dir):
    return rollup.edge_coverage(_m(spark, sf_dir).weekly)


@query
def weekly_rollup_raw_keys(spark, sf_dir):
    m = _m(spark, sf_dir)
    return _round_pcts(rollup.weekly_raw_keys(m.fact_versions, m.dim_station))


# ------------------------------------------------------------------ gold analyses

@query
def parity_by_region(spark, sf_dir):
    m = _m(spark, sf_dir)
    return gold.parity(m.weekly, m.dim_city, m.dim_product,
                       T.PARITY_NUMERATOR, T.PARITY_DENOMINATOR)


@query
def bench_selective(spark, sf_dir):
    m = _m(spark, sf_dir)
    return consumer.selective(m.fact, m.dim_product, T.SELECTIVE_FROM, T.SELECTIVE_TO,
                              T.PARITY_DENOMINATOR)


@query
def bench_broad(spark, sf_dir):
    m = _m(spark, sf_dir)
    return consumer.broad(m.fact_versions, m.dim_station)


@query
def bench_lookup(spark, sf_dir):
    m = _m(spark, sf_dir)
    return consumer.lookup(m.fact, m.dim_station, T.LOOKUP_CNPJ)


# ------------------------------------------------------------------ build comparison

def _raw_label_dim(m: SurveyModel) -> DataFrame:
    """A second build of the station dimension without the alias map."""
    return m.versions(scd2.build(scd2.snapshots(m.kept, m.attrs), m.attrs, rows=m.kept.count()))  # read twice


@query
def compare_missing_keys(spark, sf_dir):
    m = _m(spark, sf_dir)
    return compare.missing_keys_by_checksum(m.dim_station, _raw_label_dim(m),
                                            ["reseller_cnpj", "valid_from"])


@query
def compare_group_counts(spark, sf_dir):
    m = _m(spark, sf_dir)
    raw = rollup.weekly_raw_keys(m.fact_versions, m.dim_station)
    return compare.group_counts(m.weekly, raw, ["week_start_date"])


@query
def compare_values(spark, sf_dir):
    m = _m(spark, sf_dir)
    a = cut_lineage(rollup.weekly_raw_keys(m.fact_versions, m.dim_station))
    b = cut_lineage(compare.percentiles_by_rank(m.fact_versions, m.dim_station))
    return compare.values_by_checksum(a, b, ["week_start_date", "state", "city", "product_key"],
                                      ["median_price", "p10_price"])


# ------------------------------------------------------------------ bronze stream and landing

def _landed(spark, sf_dir) -> str:
    """Survey CSV files rendered from the TESTDATA rows, one per source file,
    in a fresh folder under the shared checkpoint root."""
    from pricegrid.session import scratch_path
    from pricegrid.sources import bronze as B
    landing = scratch_path(spark, "landing")
    B.write_landing(_m(spark, sf_dir).bronze, landing)
    return landing


def _ingested(spark, sf_dir) -> DataFrame:
    from pricegrid.session import scratch_path
    from pricegrid.streaming import bronze_stream
    landing = _landed(spark, sf_dir)
    table, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "bronze-ckpt")
    bronze_stream.ingest(spark, landing, table, ckpt)
    return bronze_stream.committed_rows(spark, table, ckpt)


@query
def bronze_stream_counts(spark, sf_dir):
    from pricegrid.sources import bronze as B
    return B.load_counts(_ingested(spark, sf_dir))


@query
def bronze_null_probe(spark, sf_dir):
    from pricegrid.sources import bronze as B
    return B.null_probe(_ingested(spark, sf_dir))


@query
def bronze_malformed(spark, sf_dir):
    from pricegrid.sources import bronze as B
    landing = _landed(spark, sf_dir)
    T.plant_malformed(spark, sf_dir, landing)
    return B.malformed_profile(spark, landing)


@query
def landing_file_stats(spark, sf_dir):
    from pricegrid.sources import landing
    st = landing.file_stats(spark, _landed(spark, sf_dir), pattern=r"(file-[0-9]+)/[^/]+$")
    return st.select("csv_name", "csv_lines")


# ------------------------------------------------------------------ layout and incremental stream

def _staged_fact(spark, sf_dir) -> str:
    """The fact written as small files, at least one per shuffle partition (what appends
    leave behind), straight from the rows of the fact."""
    from pricegrid.session import scratch_path
    path = scratch_path(spark, "fact")
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fact = _m(spark, sf_dir).fact
    fact.write.option("maxRecordsPerFile", min(fact.count() // pieces + 1, PART_ROWS)).option("compression", "zstd").parquet(path)
    return path


def _content(df: DataFrame) -> DataFrame:
    # station keys are told apart by 128 bits of them, as surely as by the whole hash
    keys = df.select(F.unhex(F.substring("station_key", 1, 32)).alias("key"))
    # nearly as many as rows, so dealt before they are told apart: input splits can't combine them
    n = dealt_to(df.sparkSession, df.count())
    keys = (keys.repartition(n, "key") if n else keys.repartition("key")).distinct()
    totals = df.agg(F.count(F.lit(1)).alias("rows"), F.sum("sale_price").cast("double").alias("price_sum"))
    return totals.select("rows", keys.agg(F.count("key")).scalar().alias("station_keys"), "price_sum")


@query
def layout_after_compaction(spark, sf_dir):
    from pricegrid.session import scratch_path
    from pricegrid.sources import tables
    src = _staged_fact(spark, sf_dir)
    out = tables.compact(spark, src, scratch_path(spark, "tables"), "fact")
    before, after = (tables.layout_stats(spark, p).agg(F.max("num_files")).scalar() for p in (src, out))
    return _content(spark.read.parquet(out)).withColumn("not_more_files", after <= before)


@query
def layout_after_clustering(spark, sf_dir):
    from pricegrid.session import scratch_path
    from pricegrid.sources import tables
    src = _staged_fact(spark, sf_dir)
    out = tables.cluster(spark, src, ["collection_date", "product_key"],
                         scratch_path(spark, "tables"), "fact")
    overlap = tables.overlapping_files(tables.file_ranges(spark, out, "collection_date"))
    return _content(spark.read.parquet(out)).withColumn("overlapping_files", checks.count_of(overlap))


@query
def layout_after_packing(spark, sf_dir):
    """Two large files and many small ones, as appends leave them: only small files are
    rewritten, the large ones stay what they are."""
    from pricegrid.session import scratch_path
    from pricegrid.sources import tables
    fact, path = _m(spark, sf_dir).fact_versions.drop("station_key"), scratch_path(spark, "fact")
    # 16 parts or more, so that a large file, of 6 parts, stays a task's work at any size
    parts = max(16, -(-fact.count() // PART_ROWS))
    appended = F.pmod(F.xxhash64(scd2.KEY, "valid_from"), F.lit(parts)) >= 12
    for rows, files in ((fact.where(~appended), 2), (fact.where(appended), 3 * (parts - 12))):
        dealt = facts.with_station_key(rows.repartition(files)).select(*facts.FACT_COLUMNS)
        dealt.write.mode("append").option("compression", "zstd").parquet(path)
    before = tables.files(spark, path)
    large = before.agg(F.max("length")).first()[0]
    manifest, rewritten = tables.pack_small(spark, path, scratch_path(spark, "tables"), "fact", large, large // 2)
    after = spark.read.parquet(manifest)
    small = before.where(F.col("length") < large // 2)
    return _content(tables.read_manifest(spark, manifest)).select(
        "*", small.agg(F.sum("length") >= rewritten).scalar().alias("only_small_files_rewritten"),
        checks.count_of(before.where(F.col("length") >= large // 2).join(after, "path")).cast("int").alias("files_kept"), (checks.count_of(after) < checks.count_of(before)).alias("fewer_files"))


@query
def layout_after_interleaving(spark, sf_dir):
    """Clustered by both columns together: a filter on either one skips files. One row for
    each column; sorted by date first, a filter on the product opens every file."""
    from pricegrid.session import scratch_path
    from pricegrid.sources import tables
    src, cols, found = _staged_fact(spark, sf_dir), ["collection_date", "product_key"], []
    sixteenth = min(tables.layout_stats(spark, src).first()["size_bytes"] // 16 + 1, tables.TARGET_FILE_BYTES)
    made = {kind: make(spark, src, cols, scratch_path(spark, "tables"), "fact", sixteenth)
            for kind, make in (("plain", tables.cluster), ("interleaved", tables.cluster_interleaved))}
    content = cut_lineage(_content(spark.read.parquet(made["interleaved"])))
    for col in cols:
        share = {kind: tables.share_met(spark, out, col) for kind, out in made.items()}
        found.append(content.select(
            F.lit(col).alias("filter_column"), "*", (share["interleaved"].scalar() <= 0.7).alias("skips_files"),
            (share["plain"].scalar() <= 0.7).alias("skips_files_sorted")))
    return found[0].unionByName(found[1])


def _streamed_dimension(spark, sf_dir) -> tuple[str, str]:
    """History before the cut seeds the dimension; later observations arrive on
    a stream in two micro-batches that share every date. Returns its root and log."""
    from pricegrid.session import scratch_path
    from pricegrid.streaming import dimension_stream as DS
    m = _m(spark, sf_dir)
    root, log = scratch_path(spark, "dim"), scratch_path(spark, "dim-log")
    before = m.snapshots.where(F.col("collection_date") < m.cut())
    DS.seed(spark, m.base_dim, before, m.high_water, root, log)
    feed, ckpt = scratch_path(spark, "obs-feed"), scratch_path(spark, "dim-ckpt")
    later = m.kept.where(F.col("collection_date") >= m.cut())
    for half in (0, 1):
        later.where(F.col("l_orderkey") % 2 == half).write.mode("append").option("compression", "zstd").parquet(feed)
        stream = spark.readStream.schema(later.schema).parquet(feed)
        DS.start(spark, stream, m.attrs, root, log, ckpt,
                 canonical=lambda b: scd2.canonicalise(b, T.alias_map(b.sparkSession))).awaitTermination()
    return root, log


@query
def scd2_stream_apply(spark, sf_dir):
    """The final version of the streamed dimension, which must equal the one-shot build."""
    from pricegrid.streaming import dimension_stream as DS
    dim, _, _ = DS.current(spark, *_streamed_dimension(spark, sf_dir))
    return dim


@query
def scd2_as_of_batch(spark, sf_dir):
    """The streamed dimension as it was before its first micro-batch."""
    from pricegrid.streaming import dimension_stream as DS
    return DS.version(spark, _streamed_dimension(spark, sf_dir)[1], -1)


@query
def scd2_version_diff(spark, sf_dir):
    """What the two micro-batches together changed."""
    from pricegrid.streaming import dimension_stream as DS
    return DS.difference(spark, _streamed_dimension(spark, sf_dir)[1], -1, 1)


@query
def scd2_late_rebuild(spark, sf_dir):
    """Every snapshot of a 15th arrives after all others."""
    from pricegrid.streaming import dimension_stream as DS
    m = _m(spark, sf_dir)
    is_late = F.dayofmonth("collection_date") == 15
    first, late = m.snapshots.where(~is_late), m.snapshots.where(is_late)
    hw = first.agg(F.max("collection_date")).scalar()
    # the first dimension is read several times, so written once
    return DS.applied(m.versions(scd2.build(first, m.attrs)), late, m.snapshots, m.attrs, hw)


# ------------------------------------------------------------------ summaries of the composite jobs

@query
def dedup_balance(spark, sf_dir):
    m = _m(spark, sf_dir)
    return checks.reconcile(before=m.observations, after=m.kept, discarded=m.discarded)


@query
def snapshot_conflict_summary(spark, sf_dir):
    c = scd2.snapshot_conflicts(_m(spark, sf_dir).snapshots_raw)
    return c.agg(F.count(F.lit(1)).alias("ambiguous_pairs"),
                 F.coalesce(F.sum("states_on_day") - F.count(F.lit(1)), F.lit(0))
                 .alias("surplus_rows"))


@query
def brand_summary(spark, sf_dir):
    m = _m(spark, sf_dir)
    raw = m.observations.agg(F.count_distinct("brand").alias("raw_labels"))
    return raw.select("raw_labels", checks.count_of(m.aliases).alias("aliases"),
                      checks.count_of(m.brand_dim).alias("canonical_labels"))


@query
def city_profile(spark, sf_dir):
    return _m(spark, sf_dir).dim_city.agg(
        F.count(F.lit(1)).alias("cities"), F.count_distinct("city_name").alias("distinct_names"),
        F.count_distinct("uf").alias("states"))


@query
def scd2_incremental_invariants(spark, sf_dir):
    inc = _m(spark, sf_dir).incremental_dim
    single = scd2.check_single_current(inc)
    return single.select("stations_violating",
                         scd2.check_contiguous(inc).scalar().alias("intervals_violating"))

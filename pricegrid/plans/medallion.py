"""End-to-end build over survey CSV files: landing -> bronze -> silver -> gold.

Runs the jobs in the order of the survey build (ingest, clean, alias map,
dedup, station versions, dimensions, fact, weekly rollup). Every stage is
written as a new version of a Parquet table under ``out_root`` and read back
by the next stage: tables are the lineage cuts, so a lost executor never
recomputes more than one stage, and no table is overwritten while read.
Every invariant check raises on failure instead of only displaying counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid import constants as K
from pricegrid.operators import checks, clean, dedup, dims, facts, gold, labels, rollup, scd2
from pricegrid.session import cut_lineage
from pricegrid.sources import bronze as bronze_src
from pricegrid.sources import landing as landing_src
from pricegrid.sources import tables
from pricegrid.streaming import bronze_stream


class Build:
    def __init__(self, spark: SparkSession, out_root: str):
        self.spark = spark
        self.root = out_root.rstrip("/")
        self.paths: dict[str, str] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        self.paths[name] = tables.replace(df, self.root, name)
        return self.spark.read.parquet(self.paths[name])


def alias_frame(spark: SparkSession, rows=K.BRAND_ALIASES) -> DataFrame:
    return spark.createDataFrame(list(rows), "source_brand string, canonical_brand string, "
                                             "rationale string")


def curated_frame(spark: SparkSession, rows=K.CURATED_PRODUCTS) -> DataFrame:
    return spark.createDataFrame(
        list(rows), "source_product_name string, product_name string, fuel_family string, "
                    "unit_of_measure string, is_liquid_fuel boolean, in_default_scope boolean")


def run(spark: SparkSession, landing: str, out_root: str, aliases: DataFrame | None = None,
        curated: DataFrame | None = None, attrs: Sequence[str] = K.STATION_ATTRIBUTES,
        bronze_path: str | None = None, bronze_checkpoint: str | None = None,
        bronze_root: str | None = None, full_refresh: bool = False) -> dict[str, str]:
    """Build every table; returns {table name: version path}. With ``bronze_root`` bronze
    is kept in generations there, and ``full_refresh`` ingests all files into a new one."""
    b = Build(spark, out_root)
    aliases = aliases if aliases is not None else alias_frame(spark)
    curated = curated if curated is not None else curated_frame(spark)

    # bronze: incremental file stream, drained and stopped
    bronze_path = bronze_path or f"{b.root}/bronze/price_raw"
    bronze_checkpoint = bronze_checkpoint or f"{b.root}/_checkpoints/price_raw"
    if bronze_root:
        generation = bronze_stream.refresh(spark, landing, bronze_root, full_refresh)
        bronze_path, bronze_checkpoint = f"{generation}/rows", f"{generation}/checkpoint"
    else:
        bronze_stream.ingest(spark, landing, bronze_path, bronze_checkpoint)
    b.paths["price_raw"] = bronze_path
    bronze = bronze_stream.committed_rows(spark, bronze_path, bronze_checkpoint)

    found = b.write("rescued", bronze_src.rescue_check(bronze)).first()
    if found.unmatched_files:
        raise checks.CheckFailed(f"no row fits the columns in {found.unmatched_files} files: {found}")

    # silver: rows are converted and judged once; typed rows and rejects read that
    judged = cut_lineage(clean.classify(clean.drop_blank(bronze)), "judged")
    silver = b.write("price_clean", clean.accepted(judged, carry=["ingested_at"]))
    rejects = b.write("silver_rejects", clean.rejects(judged, with_clock=True))
    conflicts = b.write("silver_key_conflicts",
                        dedup.key_conflicts(silver, K.OBSERVATION_KEY, "sale_price"))
    balance = b.write("row_balance", checks.reconcile(
        bronze=bronze, blank=clean.blank_rows(bronze), rejects=rejects, clean=silver)
        .select("*", (F.col("clean") - conflicts.agg(
            F.coalesce(F.sum("occurrences") - F.count(F.lit(1)), F.lit(0))).scalar())
            .alias("expected_after_dedup"))).first()
    if balance.bronze != balance.blank + balance.rejects + balance.clean:
        raise checks.CheckFailed(f"row balance: {balance}")

    # alias map: refused when chained or pointing at a label absent from the data
    alias = b.write("brand_alias", labels.validate(aliases, silver))
    b.write("dim_brand", labels.brand_dim(silver, alias))

    # dedup: lowest price, then name, then file, then the rest of the row (total order)
    obs = b.write("price_observation",
                  dedup.keep_first_of_groups(silver, K.OBSERVATION_KEY, K.DEDUP_ORDER))
    gone = b.write("dedup_discarded", dedup.discarded(silver, obs, K.OBSERVATION_KEY)
                   .withColumn("discarded_at", F.current_timestamp()))
    dd = b.write("dedup_balance", checks.reconcile(before=silver, after=obs, discarded=gone)).first()
    if dd.before != dd.after + dd.discarded or dd.after != balance.expected_after_dedup:
        raise checks.CheckFailed(f"dedup balance: {dd}, expected {balance.expected_after_dedup}")

    # station versions
    canon = scd2.canonicalise(obs, alias)
    b.write("station_snapshot_conflicts",
            scd2.snapshot_conflicts(scd2.snapshots_raw(canon, attrs)))
    dim = b.write("dim_station", scd2.build(scd2.snapshots(canon, attrs), attrs, rows=obs.count()))
    checks.require_zero(scd2.check_single_current(dim), "one current version per station")
    checks.require_zero(scd2.check_contiguous(dim), "contiguous validity")
    checks.require_zero(scd2.check_coverage(obs, dim), "one version per observation")
    checks.require_unique(dim, ["station_key"], "dim_station")
    b.write("label_switches", scd2.label_switches(dim))

    # conformed dimensions
    cal = b.write("dim_date", dims.calendar(obs))
    city = b.write("dim_city", dims.city(obs))
    checks.require_unique(city, ["city_key"], "dim_city")
    product = b.write("dim_product", dims.product(obs, curated))
    checks.require_unique(product, ["product_key"], "dim_product")

    # fact: version in force on the date; may neither lose nor multiply rows
    fact = b.write("fct_price_observation", facts.build(obs, dim, product))
    rec = facts.reconcile(obs, fact).first()
    if rec.observations != rec.fact_rows:
        raise checks.CheckFailed(f"fact rows {rec.fact_rows} != observations {rec.observations}")
    checks.require_zero(checks.duplicate_key_count(
        fact, ["collection_date", "station_key", "product_key"]), "fact key")

    # weekly rollup with exact percentiles and marked edge weeks
    agg = b.write("weekly_price_unmarked", rollup.weekly_unmarked(fact, dim, city, cal))
    weekly = b.write("weekly_price", rollup.mark_edges(agg))
    r = rollup.reconcile(fact, weekly).first()
    if r.fact_rows != r.rollup_observations:
        raise checks.CheckFailed(f"rollup sum {r.rollup_observations} != fact {r.fact_rows}")
    b.write("edge_coverage", rollup.edge_coverage(weekly))
    b.write("parity_by_state", gold.parity(weekly, city, product))
    return b.paths


def land(spark: SparkSession, archive_dir: str, landing: str, audit_path: str) -> DataFrame:
    """L1: extract the archives that no earlier run has landed, append the new files to
    the audit table and the archives to the ledger beside it. A listed archive whose
    length and modification time are unchanged is not opened. A run that stops before
    its ledger entry is done again, with the same files."""
    ledger_path = f"{audit_path.rstrip('/')}-archives"
    ledger = tables.read_or_none(spark, ledger_path)
    found = cut_lineage(landing_src.archives(spark, archive_dir, ledger), "archives")
    manifest = landing_src.extract(spark, archive_dir, landing, ledger)
    rows = landing_src.append_audit(manifest, audit_path, tables.read_or_none(spark, audit_path))
    found.write.mode("append").parquet(ledger_path)
    return rows


# Table descriptions written by ``describe`` (our own wording).
TABLE_NOTES = {
    "price_raw": "Survey rows as delivered: every column text, blank lines included.",
    "price_clean": "Typed, normalised rows; blank lines removed, repeated keys still present.",
    "silver_rejects": "Rows that failed conversion, with raw values and the first failing reason.",
    "price_observation": "One row per collection date, station and product.",
    "dim_station": "Station history with half-open validity; the current version ends 9999-12-31.",
    "brand_alias": "Hand-curated labels that name the same distributor, with rationale.",
    "fct_price_observation": "Price by date, station version and product; label and city come "
                             "from the version in force.",
    "weekly_price": "Weekly summary per city and product with exact percentiles; first and last "
                    "weeks flagged in is_edge_week.",
}
COLUMN_NOTES = [
    ("dim_station", "attribute_hash", "Digest of the attributes that open a version; the address "
                                      "complement is left out on purpose."),
    ("dim_station", "valid_to", "Exclusive end; 9999-12-31 for the current version."),
    ("weekly_price", "median_price", "Exact percentile (linear interpolation), never approximate."),
    ("dim_city", "city_key", "Digest of state and city: the name alone repeats across states."),
]


def describe(spark: SparkSession, paths: dict[str, str], schema: str = "pricegrid") -> list:
    """L26: point the tables of ``schema`` at the written versions and comment
    them. A failing item is reported, not fatal; returns the failures."""
    tables.setup(spark, {schema: "Survey price model built by pricegrid."})
    errors = []
    for name, path in paths.items():
        try:
            tables.register(spark, f"{schema}.{name}", path)
        except AnalysisException as e:
            errors.append((name, f"{type(e).__name__}: {str(e)[:150]}"))
    notes = {f"{schema}.{k}": v for k, v in TABLE_NOTES.items() if k in paths}
    cols = [(f"{schema}.{t}", c, v) for t, c, v in COLUMN_NOTES if t in paths]
    return errors + tables.comment(spark, notes, cols)

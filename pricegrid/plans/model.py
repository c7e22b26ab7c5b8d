"""The survey model over the TESTDATA tables, stage by stage.

Each attribute is a DataFrame plan. The three tables the survey build writes
and reads many times -- the deduplicated observations, the station
dimension and the fact (plus the snapshot table) -- are materialised once as
Parquet tables in the shared checkpoint folder (``materialise=True``), as the batch
build writes them as tables: downstream plans then read files instead of
re-running the dedup aggregate once per consumer, and a lost executor
re-reads those files instead of recomputing the lineage. Everything else
stays lazy.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid import constants as K
from pricegrid.functions.keys import attribute_hash
from pricegrid.operators import clean, dedup, dims, facts, labels, rollup, scd2
from pricegrid.session import cut_lineage
from pricegrid.sources import testdata as T


class SurveyModel:
    attrs = T.ATTRIBUTES

    def __init__(self, spark: SparkSession, sf_dir: str, materialise: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialise = materialise

    def _table(self, df: DataFrame) -> DataFrame:
        return cut_lineage(df) if self.materialise else df

    # ---- clean path (text rendering -> typed rows + rejects)
    @cached_property
    def bronze(self) -> DataFrame:
        return T.raw_text(self.spark, self.sf_dir)

    @cached_property
    def classified(self) -> DataFrame:
        # converted and judged once; accepted and rejects are filters on it
        return self._table(clean.classify(clean.drop_blank(self.bronze)))

    @cached_property
    def accepted(self) -> DataFrame:
        return clean.accepted(self.classified)

    @cached_property
    def rejects(self) -> DataFrame:
        return clean.rejects(self.classified)

    # ---- modelling path
    @cached_property
    def observations(self) -> DataFrame:
        return T.observations(self.spark, self.sf_dir)

    @cached_property
    def kept(self) -> DataFrame:
        return self._table(dedup.keep_first_of_groups(self.observations, K.OBSERVATION_KEY,
                                                      K.DEDUP_ORDER + T.ROW_IDENTITY))

    @cached_property
    def discarded(self) -> DataFrame:
        return dedup.discarded(self.observations, self.kept, K.OBSERVATION_KEY,
                               identity=T.ROW_IDENTITY + ["reseller_cnpj"])

    @cached_property
    def aliases(self) -> DataFrame:
        return T.alias_map(self.spark)

    @cached_property
    def canonical(self) -> DataFrame:
        return scd2.canonicalise(self.kept, self.aliases)

    @cached_property
    def snapshots_raw(self) -> DataFrame:
        return scd2.snapshots_raw(self.canonical, self.attrs)

    @cached_property
    def snapshots(self) -> DataFrame:
        # one row per (station, date): read by the build, the incremental
        # split and the high-water scalar, so written once, without its hash
        rows = self._table(scd2.snapshots(self.canonical, self.attrs).drop(scd2.HASH))
        return rows.withColumn(scd2.HASH, attribute_hash(self.attrs))

    def versions(self, dim: DataFrame) -> DataFrame:
        """A dimension written once, its hashes computed where it is read."""
        return scd2.restored(self._table(scd2.stored(dim)), self.attrs)

    @cached_property
    def dim_station(self) -> DataFrame:
        return self.versions(scd2.build(self.snapshots, self.attrs))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._table(dims.product(self.kept, T.curated_products(self.spark)))  # its size decides joins

    @cached_property
    def dim_city(self) -> DataFrame:
        return self._table(dims.city(self.kept))

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.calendar(self.kept)

    @cached_property
    def fact_versions(self) -> DataFrame:
        """The fact with the natural key of each row's version, which the joins use."""
        return facts.with_station_key(self._table(facts.build_stored(self.kept, self.dim_station, self.dim_product)))

    @cached_property
    def fact(self) -> DataFrame:
        return self.fact_versions.select(*facts.FACT_COLUMNS)

    @cached_property
    def weekly(self) -> DataFrame:
        return rollup.weekly(self.fact_versions, self.dim_station, self.dim_city, self.dim_date)

    @cached_property
    def brand_dim(self) -> DataFrame:
        return labels.brand_dim(self.observations, self.aliases, unbranded=T.UNBRANDED)

    # ---- incremental dimension
    def cut(self):
        return F.lit(T.CUT_DATE).cast("date")

    @cached_property
    def base_dim(self) -> DataFrame:
        return self.versions(scd2.build(self.snapshots.where(F.col("collection_date") < self.cut()), self.attrs))

    @cached_property
    def later_snapshots(self) -> DataFrame:
        return self.snapshots.where(F.col("collection_date") >= self.cut())

    @cached_property
    def high_water(self):
        return self.snapshots.where(F.col("collection_date") < self.cut()).agg(
            F.max("collection_date")).scalar()

    @cached_property
    def incremental_dim(self) -> DataFrame:
        return self.versions(scd2.apply_range(self.base_dim, self.later_snapshots, self.attrs, self.high_water))

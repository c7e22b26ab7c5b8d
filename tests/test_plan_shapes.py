"""Scale properties checked on the physical plan (they cannot be timed at
test size, so the plan shape itself is asserted)."""

import re

import pytest
from pyspark.sql import functions as F

from pricegrid import constants as K
from pricegrid.operators import consumer, dedup, rollup, scd2
from pricegrid.plans.model import SurveyModel
from pricegrid.sources import testdata as T

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _below_first_exchange(p: str, needle: str) -> bool:
    """True when ``needle`` occurs under (after, in tree text) an Exchange."""
    i = p.find("Exchange")
    return i >= 0 and needle in p[i:]


def test_dedup_limits_each_key_before_the_shuffle(spark):
    m = SurveyModel(spark, SF, materialise=False)
    p = plan(dedup.keep_first(m.observations, K.OBSERVATION_KEY, K.DEDUP_ORDER + T.ROW_IDENTITY))
    assert _below_first_exchange(p, "WindowGroupLimit") and "SortAggregate" not in p
    kept = spark.createDataFrame([], m.observations.schema)  # stands for the written table
    d = plan(dedup.discarded(m.observations, kept, K.OBSERVATION_KEY, identity=T.ROW_IDENTITY))
    assert "Window" not in d and "partial_count" in d and "LeftSemi" in d and "LeftAnti" in d


def test_snapshots_and_versions_windows(spark):
    m = SurveyModel(spark, SF, materialise=False)
    p = plan(scd2.build(scd2.snapshots(m.canonical, m.attrs), m.attrs))
    # snapshots are limited per (station, date) map-side; versions go by station only
    assert _below_first_exchange(p, "WindowGroupLimit") and "SortAggregate" not in p
    assert re.search(r"Window \[.*lead", p) and re.search(r"Window \[.*lag", p)


def test_as_of_sorts_pairs_and_versions_together(spark, scratch):
    m = SurveyModel(spark, SF, materialise=False)
    kept, dim = scratch("kept"), scratch("dim")
    m.kept.write.parquet(kept)
    m.dim_station.write.parquet(dim)
    p = plan(scd2.as_of(spark.read.parquet(kept), spark.read.parquet(dim)))
    assert p.count("Exchange hashpartitioning") <= 4 and "explode" not in p


def test_clean_converts_once(spark):
    m = SurveyModel(spark, SF)
    for df in (m.accepted, m.rejects):
        assert "regexp_replace" not in plan(df)  # both read the judged table


def test_rollup_has_one_exchange_on_the_group(spark, scratch):
    m = SurveyModel(spark, SF, materialise=False)
    paths = {}
    for n in ["fact", "dim_station", "dim_city", "dim_date"]:
        paths[n] = scratch(n)
        getattr(m, n).write.parquet(paths[n])
    r = {k: spark.read.parquet(v) for k, v in paths.items()}
    for p, group in ((plan(rollup.weekly_unmarked(r["fact"], r["dim_station"], r["dim_city"], r["dim_date"])), "city_key"),
                     (plan(rollup.weekly_raw_keys(r["fact"], r["dim_station"])), "week_start_date")):
        exchanges = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
        on_group = [line for line in exchanges if group in line and "product_key" in line]
        assert len(on_group) == 1 and "percentile" not in p and "distinct" not in p
        # below that exchange nothing is collected: the narrow joined rows cross it
        below = p[p.index(on_group[0]):]
        assert "collect_list" not in below and "collect_set" not in below and "collect_list" in p
    # the city key is hashed per station version, below the join with the fact
    p = plan(rollup.weekly_unmarked(r["fact"], r["dim_station"], r["dim_city"], r["dim_date"]))
    assert p.find("sha2") > p.find("station_key")


def test_selective_filter_reaches_the_scan(spark, scratch):
    m = SurveyModel(spark, SF, materialise=False)
    fp, pp = scratch("fact"), scratch("prod")
    m.fact.write.parquet(fp)
    m.dim_product.write.parquet(pp)
    q = consumer.selective(spark.read.parquet(fp), spark.read.parquet(pp),
                           "1998-01-01", "1998-03-31", T.PARITY_DENOMINATOR)
    p = plan(q)
    scan = [line for line in p.splitlines() if "FileScan parquet" in line and "sale_price" in line][0]
    assert "PushedFilters: [IsNotNull(collection_date)" in scan
    assert "GreaterThanOrEqual(collection_date" in scan
    # only the three columns the query needs are read
    assert re.search(r"ReadSchema: struct<collection_date:date,product_key:string,sale_price:decimal\(10,3\)>", scan)


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from pricegrid.session import checkpoint_root
    conf = SimpleNamespace(get=lambda *_: None)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))

"""End-to-end build from survey CSV files rendered from the smallest TESTDATA."""

from pyspark.sql import functions as F

from pricegrid.operators import clean, scd2
from pricegrid.plans import medallion
from pricegrid.plans.model import SurveyModel
from pricegrid.sources import bronze

SF = "/root/testdata/sf0.001"


def test_full_build_from_csv(spark, scratch):
    m = SurveyModel(spark, SF, materialise=False)
    landing = scratch("landing")
    bronze.write_landing(m.bronze, landing)
    aliases = spark.createDataFrame([("AO", "AF", "r"), ("RO", "RF", "r")],
                                    "source_brand string, canonical_brand string, rationale string")
    paths = medallion.run(spark, landing, scratch("out"), aliases=aliases)
    read = {k: spark.read.parquet(v) for k, v in paths.items()}
    bal = read["row_balance"].first()
    assert bal.bronze == m.bronze.count()
    assert bal.bronze - bal.rejects - bal.clean == m.bronze.where(
        F.coalesce(*[F.col(c) for c in bronze.K.BRONZE_COLUMNS]).isNull()).count()
    obs = read["price_observation"].count()
    assert obs == bal.expected_after_dedup
    assert obs + read["dedup_discarded"].count() == bal.clean
    assert read["fct_price_observation"].count() == obs
    assert read["weekly_price"].agg(F.sum("observations")).first()[0] == obs
    assert read["weekly_price"].where("is_edge_week").count() > 0
    dim = read["dim_station"]
    assert scd2.check_contiguous(dim).first()[0] == 0
    # a second run over the same landing folder ingests nothing new
    again = medallion.run(spark, landing, paths["price_raw"].rsplit("/bronze/", 1)[0] + "/x",
                          aliases=aliases, bronze_path=paths["price_raw"],
                          bronze_checkpoint=paths["price_raw"].rsplit("/bronze/", 1)[0]
                          + "/_checkpoints/price_raw")
    assert spark.read.parquet(again["price_raw"]).count() == bal.bronze
    # exact columns and clock of the clean tables
    assert set(read["price_clean"].columns) == {*clean.SILVER_COLUMNS, "ingested_at"}
    assert set(read["dedup_discarded"].columns) == {*clean.SILVER_COLUMNS, "ingested_at", "discarded_at"}
    raw = read["price_raw"].agg(F.min("ingested_at"), F.max("ingested_at")).first()
    assert read["price_clean"].agg(F.min("ingested_at"), F.max("ingested_at")).first() == raw
    # checks and analyses are written
    assert {"label_switches", "edge_coverage", "parity_by_state", "dedup_balance"} <= set(paths)
    # governance: tables registered and commented, nothing failed
    assert medallion.describe(spark, paths, "pg_build") == []
    row = spark.sql("DESCRIBE TABLE EXTENDED pg_build.weekly_price").where(
        "col_name = 'Comment'").first()
    assert row is not None and "exact percentiles" in row.data_type
    assert spark.table("pg_build.fct_price_observation").count() == obs
    # a later version is what the catalog serves
    fewer = read["fct_price_observation"].limit(3)
    path = scratch("fewer")
    fewer.write.parquet(path)
    assert medallion.describe(spark, paths | {"fct_price_observation": path}, "pg_build") == []
    assert spark.table("pg_build.fct_price_observation").count() == 3

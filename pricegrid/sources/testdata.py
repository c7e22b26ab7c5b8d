"""Survey-shaped views over the driver's TPC-H-like tables.

The survey data itself is not available, so the operators run on views that
Spark derives from the given tables: one lineitem row is one price
observation (supplier = station, part type = product, ship date = collection
date). Every view is a plain DataFrame plan over whole tables; Catalyst prunes
columns and pushes filters into the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid import constants as K

# Station attributes that exist in the derived view (the survey has nine; the
# view has four). Operators take the attribute list as a parameter.
ATTRIBUTES = ["reseller_name", "city", "state", "brand"]
# Columns that make one lineitem row unique; appended to every dedup order.
ROW_IDENTITY = ["l_orderkey", "l_linenumber", "l_partkey"]
# Brand labels of the view that name the same thing (source, canonical, rationale).
ALIASES = [
    ("AO", "AF", "same label family, status suffix differs"),
    ("RO", "RF", "same label family, status suffix differs"),
]
UNBRANDED = "NF"
# Curated products of the view
# (source label, name, family, unit, is_liquid_fuel, in_default_scope).
# LARGE, MEDIUM and SMALL stay uncurated on purpose.
CURATED = [
    ("STANDARD", "Standard grade", "standard", "unit", True, True),
    ("PROMO", "Promotional grade", "promo", "unit", True, True),
    ("ECONOMY", "Economy grade", "economy", "unit", False, False),
]
PARITY_NUMERATOR = "Promotional grade"
PARITY_DENOMINATOR = "Standard grade"
# Cut date of the incremental-dimension experiment on this data.
CUT_DATE = "2001-01-01"
# Station used by the point lookup query.
LOOKUP_CNPJ = "00000000000007"
SELECTIVE_FROM, SELECTIVE_TO = "1998-01-01", "1998-03-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> region: fixed 25/5-row tables (TPC-H), so broadcasting them is
    size-safe at any scale factor."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean observation rows (before dedup), one per lineitem row.

    lineitem joins part and supplier directly, so the planner sees their real
    file sizes (broadcast while small, sort-merge once they grow with the
    scale factor; no hint). The fixed nation/region pair is joined last,
    broadcast.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    geo = _geo(spark, sf_dir)
    j = (li.join(part, li.l_partkey == part.p_partkey)
         .join(sup, li.l_suppkey == sup.s_suppkey)
         .join(F.broadcast(geo), sup.s_nationkey == geo.n_nationkey))
    return j.select(
        F.col("r_name").alias("region"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("city"),
        F.col("s_name").alias("reseller_name"),
        F.lpad(F.col("l_suppkey").cast("string"), 14, "0").alias("reseller_cnpj"),
        F.col("p_type").alias("product"),
        F.col("l_shipdate").cast("date").alias("collection_date"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast(K.PRICE_TYPE).alias("sale_price"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("brand"),
        F.concat(F.lit("file-"), (F.col("l_orderkey") % 7).cast("string")).alias("source_file"),
        "l_orderkey", "l_linenumber", "l_partkey",
    )


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped rendering: the 16 survey columns as text plus source_file.

    Faults are planted by rule on l_orderkey so that every reject reason, the
    blank row and the text normalisation are exercised on whole tables.
    """
    o = observations(spark, sf_dir)
    k = F.col("l_orderkey")
    blank = (k % 331) == 0

    def nb(c):
        return F.when(~blank, c)

    date_txt = F.when(k % 97 == 1, F.lit("31/02/2024")).otherwise(
        F.date_format("collection_date", "dd/MM/yyyy"))
    price_txt = F.when(k % 89 == 2, F.lit("n/d")).otherwise(
        F.regexp_replace(F.col("sale_price").cast("string"), r"\.", ","))
    cnpj_txt = F.when(k % 83 == 3, F.lit("123")).otherwise(F.col("reseller_cnpj"))
    product_txt = F.when(k % 79 != 4, F.concat(F.lit(" "), F.lower("product"), F.lit("  x ")))
    none = F.lit(None).cast("string")
    cols = {
        "region": F.col("region"), "state": F.col("state"), "city": F.col("city"),
        "reseller_name": F.col("reseller_name"), "reseller_cnpj": cnpj_txt,
        "street_name": none, "street_number": none, "complement": none,
        "neighborhood": none, "postal_code": none, "product": product_txt,
        "collection_date": date_txt, "sale_price": price_txt, "purchase_price": none,
        "unit_of_measure": none, "brand": F.col("brand"),
    }
    return o.select(*[nb(cols[c]).alias(c) for c in K.BRONZE_COLUMNS], "source_file")


def alias_map(spark: SparkSession, rows=None) -> DataFrame:
    """A literal list, so broadcasting it is size-safe at any scale factor (the planner
    has no size for it and would shuffle the other side by label, a handful of values)."""
    rows = ALIASES if rows is None else rows
    return F.broadcast(spark.createDataFrame(
        rows, "source_brand string, canonical_brand string, rationale string"))


def curated_products(spark: SparkSession, rows=None) -> DataFrame:
    rows = CURATED if rows is None else rows
    return F.broadcast(spark.createDataFrame(
        rows,
        "source_product_name string, product_name string, fuel_family string, "
        "unit_of_measure string, is_liquid_fuel boolean, in_default_scope boolean",
    ))


# Planted cases of registered queries: an alias whose target no row has, a city
# name of several states.
ABSENT_ALIAS = ("ZZ", "QQ", "planted: target absent from the data")
SHARED_CITY = "SANTA RITA"


def plant_malformed(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """Beside the landed files, one file per source with a short or an over-long
    line for every order with l_orderkey % 101 = 7."""
    rows = observations(spark, sf_dir).where(F.col("l_orderkey") % 101 == 7)
    key = F.concat_ws(";", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    line = F.when(F.col("l_linenumber") % 2 == 0, key).otherwise(
        F.concat(key, F.repeat(F.lit(";v"), len(K.SOURCE_HEADER))))
    lines = rows.select(line.alias("value"), "source_file", F.lit(1).alias("_o"))
    heads = lines.select(F.lit(";".join(K.SOURCE_HEADER)).alias("value"), "source_file",
                         F.lit(0).alias("_o")).distinct()
    (heads.unionByName(lines).repartition("source_file").sortWithinPartitions("source_file", "_o")
     .select("value", "source_file").write.mode("append").partitionBy("source_file")
     .option("sep", "\u0001").option("quote", "").csv(landing))  # whole lines, as they are

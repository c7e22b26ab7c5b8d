"""Bronze text -> typed silver rows, with every unusable row kept as a reject.

``classify`` converts each row once and adds the reject reason (NULL: accepted);
materialise it, and both outputs are plain filters on that column. Conversion is tolerant (try_to_date / try_cast): a value that
does not convert becomes NULL and is then classified, never raised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrid import constants as K
from pricegrid.functions.text import decimal_comma, digits, squeeze, strict_date

SILVER_COLUMNS = [
    "region", "state", "city", "reseller_name", "reseller_cnpj", "street_name",
    "street_number", "neighborhood", "postal_code", "product", "collection_date",
    "sale_price", "purchase_price", "unit_of_measure", "brand", "source_file",
]
REJECT_COLUMNS = ["source_file", "collection_date_raw", "sale_price_raw",
                  "reseller_cnpj_raw", "product", "reason"]


def drop_blank(df: DataFrame, cols=K.DATA_COLUMNS) -> DataFrame:
    """Drop rows whose data columns are all NULL (blank lines of the source)."""
    return df.where(F.coalesce(*[F.col(c) for c in cols]).isNotNull())


def blank_rows(df: DataFrame, cols=K.DATA_COLUMNS) -> DataFrame:
    return df.where(F.coalesce(*[F.col(c) for c in cols]).isNull())


def convert(df: DataFrame) -> DataFrame:
    """Typed and normalised columns, plus the raw text of converted fields.
    ``complement`` is dropped on purpose: unstable free text."""
    extra = [c for c in df.columns if c not in K.BRONZE_COLUMNS]
    return df.select(
        squeeze("region", upper=True).alias("region"),
        squeeze("state", upper=True).alias("state"),
        squeeze("city").alias("city"),
        squeeze("reseller_name").alias("reseller_name"),
        digits("reseller_cnpj").alias("reseller_cnpj"),
        squeeze("street_name").alias("street_name"),
        squeeze("street_number").alias("street_number"),
        squeeze("neighborhood").alias("neighborhood"),
        digits("postal_code").alias("postal_code"),
        squeeze("product").alias("product"),
        strict_date("collection_date").alias("collection_date"),
        decimal_comma("sale_price").alias("sale_price"),
        decimal_comma("purchase_price").alias("purchase_price"),
        squeeze("unit_of_measure").alias("unit_of_measure"),
        squeeze("brand", upper=True).alias("brand"),
        F.col("collection_date").alias("collection_date_raw"),
        F.col("sale_price").alias("sale_price_raw"),
        F.col("reseller_cnpj").alias("reseller_cnpj_raw"),
        *extra,
    )


def reason() -> Column:
    """First matching reason wins: date, price, tax id, product; NULL: usable."""
    cnpj = F.col("reseller_cnpj")
    return (F.when(F.col("collection_date").isNull(), K.REJECT_DATE)
            .when(F.col("sale_price").isNull(), K.REJECT_PRICE)
            .when(cnpj.isNull() | (F.length(cnpj) != K.TAX_ID_LENGTH), K.REJECT_TAX_ID)
            .when(F.col("product").isNull(), K.REJECT_PRODUCT))


def classify(df: DataFrame) -> DataFrame:
    """Converted rows with their reject ``reason``."""
    return convert(df).withColumn("reason", reason())


def rejects(classified: DataFrame, with_clock: bool = False) -> DataFrame:
    out = classified.where(F.col("reason").isNotNull()).select(*REJECT_COLUMNS)
    return out.withColumn("evaluated_at", F.current_timestamp()) if with_clock else out


def accepted(classified: DataFrame, carry=()) -> DataFrame:
    """The silver columns, and those of ``carry``, of usable rows."""
    return classified.where(F.col("reason").isNull()).select(*SILVER_COLUMNS, *carry)


def reason_counts(rej: DataFrame) -> DataFrame:
    return (rej.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))
            .orderBy(F.desc("row_count"), "reason"))


def profile(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.min("collection_date").alias("first_collection"),
        F.max("collection_date").alias("last_collection"),
        F.count_distinct("reseller_cnpj").alias("stations"),
        F.count_distinct("product").alias("products"),
        F.count_distinct("brand").alias("brands"),
        # NULL in either part drops the row from the count, as in the survey
        F.count_distinct(F.concat(F.col("state"), F.lit("|"), F.col("city"))).alias("cities"),
    )

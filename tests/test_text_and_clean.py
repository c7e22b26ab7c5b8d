"""Conversion traps: strict dates, decimal comma, space squeezing, rejects."""

from decimal import Decimal

from pyspark.sql import functions as F

from pricegrid import constants as K
from pricegrid.functions.text import decimal_comma, digits, fold_name, squeeze, strict_date
from pricegrid.operators import clean


def one_col(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn("x")).collect()]


def test_strict_date_refuses_lenient_forms(spark):
    got = one_col(spark, ["1/2/2024", "30/02/2024", " 31/12/2024", "31/12/2024", None], strict_date)
    assert got[:3] == [None, None, None]
    assert str(got[3]) == "2024-12-31" and got[4] is None


def test_decimal_comma(spark):
    got = one_col(spark, ["", "1.234.56", " 5,1 ", "1e2", "5,4565", "4,599", "n/d"], decimal_comma)
    assert got[0] is None and got[1] is None and got[6] is None
    assert got[2] == Decimal("5.100")
    assert got[3] == Decimal("100.000")
    assert got[4] == Decimal("5.457")  # half up
    assert got[5] == Decimal("4.599")


def test_squeeze_only_ascii_spaces(spark):
    got = one_col(spark, ["  AV  MAJOR   PINHEIRO ", "a\t\tb", "a  b"], squeeze)
    assert got[0] == "AV MAJOR PINHEIRO"
    assert got[1] == "a\t\tb"            # tabs are not collapsed
    assert got[2] == "a b"
    assert one_col(spark, ["12.345.678/0001-90"], digits) == ["12345678000190"]


def test_fold_name():
    names = ["\ufeffRegiao - Sigla", "Município", "Munici\u0301pio", " CNPJ da Revenda ", "ĄŽŐ"]
    assert [fold_name(n) for n in names] == ["regiao - sigla", "municipio", "municipio", "cnpj da revenda", "azo"]


def _bronze_row(**kw):
    row = {c: None for c in K.BRONZE_COLUMNS}
    row.update(region="se", state="sp", city="Sao  Paulo", reseller_name="Posto  A",
               reseller_cnpj="12.345.678/0001-90", product=" GASOLINA ",
               collection_date="02/01/2024", sale_price="5,899", brand=" vibra ")
    row.update(kw)
    return row


def test_reject_first_reason_wins_and_blank_rows(spark):
    rows = [
        _bronze_row(),
        _bronze_row(collection_date="31/02/2024", sale_price="n/d"),   # date first
        _bronze_row(sale_price="n/d", reseller_cnpj="123"),            # price before id
        _bronze_row(reseller_cnpj="123", product=None),                # id before product
        _bronze_row(product=None),
        {c: None for c in K.BRONZE_COLUMNS},                           # blank row
        _bronze_row(purchase_price="abc"),                             # bad purchase: accepted
    ]
    schema = ", ".join(f"{c} string" for c in K.BRONZE_COLUMNS)
    df = spark.createDataFrame([tuple(r[c] for c in K.BRONZE_COLUMNS) for r in rows], schema)
    df = df.withColumn("source_file", F.lit("f1"))
    assert clean.blank_rows(df).count() == 1
    judged = clean.classify(clean.drop_blank(df))
    ok, rej = clean.accepted(judged), clean.rejects(judged)
    reasons = sorted(r.reason for r in rej.collect())
    assert reasons == sorted([K.REJECT_DATE, K.REJECT_PRICE, K.REJECT_TAX_ID, K.REJECT_PRODUCT])
    good = ok.collect()
    assert len(good) == 2
    g = good[0]
    assert (g.region, g.state, g.city, g.reseller_name, g.brand, g.product) == (
        "SE", "SP", "Sao Paulo", "Posto A", "VIBRA", "GASOLINA")
    assert g.reseller_cnpj == "12345678000190" and g.sale_price == Decimal("5.899")
    assert "complement" not in ok.columns

"""Text normalisation and tolerant conversion, as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricegrid import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(c, upper: bool = False) -> Column:
    """trim, then collapse runs of ASCII space to one. Tabs and NBSP stay."""
    out = F.regexp_replace(F.trim(_col(c)), " +", " ")
    return F.upper(out) if upper else out


def digits(c) -> Column:
    """Keep digits only."""
    return F.regexp_replace(_col(c), "[^0-9]", "")


def strict_date(c, fmt: str = K.DATE_FORMAT) -> Column:
    """Date or NULL; no partial or lenient parse (1/2/2024, 30/02/2024 -> NULL)."""
    return F.try_to_date(_col(c), fmt)


def decimal_comma(c, type_: str = K.PRICE_TYPE) -> Column:
    """'4,599' -> 4.599 as DECIMAL(10,3) or NULL; rounds half up."""
    return F.replace(_col(c), F.lit(","), F.lit(".")).try_cast(type_)


def fold_name(name: str) -> str:
    """Header folding: drop BOM, accents (composed or decomposed) and case, trim."""
    plain = unicodedata.normalize("NFKD", name.replace("\ufeff", ""))
    return "".join(c for c in plain if not unicodedata.combining(c)).strip().lower()

"""Hash keys.

Keys are SHA-256 hex of the natural value, so two builds on different systems
give the same key and can be compared with an anti-join. All JVM-side.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def natural_key(*cols) -> Column:
    """sha2 of the values joined by '|'. NULL parts are skipped (concat_ws)."""
    return F.sha2(F.concat_ws("|", *[_col(c) for c in cols]), 256)


def attribute_hash(cols: Iterable) -> Column:
    """sha2 over attributes with NULL read as ''. NULL and '' hash alike on
    purpose (parity with the survey build); a '|' inside a value is ambiguous."""
    return F.sha2(attribute_state(cols), 256)


def attribute_state(cols: Iterable) -> Column:
    """What ``attribute_hash`` digests."""
    return F.concat_ws("|", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


def version_key(key_col, date_col) -> Column:
    """Surrogate key of a versioned row: natural key plus its start date."""
    return natural_key(_col(key_col), _col(date_col).cast("string"))


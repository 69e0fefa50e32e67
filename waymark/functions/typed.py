"""Numbers in columns of strings, as people type them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal(c: str) -> Column:
    """A number as people type it: outer space, degree sign, decimal comma."""
    return F.regexp_replace(F.regexp_replace(c, r"[^0-9.,+\-eE]", ""), ",", ".").try_cast("double")


def tolerance_km(c: str, default: float) -> Column:
    """The first number of a text such as ``5``, ``5 km`` or ``2,5 km``; ``default`` where there is none above zero."""
    number = F.regexp_extract(c, "([0-9]+(?:[.,][0-9]+)?)", 1)
    km = F.regexp_replace(number, ",", ".").try_cast("double")
    return F.when(km > 0, km).otherwise(default)

"""Normal forms of identifiers and closed vocabularies, as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tier vocabulary, lowest first.
TIERS = ["Local", "Notable", "Major", "Icon"]


def qid(c: str | Column) -> Column:
    """``Q`` and digits, whatever the case, prefix or outer space; null for anything else."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_extract(F.upper(c), r"(?:^|[^A-Z0-9])(Q[0-9]+)[\s ]*$", 1), F.lit(""))


def squeeze(c: str | Column) -> Column:
    """Outer white space removed; blank becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", ""), F.lit(""))


def place_id(c: str | Column) -> Column:
    return F.lower(squeeze(c))


def country(c: str | Column) -> Column:
    return F.upper(squeeze(c))


def tier(c: str | Column) -> Column:
    """The vocabulary's spelling of a tier; null when it is not one."""
    word = F.initcap(F.lower(squeeze(c)))
    return F.when(word.isin(TIERS), word)


def tier_rank(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(TIERS))):
        out = F.when(c == name, F.lit(i)).otherwise(out)
    return out


def count_or_null(c: str | Column) -> Column:
    """A count; negative and missing become null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c >= 0, c)

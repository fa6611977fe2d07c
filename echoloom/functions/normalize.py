"""Normalisers as Column expressions: no Python runs for a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Risk bands by rank.
BANDS = ("NONE", "LOW", "LOW-MED", "MED-HIGH", "HIGH")
#: Other spellings of bands.
BAND_ALIASES = {"": "NONE", "NO-RISK": "NONE", "LOW-MEDIUM": "LOW-MED", "MEDIUM-HIGH": "MED-HIGH", "MED": "LOW-MED", "MEDIUM": "LOW-MED"}
#: Parts of a driver's name that tell its hazard, in order.
HAZARD_PARTS = (
    ("drought", "drought|dry"), ("ponding_flooding", "pond|flood|waterlog"), ("heat", "heat|hot|temperature"), ("damaging_wind", "wind"),
)
#: Names that mean no hazard.
NO_HAZARD = ("", "none", "null", "nan", "no_risk")


def token(value: Column, join: str = "_") -> Column:
    """Lower-case words joined by `join`."""
    plain = F.regexp_replace(F.lower(F.trim(F.coalesce(value, F.lit("")))), "[^a-z0-9]+", join)
    return F.regexp_replace(plain, f"^{join}+|{join}+$", "")


def filled(value: Column, fallback: str) -> Column:
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(fallback))


def risk_rank(value: Column) -> Column:
    """0 to 4; an unknown band is 0."""
    text = F.upper(token(value, "-"))
    out = F.lit(0)
    for rank, band in enumerate(BANDS):
        names = [band, *(k for k, v in BAND_ALIASES.items() if v == band)]
        out = F.when(text.isin(names), rank).otherwise(out) if rank else out
    return out.cast("int")


def band_of(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, BANDS)), rank + 1)


def hazard_family(value: Column) -> Column:
    text = token(value)
    out = F.when(text.isin(*NO_HAZARD), "none")
    for name, parts in HAZARD_PARTS:
        out = out.when(text.rlike(parts), name)
    return out.otherwise(text)


def stage_family(value: Column) -> Column:
    return F.coalesce(F.nullif(token(value), F.lit("")), F.lit("unknown"))


def stable_id(prefix: str, *parts: Column, length: int = 24) -> Column:
    """A content address: null parts count as empty, which concat_ws would leave out."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(F.concat_ws("\x1f", *texts), 256), 1, length))


def week_of(day: Column) -> Column:
    """The Monday of a day's week."""
    return F.date_trunc("week", day).cast("date")

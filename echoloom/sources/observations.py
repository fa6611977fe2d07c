"""The canonical daily observation: alias-tolerant reading, and a bounded deterministic sample."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Canonical columns, their types, and other names they go by.
REQUIRED = {
    "field_id": ("string", ("field", "fieldid", "plot_id")),
    "observation_date": ("date", ("date", "calendar_date", "obs_date")),
    "crop_name": ("string", ("crop",)),
    "crop_season": ("string", ("season",)),
    "crop_stage": ("string", ("stage", "growth_stage")),
    "risk_level": ("string", ("risk", "overall_risk")),
    "primary_risk_driver": ("string", ("risk_driver", "driver", "hazard")),
    "spectral_echo_days": ("int", ("echo_days", "echo")),
    "ndvi": ("double", ("mean_ndvi",)),
    "ndmi": ("double", ("mean_ndmi",)),
    "psri": ("double", ("mean_psri",)),
}
OPTIONAL = {
    "spi_index": ("double", ("spi",)), "ponding_mm": ("double", ("ponding",)), "temperature": ("double", ("temp",)),
    "apparent_temperature": ("double", ("feels_like",)), "humidity": ("double", ("relative_humidity",)), "wind_speed": ("double", ("wind",)),
}


def _plain(name: str) -> str:
    return re.sub("[^a-z0-9]+", "_", name.lower()).strip("_")


def canonical(df: DataFrame) -> DataFrame:
    """Columns by name or alias, case and punctuation apart; optional ones may be missing (null)."""
    have: dict[str, str] = {}
    for name in df.columns:
        have.setdefault(_plain(name), name)
    columns, missing = [], []
    for name, (kind, aliases) in (REQUIRED | OPTIONAL).items():
        found = next((have[a] for a in (name, *aliases) if a in have), None)
        if found is None and name in REQUIRED:
            missing.append(name)
        value = F.expr(f"try_cast(`{found}` as {kind})") if found else F.lit(None).cast(kind)
        columns.append((F.nullif(F.trim(value), F.lit("")) if kind == "string" and name != "risk_level" else value).alias(name))
    if missing:
        raise ValueError("columns are missing: " + ", ".join(missing))
    return df.select(*columns).where("field_id is not null and observation_date is not null")


def within(df: DataFrame, until: str, since: str | None = None, most_fields: int | None = None) -> DataFrame:
    """Observations known at `until`; of at most so many fields, chosen by the hash of their ids."""
    df = df.where(F.col("observation_date") <= F.lit(until).cast("date"))
    if since:
        df = df.where(F.col("observation_date") >= F.lit(since).cast("date"))
    if most_fields:
        chosen = df.select("field_id").distinct().orderBy(F.md5("field_id"), "field_id").limit(most_fields)
        df = df.join(chosen, "field_id", "left_semi")
    return df


def from_events(events: DataFrame) -> DataFrame:
    """Observations made of the driver's event table: a user is a field, an event a daily reading."""
    number, day = F.col("event_id"), F.to_date("ts")
    month_day = F.dayofmonth(day)
    risk = F.create_map(*[F.lit(x) for pair in (("view", "LOW"), ("click", "LOW-MED"), ("purchase", "MED-HIGH"), ("error", "HIGH")) for x in pair])
    driver = F.array(*map(F.lit, ("Dry spell", "Flood", "Heat stress", "Strong wind", "")))

    def index(first: float, factor: int, span: int):
        return F.lit(first) + (number * factor % span).cast("double") / F.lit(100.0)

    return events.select(
        F.concat(F.lit("field-"), F.col("user_id").cast("string")).alias("field_id"),
        day.alias("observation_date"),
        F.element_at(F.array(F.lit("Maize"), F.lit("Beans"), F.lit("Rice")), (F.col("user_id") % 3 + 1).cast("int")).alias("crop_name"),
        F.when(month_day < 16, "A").otherwise("B").alias("crop_season"),
        F.when(month_day <= 3, "Off Season").when(month_day <= 12, "Vegetative").when(month_day <= 22, "Flowering").otherwise("Maturity").alias("crop_stage"),
        F.element_at(risk, F.col("event_type")).alias("risk_level"),
        F.element_at(driver, (number % 5 + 1).cast("int")).alias("primary_risk_driver"),
        F.when(number % 17 != 0, number % 4).cast("int").alias("spectral_echo_days"),
        index(0.3, 7, 40).alias("ndvi"), index(0.1, 11, 30).alias("ndmi"), index(0.05, 13, 25).alias("psri"),
        *[F.lit(None).cast(kind).alias(name) for name, (kind, _) in OPTIONAL.items()],
    )


def places(events: DataFrame) -> DataFrame:
    """A centroid for each field of `from_events`."""
    user = F.col("user_id")
    return events.select("user_id").distinct().select(
        F.concat(F.lit("field-"), user.cast("string")).alias("field_id"),
        (F.lit(29.0) + (user % 40).cast("double") * 0.03).alias("centroid_lon"), (F.lit(-2.0) + F.floor(user / 40).cast("double") * 0.02).alias("centroid_lat"),
    )

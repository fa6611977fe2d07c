"""Causal daily signals: what a day's observation adds, using nothing learnt later."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echoloom.functions import normalize as nz
from echoloom.functions.statistics import finite

INDICES = ("ndvi", "ndmi", "psri")


@dataclass(frozen=True)
class Policy:
    """Thresholds; the figures are fixed values of the monitored programme."""

    version: str = "weekly-story-monitor-v1.0.0-uncalibrated"
    instance_gap_days: int = 60
    fresh_days: int = 7
    aging_days: int = 14
    reference_days: tuple[int, int] = (7, 21)
    medium: dict = field(default_factory=lambda: {"ndvi": -0.08, "ndmi": -0.06, "psri": 0.05})
    severe: dict = field(default_factory=lambda: {"ndvi": -0.15, "ndmi": -0.10, "psri": 0.10})
    recovery: dict = field(default_factory=lambda: {"ndvi": 0.05, "ndmi": 0.04, "psri": -0.05})
    data_gap_days: int = 7
    recovery_days: int = 28
    quiet_days: dict = field(default_factory=lambda: {"heat": 4, "damaging_wind": 4, "ponding_flooding": 7, "drought": 14, "unattributed_decline": 7, "other": 7})


def daily_pressure(df: DataFrame) -> DataFrame:
    """One row a field and day: the one of the highest rank, then by crop, season and hazard."""
    out = df.withColumns({c: nz.filled(F.col(c), f"unknown_{c.removeprefix('crop_') if c != 'crop_name' else 'crop'}") for c in ("crop_name", "crop_season", "crop_stage")})
    observed = F.coalesce(F.trim("risk_level") != "", F.lit(False))
    out = out.withColumn("pressure_observed", observed).withColumn("risk_rank", F.when(observed, nz.risk_rank(F.col("risk_level"))).otherwise(0))
    out = out.withColumns({"risk_band": nz.band_of(F.col("risk_rank")), "hazard_family": nz.hazard_family(F.col("primary_risk_driver")), "stage_family": nz.stage_family(F.col("crop_stage"))})
    rest = ["stage_family", "spectral_echo_days", *INDICES]
    order = Window.partitionBy("field_id", "observation_date").orderBy(F.desc("risk_rank"), "crop_name", "crop_season", "hazard_family", *rest)
    return out.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def crop_instances(df: DataFrame, policy: Policy) -> DataFrame:
    """Contiguous regimes of a field: a new one at another crop or season, a gap, or the end of an off season."""
    days = Window.partitionBy("field_id").orderBy("observation_date")
    crop, season = F.lag("crop_name").over(days), F.lag("crop_season").over(days)
    starts = (
        crop.isNull() | (crop != F.col("crop_name")) | (season != F.col("crop_season"))
        | (F.date_diff("observation_date", F.lag("observation_date").over(days)) > policy.instance_gap_days)
        | ((F.lag("stage_family").over(days) == "off_season") & (F.col("stage_family") != "off_season"))
    )
    marked = df.withColumn("__start", F.when(starts, F.col("observation_date")))
    begun = F.last("__start", ignorenulls=True).over(days.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = marked.withColumn("crop_instance_start_date", begun).drop("__start")
    return out.withColumn("crop_instance_id", nz.stable_id("crop", F.col("field_id"), F.col("crop_name"), F.col("crop_season"), F.col("crop_instance_start_date")))


def acquisitions(df: DataFrame, policy: Policy) -> DataFrame:
    """The day a spectral value is from, whether it is new within the instance, and how fresh."""
    age = F.col("spectral_echo_days")
    out = df.withColumn("spectral_source_date", F.date_sub("observation_date", age))
    first = Window.partitionBy("crop_instance_id", "spectral_source_date").orderBy("observation_date")
    out = out.withColumn("is_new_acquisition", F.col("spectral_source_date").isNotNull() & (F.row_number().over(first) == 1))
    fresh = F.when(age.isNull(), "missing").when(age <= policy.fresh_days, "fresh").when(age <= policy.aging_days, "aging").otherwise("stale")
    return out.withColumn("spectral_freshness", fresh)


def references(df: DataFrame, policy: Policy) -> DataFrame:
    """The latest earlier acquisition 7 to 21 days older, and the change of each index since.

    The range condition becomes an equality: days are cut into bins as wide as the range, and a new
    acquisition looks into the one or two bins that its range touches.
    """
    least, most = policy.reference_days
    day = F.unix_date("spectral_source_date")
    new = df.where("is_new_acquisition")
    older = new.select(
        "crop_instance_id", F.floor(day / most).alias("bin"), F.col("spectral_source_date").alias("ref_date"), F.col("observation_date").alias("ref_seen"),
        *[F.when(finite(F.col(i)), F.col(i)).alias(f"ref_{i}") for i in INDICES],
    )
    bins = F.array_distinct(F.array(F.floor((day - most) / most), F.floor((day - least) / most)))
    wanted = new.select("crop_instance_id", "observation_date", "spectral_source_date", F.explode(bins).alias("bin"))
    pairs = wanted.join(older, ["crop_instance_id", "bin"]).where(
        (F.col("ref_seen") < F.col("observation_date")) & F.date_diff("spectral_source_date", "ref_date").between(least, most)
    )
    kept = F.max(F.struct("ref_date", *[f"ref_{i}" for i in INDICES])).alias("ref")
    best = pairs.groupBy("crop_instance_id", "observation_date").agg(kept)
    out = df.join(best, ["crop_instance_id", "observation_date"], "left")
    deltas = {f"{i}_delta": F.when(finite(F.col(i)), F.col(i) - F.col(f"ref.ref_{i}")) for i in INDICES}
    return out.withColumns({"reference_source_date": F.col("ref.ref_date"), **deltas}).drop("ref")


def responses(df: DataFrame, policy: Policy) -> DataFrame:
    """How the crop answered: the gravest class that any index shows, and which indices show it."""

    def shows(limits: dict, index: str, worse: bool):
        falls = (index != "psri") == worse
        change = F.col(f"{index}_delta")
        return F.coalesce(change <= limits[index] if falls else change >= limits[index], F.lit(False))

    known = F.col("reference_source_date").isNotNull()
    cls = F.when(F.col("spectral_source_date").isNull(), "spectral_missing").when(~F.col("is_new_acquisition"), "no_new_acquisition")
    cls = cls.when(F.col("spectral_freshness") == "stale", "stale_acquisition").when(~known, "insufficient_reference")
    evidence = F.when(F.coalesce(~F.col("is_new_acquisition"), F.lit(True)) | (F.col("spectral_freshness") == "stale") | ~known, "none")
    for name, limits, worse in (("severe_decline", policy.severe, True), ("medium_decline", policy.medium, True), ("recovery", policy.recovery, False)):
        flags = [shows(limits, i, worse) for i in INDICES]
        any_of = flags[0] | flags[1] | flags[2]
        cls = cls.when(any_of, name)
        evidence = evidence.when(any_of, F.concat_ws("+", *[F.when(f, i) for f, i in zip(flags, INDICES)]))
    some = F.coalesce(*[F.col(f"{i}_delta") for i in INDICES]).isNotNull()
    new = F.col("is_new_acquisition") & F.col("spectral_freshness").isin("fresh", "aging") & known
    return df.withColumns({
        "response_class": cls.when(some, "no_material_change").otherwise("insufficient_reference"),
        "response_evidence": evidence.otherwise("none"), "new_response_evidence": new,
    })


def causal_signals(observations: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """All of the above over canonical observations; one shuffle by field feeds most of it."""
    daily = crop_instances(daily_pressure(observations), policy)
    return responses(references(acquisitions(daily, policy), policy), policy)

"""Evidence ledgers with two clocks: what a day, a hazard or an acquisition says, and since when it is known."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echoloom.operators import temporal
from echoloom.operators.signals import INDICES, Policy


@dataclass(frozen=True)
class EvidencePolicy:
    """Score steps of the pressure ranks, and what an acquisition must be like."""

    steps: tuple[float, float, float] = (3.0, 5.0, 8.0)
    min_valid_fraction: float = 0.4
    max_cloud: float = 40.0
    bad_flags: tuple[str, ...] = ("no_valid_pixels", "poor")
    signal: Policy = Policy()


#: What makes a hazard's pressure observed, and the column of its score.
DRIVERS: dict[str, tuple[str, str]] = {
    "drought": ("spi_index is not null", "drought_score"), "ponding_flooding": ("ponding_mm is not null", "ponding_score"),
    "heat": ("temperature is not null and humidity is not null", "heat_score"), "damaging_wind": ("wind_speed is not null", "wind_score"),
}


def record_id(prefix: str, *parts: str) -> Column:
    return F.concat(F.lit(prefix + "_"), F.substring(F.md5(F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])), 1, 24))


def crop_days(source: DataFrame) -> DataFrame:
    """One row a field, instance and day: what grew there, since when that is known, what is missing."""
    crop, stage = (F.coalesce(F.trim(c), F.lit("")) == "" for c in ("crop_name", "stage_family"))
    return source.select(
        record_id("crop", "field_id", "crop_instance_id", "observation_date").alias("record_id"), "field_id", "crop_instance_id", "observation_date", F.col("stage_available_at").alias("knowledge_time"),
        "crop_name", F.col("stage_family").alias("stage_bucket"), (~crop & ~stage).alias("crop_context_observed"), F.when(crop, "crop_missing").when(stage, "stage_missing").alias("missing_reason"),
    )


def pressure_days(source: DataFrame, policy: EvidencePolicy = EvidencePolicy()) -> DataFrame:
    """Four lanes a day, by explosion of the row (no join): rank from the hazard's score, or the old rank for the main hazard."""
    low, middle, high = policy.steps
    lanes = F.array(*[F.struct(F.lit(h).alias("hazard"), F.expr(seen).alias("seen"), F.col(score).cast("double").alias("score")) for h, (seen, score) in DRIVERS.items()])
    rows = source.withColumn("lane", F.explode(lanes)).select("*", F.col("lane.hazard").alias("lane_hazard"), F.col("lane.seen").alias("observed"), F.col("lane.score").alias("score"))
    score = F.col("score")
    rank = F.when(~F.col("observed"), F.lit(None)).when(score >= high, 4).when(score >= middle, 3).when(score >= low, 2).when(score <= 0, 0).when(score.isNotNull(), 1)
    rank = rank.when(F.col("hazard_family") == F.col("lane_hazard"), F.col("risk_rank")).otherwise(0)
    rows = rows.withColumn("pressure_rank", rank.cast("int")).withColumn("hazard_family", F.col("lane_hazard"))
    return rows.select(
        record_id("pressure", "field_id", "crop_instance_id", "observation_date", "hazard_family").alias("record_id"), "field_id", "crop_instance_id", "observation_date",
        F.col("weather_available_at").alias("knowledge_time"), "hazard_family", F.col("observed").alias("pressure_observed"), score.alias("pressure_score"), "pressure_rank",
        F.coalesce(F.col("pressure_rank") >= 2, F.lit(False)).alias("pressure_active"),
    )


def acquisition_ledger(source: DataFrame, policy: EvidencePolicy = EvidencePolicy()) -> DataFrame:
    """One row an acquisition: first seen, owned by the crop of its day, judged, compared with an earlier usable one.

    Known once both the values and the crop assignment are; a reference must be known by then.
    """
    cells = ["ndvi", "ndmi", "psri", "valid_fraction", "cloud", "flag", "good"]
    first = F.min_by(F.struct(*cells), "observation_date").alias("first")
    seen = source.where("spectral_source_date is not null").groupBy("field_id", "spectral_source_date").agg(first, F.min("observation_date").alias("first_seen"))
    seen = seen.select("field_id", "spectral_source_date", "first_seen", "first.*")
    owners = source.select("field_id", "observation_date", "crop_instance_id", "stage_available_at")
    owned = temporal.asof_join(seen, owners, ["field_id"], "spectral_source_date", "observation_date", ["observation_date", "crop_instance_id", "stage_available_at"], "inner")
    known = F.greatest("first_seen", "stage_available_at")
    unknown = F.col("good").isNull() & F.col("valid_fraction").isNull() & F.col("cloud").isNull() & (F.coalesce(F.trim("flag"), F.lit("")) == "")
    status = (
        F.when(unknown, "rejected_qa_unknown").when(~F.coalesce("good", F.lit(True)), "rejected_no_valid_pixels").when(F.col("valid_fraction") < policy.min_valid_fraction, "rejected_sparse")
        .when(F.col("cloud") > policy.max_cloud, "rejected_cloud").when(F.lower("flag").isin(*policy.bad_flags), "rejected_quality")
        .when(F.coalesce(*INDICES).isNull(), "rejected_missing_indices").otherwise("usable")
    )
    base = owned.withColumns({"knowledge_time": known, "status": status}).withColumn("acquisition_id", record_id("s2", "field_id", "crop_instance_id", "spectral_source_date"))
    least, most = policy.signal.reference_days
    day = F.unix_date("spectral_source_date")
    usable = base.where("status = 'usable'")
    older = usable.select("field_id", "crop_instance_id", F.floor(day / most).alias("bin"), F.col("spectral_source_date").alias("ref_date"), F.col("knowledge_time").alias("ref_known"), *[F.col(i).alias(f"ref_{i}") for i in INDICES])
    bins = F.array_distinct(F.array(F.floor((day - most) / most), F.floor((day - least) / most)))
    wanted = usable.select("acquisition_id", "field_id", "crop_instance_id", "spectral_source_date", "knowledge_time", F.explode(bins).alias("bin"))
    pairs = wanted.join(older, ["field_id", "crop_instance_id", "bin"]).where((F.col("ref_known") <= F.col("knowledge_time")) & F.date_diff("spectral_source_date", "ref_date").between(least, most))
    best = pairs.groupBy("acquisition_id").agg(F.max(F.struct("ref_date", *[f"ref_{i}" for i in INDICES])).alias("ref"))
    out = base.join(best, "acquisition_id", "left").withColumns({"reference_source_date": F.col("ref.ref_date"), **{f"{i}_delta": F.col(i) - F.col(f"ref.ref_{i}") for i in INDICES}})

    def crossed(limits: dict, worse: bool) -> Column:
        a, b, c = ((F.col(f"{i}_delta") <= limits[i]) if (i != "psri") == worse else (F.col(f"{i}_delta") >= limits[i]) for i in INDICES)
        return F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)) | F.coalesce(c, F.lit(False))

    signal = policy.signal
    cls = F.when(F.col("status") != "usable", "not_evaluable").when(F.col("reference_source_date").isNull(), "insufficient_reference")
    cls = cls.when(crossed(signal.severe, True), "severe_decline").when(crossed(signal.medium, True), "medium_decline").when(crossed(signal.recovery, False), "recovery").otherwise("no_material_change")
    return out.select("acquisition_id", "field_id", "crop_instance_id", "spectral_source_date", "knowledge_time", "first_seen", "status", "reference_source_date", cls.alias("response_class"),
                      ((F.col("status") == "usable") & F.col("reference_source_date").isNotNull()).alias("new_response_evidence"))


def state_as_of(pressure: DataFrame, acquisitions: DataFrame, decision: str) -> DataFrame:
    """What was known of every field on a day: the latest pressure of each hazard, the held acquisition, its freshness."""
    day = F.lit(decision).cast("date")
    lanes = temporal.known_by(pressure.where(F.col("observation_date") <= day), ["field_id", "hazard_family"], "observation_date", "knowledge_time", day)
    fields = lanes.groupBy("field_id").agg(
        F.max("pressure_rank").alias("max_rank"), F.count_if("pressure_active").alias("active_hazards"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("pressure_active"), F.col("hazard_family")))), "+").alias("hazards"),
    )
    held = temporal.known_by(acquisitions.where((F.col("spectral_source_date") <= day) & (F.col("status") == "usable")), ["field_id"], "spectral_source_date", "knowledge_time", day)
    age = F.date_diff(day, "spectral_source_date")
    fresh = F.when(F.col("spectral_source_date").isNull(), "missing").when(age <= 7, "fresh").when(age <= 14, "aging").otherwise("stale")
    return fields.join(held.select("field_id", "spectral_source_date", "response_class"), "field_id", "left").withColumn("freshness", fresh)


def daily_timeline(pressure: DataFrame, acquisitions: DataFrame) -> DataFrame:
    """Every day of the ledger, evidence or none, with its counts; days come from a spine, not from the rows."""
    lanes = pressure.groupBy(F.col("observation_date").alias("day")).agg(
        F.countDistinct("field_id").alias("fields"), F.countDistinct(F.when(F.col("pressure_active"), F.col("field_id"))).alias("active_fields"), F.count_if(~F.col("pressure_observed")).alias("unobserved_lanes"))
    got = acquisitions.groupBy(F.col("spectral_source_date").alias("day")).agg(F.count_if(F.col("status") == "usable").alias("usable"), F.count_if(F.col("response_class").isin("medium_decline", "severe_decline")).alias("declines"))
    span = lanes.select("day").union(got.select("day")).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    spine = span.where("a is not null").select(F.explode(F.sequence("a", "b")).alias("day"))
    return spine.join(lanes, "day", "left").join(got, "day", "left").fillna(0)


def running_features(rows: DataFrame, key: str) -> DataFrame:
    """Causal prefixes: everything up to a day, one row a week (its last day); one sort by key feeds them all."""
    days = Window.partitionBy(key).orderBy("observation_date")
    prefix = days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    change = rows.withColumns({
        "up": F.coalesce((F.col("risk_rank") > F.lag("risk_rank").over(days)).cast("int"), F.lit(0)), "down": F.coalesce((F.col("risk_rank") < F.lag("risk_rank").over(days)).cast("int"), F.lit(0)),
        "moved": (~F.col("stage_family").eqNullSafe(F.lag("stage_family").over(days))).cast("int"),
    })
    age = F.date_diff("observation_date", F.min("observation_date").over(prefix))
    out = change.withColumns({
        "peak_rank": F.max("risk_rank").over(prefix), "mean_rank": F.avg("risk_rank").over(prefix), "age_days": age + 1,
        "rank_slope": (F.col("risk_rank") - F.first("risk_rank").over(prefix)) / F.greatest(F.lit(1), age), "escalations": F.sum("up").over(prefix), "deescalations": F.sum("down").over(prefix),
        "active_days": F.sum((F.col("risk_rank") >= 3).cast("int")).over(prefix), "severe_days": F.sum((F.col("risk_rank") >= 4).cast("int")).over(prefix), "stage_transitions": F.greatest(F.lit(0), F.sum("moved").over(prefix) - 1),
        "last_ndvi_delta": F.last("ndvi_delta", ignorenulls=True).over(prefix), "acquisitions": F.sum(F.col("is_new_acquisition").cast("int")).over(prefix),
        "coverage": F.count("*").over(prefix) / F.greatest(F.lit(1), age + 1), "timeline_bucket": F.date_trunc("week", "observation_date").cast("date"),
    })
    return temporal.latest(out, [key, "timeline_bucket"], [F.desc("observation_date")])

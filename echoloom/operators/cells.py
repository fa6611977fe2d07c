"""Weekly exposure cells: expected against seen activity on a metric grid, with false-discovery control."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echoloom.functions import normalize as nz
from echoloom.functions.statistics import benjamini_hochberg, normal_upper_tail


@dataclass(frozen=True)
class GridPolicy:
    """The grid's origin and scale, and the gates of a significant cell."""

    origin_lon: float = 29.0
    origin_lat: float = -2.0
    size_km: float = 5.0
    km_per_lat: float = 110.574
    km_per_lon_equator: float = 111.32
    prior_strength: float = 20.0
    min_evaluable: int = 20
    min_active: int = 3
    alpha: float = 0.1
    severe_fields: int = 2
    severe_fresh: int = 1

    @property
    def km_per_lon(self) -> float:
        return self.km_per_lon_equator * math.cos(math.radians(self.origin_lat))


STATE_BY_RANK = {2: "WATCH", 3: "ACTIVE", 4: "SEVERE"}


def field_weeks(signals: DataFrame, centroids: DataFrame) -> DataFrame:
    """One row a week, field and instance: its last stage, and whether anything was observed."""
    rows = signals.withColumn("timeline_bucket", nz.week_of(F.col("observation_date")))
    weeks = rows.groupBy("timeline_bucket", "field_id", "crop_instance_id").agg(
        F.max_by("stage_family", "observation_date").alias("stage_bucket"), F.max_by("crop_name", "observation_date").alias("crop_name"), F.bool_or("pressure_observed").alias("evaluable")
    )
    return weeks.join(centroids, "field_id", "left")


def week_lanes(signals: DataFrame) -> DataFrame:
    """One row a week, field and hazard: the state of the week's peak; the gravest lane is canonical."""
    rows = signals.where("pressure_observed and hazard_family <> 'none' and risk_rank >= 2").withColumn("timeline_bucket", nz.week_of(F.col("observation_date")))
    state = F.create_map(*[F.lit(x) for pair in STATE_BY_RANK.items() for x in pair])
    lanes = rows.groupBy("timeline_bucket", "field_id", "crop_instance_id", "hazard_family").agg(
        F.max("risk_rank").alias("rank"), F.bool_or(F.col("new_response_evidence") & F.col("response_class").isin("medium_decline", "severe_decline")).alias("fresh")
    )
    lanes = lanes.withColumn("event_state", F.element_at(state, F.col("rank")))
    order = Window.partitionBy("timeline_bucket", "field_id", "hazard_family").orderBy(F.desc("rank"), "crop_instance_id")
    return lanes.withColumn("canonical", F.row_number().over(order) == 1)


def stage_baseline(context: DataFrame, lanes: DataFrame, through: str, policy: GridPolicy = GridPolicy()) -> DataFrame:
    """Rates of active instances by hazard, stage and ISO week, shrunk towards the hazard-week's rate."""
    complete = F.date_add("timeline_bucket", 6) <= F.lit(through).cast("date")
    seen = context.where(complete & F.col("evaluable"))
    cohort = seen.groupBy("timeline_bucket", "stage_bucket").agg(F.countDistinct("crop_instance_id").alias("denominator"))
    hazards = lanes.where(complete).select("hazard_family").distinct()
    active = lanes.where(complete & F.col("canonical") & F.col("event_state").isin("ACTIVE", "SEVERE"))
    active = active.join(seen.select("timeline_bucket", "crop_instance_id", "stage_bucket"), ["timeline_bucket", "crop_instance_id"])
    affected = active.groupBy("timeline_bucket", "hazard_family", "stage_bucket").agg(F.countDistinct("crop_instance_id").alias("affected"))
    weekly = cohort.crossJoin(F.broadcast(hazards)).join(affected, ["timeline_bucket", "hazard_family", "stage_bucket"], "left")  # hazards: a handful of rows
    weekly = weekly.withColumn("iso_week", F.weekofyear("timeline_bucket")).fillna(0, ["affected"])
    stage = weekly.groupBy("hazard_family", "iso_week", "stage_bucket").agg(F.sum("affected").alias("affected_count"), F.sum("denominator").alias("evaluable_count"), F.count("*").alias("training_week_count"))
    whole = Window.partitionBy("hazard_family", "iso_week")
    rate = F.sum("affected_count").over(whole) / F.sum("evaluable_count").over(whole)
    k = policy.prior_strength
    return stage.withColumn("global_probability", rate).withColumn(
        "expected_probability", (F.col("affected_count") + k * F.col("global_probability")) / (F.col("evaluable_count") + k)
    )


def on_grid(context: DataFrame, policy: GridPolicy = GridPolicy()) -> DataFrame:
    x = F.floor((F.col("centroid_lon") - policy.origin_lon) * policy.km_per_lon / policy.size_km)
    y = F.floor((F.col("centroid_lat") - policy.origin_lat) * policy.km_per_lat / policy.size_km)
    return context.where("centroid_lon between -180 and 180 and centroid_lat between -90 and 90").withColumns({"cell_x": x, "cell_y": y})


def expected_activity(context: DataFrame, lanes: DataFrame, baseline: DataFrame, policy: GridPolicy = GridPolicy()) -> DataFrame:
    """For every week, hazard and cell with fields: counts, expectation, overdispersed variance, z."""
    cell = ["timeline_bucket", "cell_x", "cell_y"]
    located = on_grid(context, policy)
    stages = located.groupBy(*cell, "stage_bucket").agg(F.countDistinct(F.when(F.col("evaluable"), F.col("crop_instance_id"))).alias("n"), F.countDistinct("crop_instance_id").alias("monitored"))
    fields = located.groupBy(*cell).agg(F.countDistinct("field_id").alias("monitored_field_count"), F.countDistinct(F.when(F.col("evaluable"), F.col("field_id"))).alias("evaluable_field_count"))
    hazards = F.broadcast(baseline.select("hazard_family").distinct())
    whole = F.broadcast(baseline.groupBy("hazard_family", "iso_week").agg(F.max("global_probability").alias("g")))
    rates = baseline.select("hazard_family", "iso_week", "stage_bucket", "expected_probability")
    rows = stages.crossJoin(hazards).withColumn("iso_week", F.weekofyear("timeline_bucket"))
    rows = rows.join(F.broadcast(rates), ["hazard_family", "iso_week", "stage_bucket"], "left").join(whole, ["hazard_family", "iso_week"], "left")
    p = F.coalesce("expected_probability", "g", F.lit(0.0))
    spread = F.col("n") * p * (1 - p) * (1 + (F.col("n") - 1) / (policy.prior_strength + 1))
    expected = rows.groupBy(*cell, "hazard_family").agg(
        F.sum("monitored").alias("monitored_count"), F.sum("n").alias("evaluable_count"), F.sum(F.col("n") * p).alias("expected_active_count"), F.sum(spread).alias("expected_variance"),
        F.count_if(F.col("expected_probability").isNull() & F.col("g").isNull()).alias("missing_baseline_stage_count"),
    )
    canonical = lanes.where("canonical").join(located.select("timeline_bucket", "crop_instance_id", "cell_x", "cell_y"), ["timeline_bucket", "crop_instance_id"])
    pressed = F.col("event_state").isin("ACTIVE", "SEVERE")
    observed = canonical.groupBy(*cell, "hazard_family").agg(
        F.countDistinct(F.when(pressed, F.col("crop_instance_id"))).alias("active_count"), F.countDistinct(F.when(pressed, F.col("field_id"))).alias("active_field_count"),
        F.countDistinct(F.when(F.col("event_state") == "SEVERE", F.col("field_id"))).alias("severe_field_count"), F.countDistinct(F.when(F.col("fresh"), F.col("field_id"))).alias("fresh_response_field_count"),
    )
    counts = ["active_count", "active_field_count", "severe_field_count", "fresh_response_field_count"]
    out = expected.join(observed, [*cell, "hazard_family"], "left").fillna(0, counts).join(fields, cell)
    return out.withColumn("z_score", (F.col("active_count") - F.col("expected_active_count")) / F.sqrt(F.greatest("expected_variance", F.lit(1e-9))))


def significant_cells(activity: DataFrame, policy: GridPolicy = GridPolicy()) -> DataFrame:
    """One-sided p, q within week and hazard, and the gates."""
    out = activity.withColumn("p_value", normal_upper_tail("z_score"))
    out = benjamini_hochberg(out, ["timeline_bucket", "hazard_family"], "p_value", "q_value", ["cell_x", "cell_y"])
    covered = (F.col("evaluable_field_count") >= policy.min_evaluable) & (F.col("missing_baseline_stage_count") == 0)
    enough = covered & (F.col("active_field_count") >= policy.min_active)
    severe = covered & (F.col("severe_field_count") >= policy.severe_fields) & (F.col("fresh_response_field_count") >= policy.severe_fresh)
    found = enough & (F.col("q_value") <= policy.alpha)
    reason = F.when(severe, "multi_field_severe_fresh_response_override").when(found, "stage_adjusted_fdr").otherwise("not_significant")
    return out.withColumns({"passes_coverage_gate": covered, "passes_denominator_gate": enough, "is_significant": severe | found, "significance_reason": reason})

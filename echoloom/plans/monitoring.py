"""The monitoring queries over the driver's event table, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echoloom.durable import stored
from echoloom.functions import normalize as nz
from echoloom.functions.statistics import benjamini_hochberg_by_value
from echoloom.operators import cells, prototypes, signals, stories, temporal, tracking
from echoloom.operators.signals import Policy
from echoloom.sources import observations as obs

THROUGH = "2024-01-21"
AS_OF = "2024-01-31"
#: The driver's fields are few and close together: gates as the small tables need them.
GRID = cells.GridPolicy(min_evaluable=2, min_active=2)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.causal_signals(obs.canonical(obs.from_events(_events(spark, sf_dir))))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stories.daily_stories(_signals(spark, sf_dir))


def _parts(spark: SparkSession, sf_dir: str):
    """Field weeks and lanes, written once: several branches of a plan read them."""
    rows = stored(_signals(spark, sf_dir))
    return stored(cells.field_weeks(rows, obs.places(_events(spark, sf_dir)))), stored(cells.week_lanes(rows))


def canonical_sample(spark, sf_dir):
    return obs.within(obs.canonical(obs.from_events(_events(spark, sf_dir))), "2024-01-20", "2024-01-05", most_fields=5).select("field_id", "observation_date", "crop_name", "risk_level", "ndvi")


def daily_pressure(spark, sf_dir):
    rows = signals.daily_pressure(obs.canonical(obs.from_events(_events(spark, sf_dir))))
    return rows.select("field_id", "observation_date", "risk_rank", "risk_band", "hazard_family", "stage_family", "pressure_observed")


def causal_signals(spark, sf_dir):
    kept = ["field_id", "observation_date", "crop_instance_id", "crop_instance_start_date", "spectral_source_date", "spectral_freshness", "is_new_acquisition",
            "reference_source_date", "response_class", "response_evidence", "new_response_evidence"]
    deltas = [F.round(f"{i}_delta", 6).alias(f"{i}_delta") for i in signals.INDICES]
    return _signals(spark, sf_dir).select(*kept, *deltas)


def crop_instance_summary(spark, sf_dir):
    return stories.crop_instance_summary(_signals(spark, sf_dir))


def field_weeks(spark, sf_dir):
    context, _ = _parts(spark, sf_dir)
    return context.select("timeline_bucket", "field_id", "crop_instance_id", "stage_bucket", "evaluable", F.round("centroid_lon", 6).alias("centroid_lon"))


def week_lanes(spark, sf_dir):
    return _parts(spark, sf_dir)[1]


def stage_baseline(spark, sf_dir):
    context, lanes = _parts(spark, sf_dir)
    rounded = {c: F.round(c, 9) for c in ("global_probability", "expected_probability")}
    return cells.stage_baseline(context, lanes, THROUGH, GRID).withColumns(rounded)


def _activity(context, lanes):
    return cells.expected_activity(context, lanes, stored(cells.stage_baseline(context, lanes, THROUGH, GRID)), GRID)


def exposure_cells(spark, sf_dir):
    rounded = {c: F.round(c, 6) for c in ("expected_active_count", "expected_variance", "z_score")}
    kept = ["timeline_bucket", "hazard_family", "cell_x", "cell_y", "monitored_count", "evaluable_count", "monitored_field_count", "evaluable_field_count", "active_count",
            "active_field_count", "severe_field_count", "fresh_response_field_count", "missing_baseline_stage_count", *rounded]
    return _activity(*_parts(spark, sf_dir)).withColumns(rounded).select(*kept)


def significant_cells(spark, sf_dir):
    return cells.significant_cells(_activity(*_parts(spark, sf_dir)), GRID)


def _placed_lanes(context, lanes):
    """Canonical lanes with their cell, stage and crop; an episode is a field, instance and hazard."""
    places = cells.on_grid(context, GRID).select("timeline_bucket", "crop_instance_id", "cell_x", "cell_y", F.col("stage_bucket").alias("stage_family"), "crop_name")
    rows = lanes.where("canonical").join(places, ["timeline_bucket", "crop_instance_id"])
    return rows.withColumn("episode_id", nz.stable_id("episode", F.col("field_id"), F.col("crop_instance_id"), F.col("hazard_family")))


def frontier_rows(spark, sf_dir):
    """Fields within one cell of a significant cell."""
    context, lanes = _parts(spark, sf_dir)
    found = cells.significant_cells(_activity(context, lanes), GRID).where("is_significant").select("timeline_bucket", "hazard_family", "cell_x", "cell_y")
    rows = _placed_lanes(context, lanes).select("timeline_bucket", "hazard_family", "cell_x", "cell_y", "field_id", "event_state")
    return temporal.near_cells(rows, found, ["timeline_bucket", "hazard_family"], "cell_x", "cell_y", 1)


def _tracked(spark, sf_dir):
    """Components with their sets, members, and scored links, each written once."""
    context, lanes = _parts(spark, sf_dir)
    labelled = tracking.weekly_components(cells.significant_cells(_activity(context, lanes), GRID).where("is_significant"))
    comps = stored(tracking.component_summary(labelled))
    members = stored(tracking.component_members(comps, _placed_lanes(context, lanes)))
    comps = stored(tracking.member_sets(comps, members))
    return comps, members, stored(tracking.score_links(comps))


def weekly_components(spark, sf_dir):
    comps, _, _ = _tracked(spark, sf_dir)
    return comps.select("timeline_bucket", "hazard_family", "component_id", "cell_count", F.to_json("cells").alias("cell_ids_json"), F.size("fields").alias("field_count"))


def component_members(spark, sf_dir):
    _, members, _ = _tracked(spark, sf_dir)
    return members.select("timeline_bucket", "hazard_family", "component_id", "field_id", "event_state", "membership_role", "away")


def link_scores(spark, sf_dir):
    return _tracked(spark, sf_dir)[2]


def _tracks(spark, sf_dir):
    comps, members, scores = _tracked(spark, sf_dir)
    return comps, members, stored(tracking.track(comps, scores))


def primary_links(spark, sf_dir):
    return tracking.assignments(_tracks(spark, sf_dir)[2]).where("assignment_kind = 'continued'")


def exposure_lineage(spark, sf_dir):
    return tracking.lineage(_tracks(spark, sf_dir)[2])


def exposures(spark, sf_dir):
    return tracking.assignments(_tracks(spark, sf_dir)[2]).select("component_id", "exposure_id", "assignment_kind")


def exposure_weeks(spark, sf_dir):
    _, members, tracked = _tracks(spark, sf_dir)
    return tracking.exposure_weeks(members, tracking.assignments(tracked))


def crop_incidents(spark, sf_dir):
    _, members, tracked = _tracks(spark, sf_dir)
    return tracking.crop_incidents(members, tracking.assignments(tracked))


def crop_lineage(spark, sf_dir):
    _, members, tracked = _tracks(spark, sf_dir)
    return tracking.incident_lineage(tracking.lineage(tracked), tracking.crop_incidents(members, tracking.assignments(tracked)))


def daily_stories(spark, sf_dir):
    return _daily(spark, sf_dir)


def event_windows(spark, sf_dir):
    return stories.event_windows(_daily(spark, sf_dir), AS_OF)


def weekly_snapshots(spark, sf_dir):
    return stories.weekly_snapshots(_daily(spark, sf_dir))


def map_frames(spark, sf_dir):
    return stories.map_frames(_daily(spark, sf_dir))


def onset_labels(spark, sf_dir):
    return stories.onset_labels(_daily(spark, sf_dir))


def incident_lifecycles(spark, sf_dir):
    """Every field and hazard as an incident, followed over the weeks in which the field is seen."""
    context, lanes = _parts(spark, sf_dir)
    weeks = context.groupBy("field_id", "timeline_bucket").agg(F.bool_or("evaluable").alias("adequate"))
    own = lanes.where("canonical").groupBy("timeline_bucket", "field_id", "hazard_family").agg(
        F.max(F.when(F.col("rank") >= 3, 1).otherwise(0)).alias("hot"), F.max(F.when(F.col("event_state") == "SEVERE", 1).otherwise(0)).alias("severe"), F.max(F.col("fresh").cast("int")).alias("fresh_decline")
    )
    begun = own.groupBy("field_id", "hazard_family").agg(F.min("timeline_bucket").alias("begun"))
    rows = weeks.join(begun, "field_id").where("timeline_bucket >= begun").join(own, ["timeline_bucket", "field_id", "hazard_family"], "left")
    rows = rows.select(
        nz.stable_id("incident", F.col("field_id"), F.col("hazard_family")).alias("incident_id"), "timeline_bucket", "adequate", (F.coalesce("hot", F.lit(0)) > 0).alias("present"),
        F.coalesce("severe", F.lit(0)).alias("severe"), F.coalesce("fresh_decline", F.lit(0)).alias("fresh_decline"), F.coalesce("fresh_decline", F.lit(0)).alias("impact"),
    )
    return tracking.incident_lifecycles(rows)


def incident_windows(spark, sf_dir):
    return tracking.lifecycle_windows(incident_lifecycles(spark, sf_dir))


def incident_crosswalk(spark, sf_dir):
    rows = _signals(spark, sf_dir).where("risk_rank >= 2").withColumn("timeline_bucket", nz.week_of(F.col("observation_date")))
    old = rows.select(F.concat("hazard_family", F.lit("/"), "crop_name").alias("incident_id"), "timeline_bucket", "field_id")
    new = rows.select(F.concat("hazard_family", F.lit("#"), "risk_band").alias("incident_id"), "timeline_bucket", "field_id")
    return tracking.crosswalk(old, new).withColumns({c: F.round(c, 9) for c in ("jaccard", "old_coverage", "new_coverage")})


def footprint_trail(spark, sf_dir):
    rows = _signals(spark, sf_dir).where("risk_rank >= 3").select(F.concat("hazard_family", F.lit("/"), "crop_name").alias("story_id"), nz.week_of(F.col("observation_date")).alias("timeline_bucket"), "field_id")
    return tracking.footprint_trail(rows).withColumn("jaccard", F.round("jaccard", 9))


def asof_stage(spark, sf_dir):
    """The stage last seen on or before the Sunday of each week lane."""
    rows = _signals(spark, sf_dir)
    lanes = cells.week_lanes(rows).withColumn("sunday", F.date_add("timeline_bucket", 6)).select("timeline_bucket", "field_id", "hazard_family", "event_state", "sunday")
    return temporal.asof_join(lanes, rows.select("field_id", "observation_date", "stage_family"), ["field_id"], "sunday", "observation_date", ["observation_date", "stage_family"])


def fdr_control(spark, sf_dir):
    p = ((F.col("event_id") * 37 % 1000 + 1).cast("double") / F.lit(1001.0)).alias("p")
    rows = _events(spark, sf_dir).select("event_id", "event_type", p)
    return benjamini_hochberg_by_value(rows, ["event_type"], "p", "q").withColumn("q", F.round("q", 9))


FEATURES = ("ndvi", "ndmi", "psri")


def robust_scaling(spark, sf_dir):
    rows = signals.daily_pressure(obs.canonical(obs.from_events(_events(spark, sf_dir))))
    schema = prototypes.robust_schema(rows, FEATURES, ["hazard_family"])
    return prototypes.scaled(rows, schema, FEATURES, ["hazard_family"]).select("field_id", "observation_date", "hazard_family", *[F.round(c, 6).alias(c) for c in FEATURES])


def _model(spark, sf_dir):
    rows = signals.daily_pressure(obs.canonical(obs.from_events(_events(spark, sf_dir))))
    rows = rows.where("hazard_family <> 'none'").select("field_id", "observation_date", "hazard_family", "risk_band", *FEATURES)
    return rows, prototypes.fit_prototypes(rows, FEATURES, ["hazard_family"], "risk_band")


def prototype_assignment(spark, sf_dir):
    rows, model = _model(spark, sf_dir)
    out = prototypes.assign(rows.drop("risk_band"), model, FEATURES, ["hazard_family"], "risk_band", ["field_id", "observation_date", "hazard_family"])
    return out.withColumns({"distance": F.round("distance", 6), "margin": F.round("margin", 6)})


def prototype_overlap(spark, sf_dir):
    out = prototypes.prototype_overlap(_model(spark, sf_dir)[1], FEATURES, ["hazard_family"], "risk_band")
    return out.withColumns({"distance": F.round("distance", 6), "overlap": F.round("overlap", 6)})


def label_agreement(spark, sf_dir):
    rows = signals.daily_pressure(obs.canonical(obs.from_events(_events(spark, sf_dir))))
    return prototypes.adjusted_rand(rows, "hazard_family", "risk_band").withColumn("ari", F.round("ari", 9))


def temporal_split(spark, sf_dir):
    rows = _signals(spark, sf_dir).select("crop_instance_id", "observation_date")
    return prototypes.temporal_split(rows, "crop_instance_id", "observation_date", "2024-01-12", "2024-01-19")


def append_audit(spark, sf_dir):
    """A later release that dropped and rewrote some days, held against the earlier one."""
    old = signals.daily_pressure(obs.canonical(obs.from_events(_events(spark, sf_dir)))).select("field_id", "observation_date", "risk_rank", "hazard_family")
    new = old.where(F.dayofmonth("observation_date") != 7).withColumn("risk_rank", F.when(F.dayofmonth("observation_date") == 9, F.col("risk_rank") + 1).otherwise(F.col("risk_rank")))
    return temporal.appended(old, new, ["field_id", "observation_date"])


_NAMES = [
    "canonical_sample", "daily_pressure", "causal_signals", "crop_instance_summary", "field_weeks", "week_lanes", "stage_baseline", "exposure_cells", "significant_cells", "frontier_rows",
    "weekly_components", "component_members", "link_scores", "primary_links", "exposure_lineage", "exposures", "exposure_weeks", "crop_incidents", "crop_lineage", "daily_stories", "event_windows", "weekly_snapshots", "map_frames", "onset_labels",
    "incident_lifecycles", "incident_windows", "incident_crosswalk", "footprint_trail", "asof_stage", "fdr_control", "robust_scaling", "prototype_assignment", "prototype_overlap", "label_agreement",
    "temporal_split", "append_audit",
]
QUERIES = {name: globals()[name] for name in _NAMES}

# -- the SQL twins ---------------------------------------------------------------------------------

_P = Policy()
RAW = """
raw AS (
  SELECT event_id, 'field-' || user_id AS field_id, ts::DATE AS observation_date,
    CASE user_id % 3 WHEN 0 THEN 'Maize' WHEN 1 THEN 'Beans' ELSE 'Rice' END AS crop_name, CASE WHEN day(ts) < 16 THEN 'A' ELSE 'B' END AS crop_season,
    CASE WHEN day(ts) <= 3 THEN 'off_season' WHEN day(ts) <= 12 THEN 'vegetative' WHEN day(ts) <= 22 THEN 'flowering' ELSE 'maturity' END AS stage_family,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS rank0,
    CASE event_type WHEN 'view' THEN 'LOW' WHEN 'click' THEN 'LOW-MED' WHEN 'purchase' THEN 'MED-HIGH' WHEN 'error' THEN 'HIGH' END AS risk_level,
    CASE event_id % 5 WHEN 0 THEN 'drought' WHEN 1 THEN 'ponding_flooding' WHEN 2 THEN 'heat' WHEN 3 THEN 'damaging_wind' ELSE 'none' END AS hazard_family,
    CASE WHEN event_id % 17 <> 0 THEN event_id % 4 END AS echo,
    0.3::DOUBLE + (event_id * 7 % 40)::DOUBLE / 100.0::DOUBLE AS ndvi, 0.1::DOUBLE + (event_id * 11 % 30)::DOUBLE / 100.0::DOUBLE AS ndmi,
    0.05::DOUBLE + (event_id * 13 % 25)::DOUBLE / 100.0::DOUBLE AS psri
  FROM events),
daily AS (
  SELECT *, coalesce(rank0, 0) AS risk_rank, rank0 IS NOT NULL AS pressure_observed, coalesce(risk_level, 'NONE') AS risk_band FROM raw
  QUALIFY row_number() OVER (PARTITION BY field_id, observation_date ORDER BY coalesce(rank0, 0) DESC, crop_name, crop_season, hazard_family, stage_family, echo NULLS FIRST, ndvi, ndmi, psri) = 1)"""
SIGNALS = RAW + f""",
marked AS (
  SELECT *, CASE WHEN lag(crop_name) OVER w IS NULL OR lag(crop_name) OVER w <> crop_name OR lag(crop_season) OVER w <> crop_season
      OR observation_date - lag(observation_date) OVER w > {_P.instance_gap_days} OR (lag(stage_family) OVER w = 'off_season' AND stage_family <> 'off_season') THEN observation_date END AS starts
  FROM daily WINDOW w AS (PARTITION BY field_id ORDER BY observation_date)),
begun AS (SELECT *, max(starts) OVER (PARTITION BY field_id ORDER BY observation_date) AS crop_instance_start_date FROM marked),
named AS (
  SELECT *, 'crop_' || substr(sha256(field_id || chr(31) || crop_name || chr(31) || crop_season || chr(31) || crop_instance_start_date::VARCHAR), 1, 24) AS crop_instance_id,
    observation_date - echo::INT AS spectral_source_date FROM begun),
acquired AS (
  SELECT *, spectral_source_date IS NOT NULL AND row_number() OVER (PARTITION BY crop_instance_id, spectral_source_date ORDER BY observation_date) = 1 AS is_new_acquisition,
    CASE WHEN echo IS NULL THEN 'missing' WHEN echo <= 7 THEN 'fresh' WHEN echo <= 14 THEN 'aging' ELSE 'stale' END AS spectral_freshness FROM named),
ref AS (
  SELECT n.crop_instance_id, n.observation_date, max(o.spectral_source_date) AS reference_source_date, arg_max(o.ndvi, o.spectral_source_date) AS r1,
    arg_max(o.ndmi, o.spectral_source_date) AS r2, arg_max(o.psri, o.spectral_source_date) AS r3
  FROM acquired n JOIN acquired o ON n.crop_instance_id = o.crop_instance_id AND n.is_new_acquisition AND o.is_new_acquisition AND o.observation_date < n.observation_date
    AND n.spectral_source_date - o.spectral_source_date BETWEEN 7 AND 21 GROUP BY ALL),
delta AS (SELECT a.*, r.reference_source_date, ndvi - r1 AS d1, ndmi - r2 AS d2, psri - r3 AS d3 FROM acquired a LEFT JOIN ref r USING (crop_instance_id, observation_date)),
flagged AS (
  SELECT *, [CASE WHEN d1 <= -0.15 THEN 'ndvi' END, CASE WHEN d2 <= -0.10 THEN 'ndmi' END, CASE WHEN d3 >= 0.10 THEN 'psri' END] AS s,
    [CASE WHEN d1 <= -0.08 THEN 'ndvi' END, CASE WHEN d2 <= -0.06 THEN 'ndmi' END, CASE WHEN d3 >= 0.05 THEN 'psri' END] AS m,
    [CASE WHEN d1 >= 0.05 THEN 'ndvi' END, CASE WHEN d2 >= 0.04 THEN 'ndmi' END, CASE WHEN d3 <= -0.05 THEN 'psri' END] AS r,
    is_new_acquisition AND spectral_freshness IN ('fresh', 'aging') AND reference_source_date IS NOT NULL AS new_response_evidence FROM delta),
sig AS (
  SELECT *, CASE WHEN spectral_source_date IS NULL THEN 'spectral_missing' WHEN NOT is_new_acquisition THEN 'no_new_acquisition' WHEN spectral_freshness = 'stale' THEN 'stale_acquisition'
      WHEN reference_source_date IS NULL THEN 'insufficient_reference' WHEN list_count(s) > 0 THEN 'severe_decline' WHEN list_count(m) > 0 THEN 'medium_decline' WHEN list_count(r) > 0 THEN 'recovery'
      ELSE 'no_material_change' END AS response_class,
    CASE WHEN NOT new_response_evidence THEN 'none' WHEN list_count(s) > 0 THEN array_to_string(s, '+') WHEN list_count(m) > 0 THEN array_to_string(m, '+')
      WHEN list_count(r) > 0 THEN array_to_string(r, '+') ELSE 'none' END AS response_evidence FROM flagged)"""
WEEKS = SIGNALS + f""",
context AS (
  SELECT date_trunc('week', observation_date)::DATE AS timeline_bucket, field_id, crop_instance_id, arg_max(stage_family, observation_date) AS stage_bucket, bool_or(pressure_observed) AS evaluable,
    29.0::DOUBLE + (any_value(substr(field_id, 7)::BIGINT) % 40)::DOUBLE * 0.03::DOUBLE AS centroid_lon, -2.0::DOUBLE + (any_value(substr(field_id, 7)::BIGINT) // 40)::DOUBLE * 0.02::DOUBLE AS centroid_lat
  FROM sig GROUP BY 1, 2, 3),
lanes AS (
  SELECT *, CASE rank WHEN 2 THEN 'WATCH' WHEN 3 THEN 'ACTIVE' WHEN 4 THEN 'SEVERE' END AS event_state,
    row_number() OVER (PARTITION BY timeline_bucket, field_id, hazard_family ORDER BY rank DESC, crop_instance_id) = 1 AS canonical FROM (
    SELECT date_trunc('week', observation_date)::DATE AS timeline_bucket, field_id, crop_instance_id, hazard_family, max(risk_rank) AS rank,
      bool_or(new_response_evidence AND response_class IN ('medium_decline', 'severe_decline')) AS fresh
    FROM sig WHERE pressure_observed AND hazard_family <> 'none' AND risk_rank >= 2 GROUP BY 1, 2, 3, 4)),
cohort AS (SELECT timeline_bucket, stage_bucket, count(DISTINCT crop_instance_id) AS denominator FROM context WHERE timeline_bucket + 6 <= DATE '{THROUGH}' AND evaluable GROUP BY 1, 2),
aff AS (
  SELECT l.timeline_bucket, hazard_family, stage_bucket, count(DISTINCT l.crop_instance_id) AS affected FROM lanes l JOIN context c USING (timeline_bucket, crop_instance_id)
  WHERE l.timeline_bucket + 6 <= DATE '{THROUGH}' AND canonical AND event_state IN ('ACTIVE', 'SEVERE') AND evaluable GROUP BY 1, 2, 3),
weekly AS (
  SELECT h.hazard_family, week(c.timeline_bucket) AS iso_week, c.stage_bucket, c.denominator, coalesce(affected, 0) AS affected
  FROM cohort c CROSS JOIN (SELECT DISTINCT hazard_family FROM lanes WHERE timeline_bucket + 6 <= DATE '{THROUGH}') h LEFT JOIN aff USING (timeline_bucket, hazard_family, stage_bucket)),
stage AS (SELECT hazard_family, iso_week::INT AS iso_week, stage_bucket, sum(affected)::BIGINT AS affected_count, sum(denominator)::BIGINT AS evaluable_count, count(*) AS training_week_count FROM weekly GROUP BY 1, 2, 3),
base AS (SELECT *, (affected_count + 20 * global_probability) / (evaluable_count + 20) AS expected_probability FROM (
  SELECT *, sum(affected_count) OVER w / sum(evaluable_count) OVER w AS global_probability FROM stage WINDOW w AS (PARTITION BY hazard_family, iso_week)))"""
GRIDDED = WEEKS + f""",
loc AS (SELECT *, floor((centroid_lon - 29.0::DOUBLE) * {GRID.km_per_lon!r}::DOUBLE / 5.0::DOUBLE)::BIGINT AS cell_x, floor((centroid_lat - -2.0::DOUBLE) * 110.574::DOUBLE / 5.0::DOUBLE)::BIGINT AS cell_y FROM context),
st AS (SELECT timeline_bucket, cell_x, cell_y, stage_bucket, count(DISTINCT CASE WHEN evaluable THEN crop_instance_id END) AS n, count(DISTINCT crop_instance_id) AS mon FROM loc GROUP BY 1, 2, 3, 4),
fl AS (SELECT timeline_bucket, cell_x, cell_y, count(DISTINCT field_id) AS monitored_field_count, count(DISTINCT CASE WHEN evaluable THEN field_id END) AS evaluable_field_count FROM loc GROUP BY 1, 2, 3),
gl AS (SELECT hazard_family, iso_week, max(global_probability) AS g FROM base GROUP BY 1, 2),
ex AS (
  SELECT s.timeline_bucket, s.cell_x, s.cell_y, h.hazard_family, sum(mon)::BIGINT AS monitored_count, sum(n)::BIGINT AS evaluable_count, sum(n * coalesce(expected_probability, g, 0)) AS expected_active_count,
    sum(n * coalesce(expected_probability, g, 0) * (1 - coalesce(expected_probability, g, 0)) * (1 + (n - 1) / 21.0::DOUBLE)) AS expected_variance,
    count(*) FILTER (WHERE expected_probability IS NULL AND g IS NULL) AS missing_baseline_stage_count
  FROM st s CROSS JOIN (SELECT DISTINCT hazard_family FROM base) h LEFT JOIN base b ON b.hazard_family = h.hazard_family AND b.iso_week = week(s.timeline_bucket) AND b.stage_bucket = s.stage_bucket
  LEFT JOIN gl ON gl.hazard_family = h.hazard_family AND gl.iso_week = week(s.timeline_bucket) GROUP BY 1, 2, 3, 4),
ob AS (
  SELECT l.timeline_bucket, cell_x, cell_y, hazard_family, count(DISTINCT CASE WHEN event_state IN ('ACTIVE', 'SEVERE') THEN l.crop_instance_id END) AS active_count,
    count(DISTINCT CASE WHEN event_state IN ('ACTIVE', 'SEVERE') THEN l.field_id END) AS active_field_count, count(DISTINCT CASE WHEN event_state = 'SEVERE' THEN l.field_id END) AS severe_field_count,
    count(DISTINCT CASE WHEN fresh THEN l.field_id END) AS fresh_response_field_count
  FROM lanes l JOIN loc c USING (timeline_bucket, crop_instance_id) WHERE canonical GROUP BY 1, 2, 3, 4),
act AS (
  SELECT timeline_bucket, hazard_family, cell_x, cell_y, monitored_count, evaluable_count, monitored_field_count, evaluable_field_count, coalesce(active_count, 0) AS active_count,
    coalesce(active_field_count, 0) AS active_field_count, coalesce(severe_field_count, 0) AS severe_field_count, coalesce(fresh_response_field_count, 0) AS fresh_response_field_count,
    missing_baseline_stage_count, expected_active_count, expected_variance, (coalesce(active_count, 0) - expected_active_count) / sqrt(greatest(expected_variance, 1e-9)) AS z_score
  FROM ex LEFT JOIN ob USING (timeline_bucket, cell_x, cell_y, hazard_family) JOIN fl USING (timeline_bucket, cell_x, cell_y))"""
_SCALED = ", ".join(
    f"round(greatest(-5, least(5, ({c} - quantile_cont({c}, 0.5) OVER w) / CASE WHEN quantile_cont({c}, 0.75) OVER w - quantile_cont({c}, 0.25) OVER w < 1e-9 THEN 1 ELSE quantile_cont({c}, 0.75) OVER w - quantile_cont({c}, 0.25) OVER w END)), 6) AS {c}"
    for c in FEATURES
)
_MODEL = RAW + """,
hz AS (SELECT field_id, observation_date, hazard_family, risk_band, ndvi, ndmi, psri FROM daily WHERE hazard_family <> 'none'),
centre AS (SELECT hazard_family, risk_band AS proto, quantile_cont(ndvi, 0.5) AS p1, quantile_cont(ndmi, 0.5) AS p2, quantile_cont(psri, 0.5) AS p3 FROM hz GROUP BY 1, 2),
model AS (
  SELECT c.*, radius FROM centre c JOIN (
    SELECT h.hazard_family, h.risk_band AS proto, quantile_cont(sqrt((ndvi - p1) * (ndvi - p1) + (ndmi - p2) * (ndmi - p2) + (psri - p3) * (psri - p3)), 0.95) AS radius
    FROM hz h JOIN centre c ON c.hazard_family = h.hazard_family AND c.proto = h.risk_band GROUP BY 1, 2) USING (hazard_family, proto))"""

ORACLES = {
    "canonical_sample": "WITH " + RAW + """,
      r AS (SELECT * FROM raw WHERE observation_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'),
      f AS (SELECT DISTINCT field_id FROM r ORDER BY md5(field_id), field_id LIMIT 5)
      SELECT field_id, observation_date, crop_name, risk_level, ndvi FROM r WHERE field_id IN (SELECT field_id FROM f)""",
    "daily_pressure": f"WITH {RAW} SELECT field_id, observation_date, risk_rank, risk_band, hazard_family, stage_family, pressure_observed FROM daily",
    "causal_signals": f"""WITH {SIGNALS} SELECT field_id, observation_date, crop_instance_id, crop_instance_start_date, spectral_source_date, spectral_freshness, is_new_acquisition,
      reference_source_date, response_class, response_evidence, new_response_evidence, round(d1, 6) AS ndvi_delta, round(d2, 6) AS ndmi_delta, round(d3, 6) AS psri_delta FROM sig""",
    "crop_instance_summary": f"""WITH {SIGNALS} SELECT field_id, crop_name, crop_season, crop_instance_id, min(crop_instance_start_date) AS crop_instance_start_date,
      max(observation_date) AS last_observation_date, count(*) AS observation_count FROM sig GROUP BY 1, 2, 3, 4""",
    "field_weeks": f"WITH {WEEKS} SELECT timeline_bucket, field_id, crop_instance_id, stage_bucket, evaluable, round(centroid_lon, 6) AS centroid_lon FROM context",
    "week_lanes": f"WITH {WEEKS} SELECT timeline_bucket, field_id, crop_instance_id, hazard_family, rank, fresh, event_state, canonical FROM lanes",
    "stage_baseline": f"""WITH {WEEKS} SELECT hazard_family, iso_week, stage_bucket, affected_count, evaluable_count, training_week_count, round(global_probability, 9) AS global_probability,
      round(expected_probability, 9) AS expected_probability FROM base""",
    "exposure_cells": f"""WITH {GRIDDED} SELECT * REPLACE (round(expected_active_count, 6) AS expected_active_count, round(expected_variance, 6) AS expected_variance, round(z_score, 6) AS z_score) FROM act""",
    "incident_crosswalk": f"""WITH {RAW}, r AS (SELECT *, date_trunc('week', observation_date)::DATE AS w FROM daily WHERE risk_rank >= 2),
      o AS (SELECT DISTINCT hazard_family || '/' || crop_name AS old_incident_id, w, field_id FROM r), n AS (SELECT DISTINCT hazard_family || '#' || risk_band AS new_incident_id, w, field_id FROM r),
      oc AS (SELECT old_incident_id, count(*) AS old_count FROM o GROUP BY 1), nc AS (SELECT new_incident_id, count(*) AS new_count FROM n GROUP BY 1),
      x AS (SELECT old_incident_id, new_incident_id, count(*) AS overlap_count FROM o JOIN n USING (w, field_id) GROUP BY 1, 2),
      a AS (SELECT old_incident_id, new_incident_id, overlap_count, old_count, new_count, 'overlap' AS match_status FROM x JOIN oc USING (old_incident_id) JOIN nc USING (new_incident_id)
        UNION ALL SELECT old_incident_id, NULL, 0, old_count, 0, 'unmatched_old' FROM oc WHERE old_incident_id NOT IN (SELECT old_incident_id FROM x)
        UNION ALL SELECT NULL, new_incident_id, 0, 0, new_count, 'unmatched_new' FROM nc WHERE new_incident_id NOT IN (SELECT new_incident_id FROM x))
      SELECT *, old_count + new_count - overlap_count AS union_count, round(overlap_count / (old_count + new_count - overlap_count), 9) AS jaccard,
        round(coalesce(overlap_count / nullif(old_count, 0), 0), 9) AS old_coverage, round(coalesce(overlap_count / nullif(new_count, 0), 0), 9) AS new_coverage FROM a""",
    "footprint_trail": f"""WITH {RAW}, f AS (SELECT hazard_family || '/' || crop_name AS story_id, date_trunc('week', observation_date)::DATE AS timeline_bucket, list(DISTINCT field_id) AS fs FROM daily WHERE risk_rank >= 3 GROUP BY 1, 2),
      g AS (SELECT *, lag(fs) OVER w AS b, (timeline_bucket - lag(timeline_bucket) OVER w)::INT AS gap_days FROM f WINDOW w AS (PARTITION BY story_id ORDER BY timeline_bucket)),
      h AS (SELECT *, len(fs)::INT AS field_count, CASE WHEN b IS NULL THEN 0 ELSE len(list_intersect(fs, b)) END::INT AS persisting FROM g),
      k AS (SELECT *, CASE WHEN b IS NULL THEN 'first_week' WHEN gap_days <> 7 THEN 'nonconsecutive_week' WHEN persisting = 0 THEN 'zero_field_overlap' END AS break_reason FROM h)
      SELECT story_id, timeline_bucket, gap_days, field_count, persisting, round(CASE WHEN b IS NULL THEN 0 ELSE persisting / (field_count + len(b) - persisting) END, 9) AS jaccard, break_reason, break_reason IS NULL AS trail_segment_allowed FROM k""",
    "asof_stage": f"""WITH {WEEKS}, l AS (SELECT timeline_bucket, field_id, hazard_family, event_state, timeline_bucket + 6 AS sunday FROM lanes)
      SELECT l.timeline_bucket, l.field_id, l.hazard_family, l.event_state, l.sunday, s.observation_date, s.stage_family FROM l ASOF LEFT JOIN sig s ON l.field_id = s.field_id AND l.sunday >= s.observation_date""",
    "fdr_control": """WITH r AS (SELECT event_id, event_type, (event_id * 37 % 1000 + 1)::DOUBLE / 1001.0::DOUBLE AS p FROM events),
      k AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY p, event_id) AS n, count(*) OVER (PARTITION BY event_type) AS m FROM r)
      SELECT event_id, event_type, p, round(least(min(p * m / n) OVER (PARTITION BY event_type ORDER BY p, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1.0), 9) AS q FROM k""",
    "robust_scaling": f"WITH {RAW} SELECT field_id, observation_date, hazard_family, {_SCALED} FROM daily WINDOW w AS (PARTITION BY hazard_family)",
    "prototype_assignment": f"""WITH {_MODEL},
      d AS (SELECT field_id, observation_date, h.hazard_family, proto, radius, sqrt((ndvi - p1) * (ndvi - p1) + (ndmi - p2) * (ndmi - p2) + (psri - p3) * (psri - p3)) AS distance FROM hz h JOIN model USING (hazard_family)),
      k AS (SELECT *, row_number() OVER w AS n, lead(distance) OVER w AS ru FROM d WINDOW w AS (PARTITION BY field_id, observation_date, hazard_family ORDER BY distance, proto)),
      j AS (SELECT *, CASE WHEN ru > 0 THEN (ru - distance) / ru END AS margin FROM k WHERE n = 1)
      SELECT field_id, observation_date, hazard_family, proto AS prototype, round(distance, 6) AS distance, round(margin, 6) AS margin, distance <= radius AND coalesce(margin >= 0.05, true) AS accepted,
        CASE WHEN distance <= radius AND coalesce(margin >= 0.05, true) THEN proto ELSE 'novel' END AS assignment FROM j""",
    "prototype_overlap": f"""WITH {_MODEL}, d AS (SELECT a.hazard_family, a.proto AS "left", b.proto AS "right", a.radius + b.radius AS r, sqrt((a.p1 - b.p1) * (a.p1 - b.p1) + (a.p2 - b.p2) * (a.p2 - b.p2) + (a.p3 - b.p3) * (a.p3 - b.p3)) AS distance
      FROM model a JOIN model b ON a.hazard_family = b.hazard_family AND a.proto < b.proto) SELECT hazard_family, "left", "right", round(distance, 6) AS distance, round(r / nullif(distance, 0), 6) AS overlap FROM d""",
    "label_agreement": f"""WITH {RAW}, c AS (SELECT hazard_family AS l, risk_band AS r, count(*)::DOUBLE AS n FROM daily GROUP BY 1, 2),
      t AS (SELECT sum(n * (n - 1) / 2) AS same, sum(n) AS total FROM c), a AS (SELECT sum(n * (n - 1) / 2) AS a FROM (SELECT sum(n) AS n FROM c GROUP BY l)), b AS (SELECT sum(n * (n - 1) / 2) AS b FROM (SELECT sum(n) AS n FROM c GROUP BY r))
      SELECT round(CASE WHEN (a + b) / 2 = a * b / (total * (total - 1) / 2) THEN 1.0 ELSE (same - a * b / (total * (total - 1) / 2)) / ((a + b) / 2 - a * b / (total * (total - 1) / 2)) END, 9) AS ari FROM t, a, b""",
    "temporal_split": f"""WITH {SIGNALS}, o AS (SELECT crop_instance_id, observation_date, CASE WHEN observation_date <= DATE '2024-01-12' THEN 'train' WHEN observation_date >= DATE '2024-01-19' THEN 'test' ELSE 'embargo' END AS own FROM sig)
      SELECT crop_instance_id, observation_date, CASE WHEN own = first_value(own) OVER (PARTITION BY crop_instance_id ORDER BY observation_date, own) THEN own ELSE 'embargo' END AS split FROM o""",
    "append_audit": f"WITH {RAW} SELECT field_id, observation_date, CASE WHEN day(observation_date) = 7 THEN 'removed' ELSE 'rewritten' END AS status FROM daily WHERE day(observation_date) IN (7, 9)",
}

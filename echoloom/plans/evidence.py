"""The two-clock evidence queries over the driver's event table, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from echoloom.operators import evidence, field_stories
from echoloom.plans import monitoring

DAY = "2024-01-18"


def _source(spark, sf_dir):
    """Signals with weather drivers, scores, acquisition quality and availability, made from field and day."""
    rows = monitoring._signals(spark, sf_dir)
    u, d = F.substring("field_id", 7, 20).cast("long"), F.dayofmonth("observation_date")

    def unless(condition, value, kind="double"):
        return F.when(condition, value.cast(kind))

    return rows.withColumns({
        "spi_index": unless((u + d) % 5 != 0, (u * 3 + d) % 7 - 3), "ponding_mm": unless((u + d) % 6 != 0, (u * 5 + d * 2) % 20), "temperature": (20 + (u + d) % 15).cast("double"),
        "humidity": unless((u + d) % 4 != 0, 40 + d), "wind_speed": unless((u * d) % 7 != 0, (u + 2 * d) % 25), "drought_score": ((u * 2 + d) % 11).cast("double"), "ponding_score": ((u + 3 * d) % 12 - 2).cast("double"),
        "heat_score": ((u + d * d) % 10).cast("double"), "wind_score": unless(d % 3 != 0, (u + d) % 9), "valid_fraction": ((u * 7 + d * 3) % 100).cast("double") / F.lit(100.0), "cloud": ((u * 11 + d * 5) % 60).cast("double"),
        "flag": F.when((u + d) % 13 == 0, "poor"), "good": (u + d) % 17 != 0, "weather_available_at": F.col("observation_date"), "stage_available_at": F.date_add("observation_date", (u % 3).cast("int")),
    })


def crop_day_ledger(spark, sf_dir):
    return evidence.crop_days(_source(spark, sf_dir))


def pressure_day_ledger(spark, sf_dir):
    return evidence.pressure_days(_source(spark, sf_dir))


def acquisition_ledger(spark, sf_dir):
    return evidence.acquisition_ledger(_source(spark, sf_dir))


def field_state_as_of(spark, sf_dir):
    source = _source(spark, sf_dir)
    return evidence.state_as_of(evidence.pressure_days(source), evidence.acquisition_ledger(source), DAY)


def evidence_timeline(spark, sf_dir):
    source = _source(spark, sf_dir)
    return evidence.daily_timeline(evidence.pressure_days(source), evidence.acquisition_ledger(source))


def prefix_features(spark, sf_dir):
    kept = ["peak_rank", "age_days", "escalations", "deescalations", "active_days", "severe_days", "stage_transitions", "acquisitions"]
    rounded = [F.round(c, 6).alias(c) for c in ("mean_rank", "rank_slope", "last_ndvi_delta", "coverage")]
    return evidence.running_features(monitoring._signals(spark, sf_dir), "crop_instance_id").select("crop_instance_id", "timeline_bucket", "observation_date", *kept, *rounded)


def _stories(spark, sf_dir):
    source = _source(spark, sf_dir)
    return field_stories.field_stories(evidence.pressure_days(source), evidence.acquisition_ledger(source))


def field_story_days(spark, sf_dir):
    return _stories(spark, sf_dir)


def field_story_chapters(spark, sf_dir):
    return field_stories.chapters(_stories(spark, sf_dir))


def field_story_windows(spark, sf_dir):
    return field_stories.windows(_stories(spark, sf_dir))


_NAMES = ["field_story_days", "field_story_chapters", "field_story_windows", "crop_day_ledger", "pressure_day_ledger", "acquisition_ledger", "field_state_as_of", "evidence_timeline", "prefix_features"]
QUERIES = {name: globals()[name] for name in _NAMES}

SOURCE = monitoring.SIGNALS + """,
src AS (
  SELECT *, CASE WHEN (u + d) % 5 <> 0 THEN (u * 3 + d) % 7 - 3 END AS spi_index, CASE WHEN (u + d) % 6 <> 0 THEN (u * 5 + d * 2) % 20 END AS ponding_mm, 20 + (u + d) % 15 AS temperature,
    CASE WHEN (u + d) % 4 <> 0 THEN 40 + d END AS humidity, CASE WHEN (u * d) % 7 <> 0 THEN (u + 2 * d) % 25 END AS wind_speed, ((u * 2 + d) % 11)::DOUBLE AS s1, ((u + 3 * d) % 12 - 2)::DOUBLE AS s2,
    ((u + d * d) % 10)::DOUBLE AS s3, CASE WHEN d % 3 <> 0 THEN ((u + d) % 9)::DOUBLE END AS s4, ((u * 7 + d * 3) % 100)::DOUBLE / 100.0::DOUBLE AS valid_fraction, ((u * 11 + d * 5) % 60)::DOUBLE AS cloud,
    CASE WHEN (u + d) % 13 = 0 THEN 'poor' END AS flag, (u + d) % 17 <> 0 AS good, observation_date + (u % 3)::INT AS stage_available_at
  FROM (SELECT *, substr(field_id, 7)::BIGINT AS u, day(observation_date) AS d FROM sig)),
press AS (
  SELECT 'pressure_' || substr(md5(field_id || '|' || crop_instance_id || '|' || observation_date::VARCHAR || '|' || h), 1, 24) AS record_id, field_id, crop_instance_id, observation_date, observation_date AS knowledge_time,
    h AS hazard_family, o AS pressure_observed, sc AS pressure_score, prank AS pressure_rank, coalesce(prank >= 2, false) AS pressure_active FROM (
    SELECT *, (CASE WHEN NOT o THEN NULL WHEN sc >= 8 THEN 4 WHEN sc >= 5 THEN 3 WHEN sc >= 3 THEN 2 WHEN sc <= 0 THEN 0 WHEN sc IS NOT NULL THEN 1 WHEN hazard_family = h THEN risk_rank ELSE 0 END)::INT AS prank FROM (
      SELECT src.*, h, CASE h WHEN 'drought' THEN spi_index IS NOT NULL WHEN 'ponding_flooding' THEN ponding_mm IS NOT NULL WHEN 'heat' THEN temperature IS NOT NULL AND humidity IS NOT NULL ELSE wind_speed IS NOT NULL END AS o,
        CASE h WHEN 'drought' THEN s1 WHEN 'ponding_flooding' THEN s2 WHEN 'heat' THEN s3 ELSE s4 END AS sc FROM src CROSS JOIN (VALUES ('drought'), ('ponding_flooding'), ('heat'), ('damaging_wind')) v(h)))),
cand AS (SELECT field_id, spectral_source_date, min(observation_date) AS first_seen, arg_min({'ndvi': ndvi, 'ndmi': ndmi, 'psri': psri, 'vf': valid_fraction, 'cl': cloud, 'fl': flag, 'go': good}, observation_date) AS f
  FROM src WHERE spectral_source_date IS NOT NULL GROUP BY 1, 2),
acq AS (
  SELECT *, 's2_' || substr(md5(field_id || '|' || crop_instance_id || '|' || spectral_source_date::VARCHAR), 1, 24) AS acquisition_id, greatest(first_seen, stage_available_at) AS knowledge_time,
    CASE WHEN NOT f.go THEN 'rejected_no_valid_pixels' WHEN f.vf < 0.4::DOUBLE THEN 'rejected_sparse' WHEN f.cl > 40 THEN 'rejected_cloud' WHEN f.fl = 'poor' THEN 'rejected_quality' ELSE 'usable' END AS status
  FROM (SELECT c.*, s.crop_instance_id, s.stage_available_at FROM cand c ASOF JOIN src s ON c.field_id = s.field_id AND c.spectral_source_date >= s.observation_date)),
pair AS (
  SELECT c.acquisition_id, max(r.spectral_source_date) AS reference_source_date, arg_max(c.f.ndvi - r.f.ndvi, r.spectral_source_date) AS e1, arg_max(c.f.ndmi - r.f.ndmi, r.spectral_source_date) AS e2,
    arg_max(c.f.psri - r.f.psri, r.spectral_source_date) AS e3 FROM acq c JOIN acq r ON c.field_id = r.field_id AND c.crop_instance_id = r.crop_instance_id AND c.status = 'usable' AND r.status = 'usable'
    AND r.knowledge_time <= c.knowledge_time AND c.spectral_source_date - r.spectral_source_date BETWEEN 7 AND 21 GROUP BY 1),
ledger AS (
  SELECT acquisition_id, field_id, crop_instance_id, spectral_source_date, knowledge_time, first_seen, status, reference_source_date,
    CASE WHEN status <> 'usable' THEN 'not_evaluable' WHEN reference_source_date IS NULL THEN 'insufficient_reference' WHEN e1 <= -0.15 OR e2 <= -0.10 OR e3 >= 0.10 THEN 'severe_decline'
      WHEN e1 <= -0.08 OR e2 <= -0.06 OR e3 >= 0.05 THEN 'medium_decline' WHEN e1 >= 0.05 OR e2 >= 0.04 OR e3 <= -0.05 THEN 'recovery' ELSE 'no_material_change' END AS response_class,
    status = 'usable' AND reference_source_date IS NOT NULL AS new_response_evidence FROM acq LEFT JOIN pair USING (acquisition_id))"""

ORACLES = {
    "crop_day_ledger": f"""WITH {SOURCE} SELECT 'crop_' || substr(md5(field_id || '|' || crop_instance_id || '|' || observation_date::VARCHAR), 1, 24) AS record_id, field_id, crop_instance_id, observation_date,
      stage_available_at AS knowledge_time, crop_name, stage_family AS stage_bucket, true AS crop_context_observed, NULL::VARCHAR AS missing_reason FROM src""",
    "pressure_day_ledger": f"WITH {SOURCE} SELECT * FROM press",
    "acquisition_ledger": f"WITH {SOURCE} SELECT * FROM ledger",
    "field_state_as_of": f"""WITH {SOURCE}, l AS (SELECT * FROM press WHERE observation_date <= DATE '{DAY}' AND knowledge_time <= DATE '{DAY}'
        QUALIFY row_number() OVER (PARTITION BY field_id, hazard_family ORDER BY observation_date DESC, knowledge_time DESC) = 1),
      f AS (SELECT field_id, max(pressure_rank) AS max_rank, count(*) FILTER (WHERE pressure_active) AS active_hazards, coalesce(string_agg(CASE WHEN pressure_active THEN hazard_family END, '+' ORDER BY hazard_family), '') AS hazards FROM l GROUP BY 1),
      h AS (SELECT * FROM ledger WHERE spectral_source_date <= DATE '{DAY}' AND knowledge_time <= DATE '{DAY}' AND status = 'usable' QUALIFY row_number() OVER (PARTITION BY field_id ORDER BY spectral_source_date DESC, knowledge_time DESC) = 1)
      SELECT f.*, h.spectral_source_date, h.response_class, CASE WHEN h.spectral_source_date IS NULL THEN 'missing' WHEN DATE '{DAY}' - h.spectral_source_date <= 7 THEN 'fresh' WHEN DATE '{DAY}' - h.spectral_source_date <= 14 THEN 'aging' ELSE 'stale' END AS freshness
      FROM f LEFT JOIN h USING (field_id)""",
    "evidence_timeline": f"""WITH {SOURCE}, l AS (SELECT observation_date AS day, count(DISTINCT field_id) AS fields, count(DISTINCT CASE WHEN pressure_active THEN field_id END) AS active_fields, count(*) FILTER (WHERE NOT pressure_observed) AS unobserved_lanes FROM press GROUP BY 1),
      g AS (SELECT spectral_source_date AS day, count(*) FILTER (WHERE status = 'usable') AS usable, count(*) FILTER (WHERE response_class IN ('medium_decline', 'severe_decline')) AS declines FROM ledger GROUP BY 1),
      s AS (SELECT unnest(generate_series((SELECT min(day) FROM (SELECT day FROM l UNION ALL SELECT day FROM g)), (SELECT max(day) FROM (SELECT day FROM l UNION ALL SELECT day FROM g)), INTERVAL 1 DAY))::DATE AS day)
      SELECT day, coalesce(fields, 0) AS fields, coalesce(active_fields, 0) AS active_fields, coalesce(unobserved_lanes, 0) AS unobserved_lanes, coalesce(usable, 0) AS usable, coalesce(declines, 0) AS declines FROM s LEFT JOIN l USING (day) LEFT JOIN g USING (day)""",
    "prefix_features": f"""WITH {monitoring.SIGNALS}, c AS (
        SELECT *, coalesce((risk_rank > lag(risk_rank) OVER w)::INT, 0) AS up, coalesce((risk_rank < lag(risk_rank) OVER w)::INT, 0) AS down, (stage_family IS DISTINCT FROM lag(stage_family) OVER w)::INT AS moved
        FROM sig WINDOW w AS (PARTITION BY crop_instance_id ORDER BY observation_date)),
      p AS (SELECT crop_instance_id, date_trunc('week', observation_date)::DATE AS timeline_bucket, observation_date, max(risk_rank) OVER w AS peak_rank, avg(risk_rank) OVER w AS mean_rank,
        (observation_date - min(observation_date) OVER w + 1)::INT AS age_days, (risk_rank - first_value(risk_rank) OVER w) / greatest(1, observation_date - min(observation_date) OVER w) AS rank_slope,
        (sum(up) OVER w)::BIGINT AS escalations, (sum(down) OVER w)::BIGINT AS deescalations, (sum((risk_rank >= 3)::INT) OVER w)::BIGINT AS active_days, (sum((risk_rank >= 4)::INT) OVER w)::BIGINT AS severe_days,
        greatest(0, sum(moved) OVER w - 1)::BIGINT AS stage_transitions, last_value(d1 IGNORE NULLS) OVER w AS last_ndvi_delta, (sum(is_new_acquisition::INT) OVER w)::BIGINT AS acquisitions,
        count(*) OVER w / greatest(1, observation_date - min(observation_date) OVER w + 1) AS coverage
        FROM c WINDOW w AS (PARTITION BY crop_instance_id ORDER BY observation_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
      SELECT * REPLACE (round(mean_rank, 6) AS mean_rank, round(rank_slope, 6) AS rank_slope, round(last_ndvi_delta, 6) AS last_ndvi_delta, round(coverage, 6) AS coverage) FROM p
      QUALIFY row_number() OVER (PARTITION BY crop_instance_id, timeline_bucket ORDER BY observation_date DESC) = 1""",
}

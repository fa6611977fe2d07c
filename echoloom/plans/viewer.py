"""Viewer artifacts over the driver's event table, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from echoloom.functions import normalize as nz
from echoloom.operators import cells, evidence, materialize
from echoloom.plans import evidence as ledgers
from echoloom.plans import monitoring
from echoloom.sources import observations as obs


def _places(spark, sf_dir):
    return obs.places(monitoring._events(spark, sf_dir))


def daily_field_grid(spark, sf_dir):
    return materialize.field_grid(monitoring._signals(spark, sf_dir), _places(spark, sf_dir))


def daily_pressure_grid(spark, sf_dir):
    return materialize.pressure_grid(evidence.pressure_days(ledgers._source(spark, sf_dir)), _places(spark, sf_dir))


def stage_summary(spark, sf_dir):
    """Every cell with an active instance as a component of its own."""
    context, lanes = monitoring._parts(spark, sf_dir)
    busy = monitoring._activity(context, lanes).where("active_count >= 1").select("timeline_bucket", "hazard_family", "cell_x", "cell_y", F.concat_ws(":", F.lit("g"), F.col("cell_x").cast("string"), F.col("cell_y").cast("string")).alias("component_id"))
    return materialize.stage_summary(busy, cells.on_grid(context, monitoring.GRID), lanes.where("canonical"))


def hazard_labels(spark, sf_dir):
    return materialize.cluster_labels(monitoring._signals(spark, sf_dir), "hazard_family")


def counter_audit(spark, sf_dir):
    """Weekly counters with one week made wrong on purpose."""
    rows = monitoring._signals(spark, sf_dir).withColumn("timeline_bucket", nz.week_of(F.col("observation_date")))
    counters = {"pressed": "risk_rank >= 3", "fresh": "new_response_evidence"}
    weekly = rows.groupBy("timeline_bucket", "hazard_family").agg(*[F.countDistinct(F.when(F.expr(c), F.col("field_id"))).alias(n) for n, c in counters.items()])
    weekly = weekly.withColumn("pressed", F.col("pressed") + F.when(F.col("timeline_bucket") == F.lit("2024-01-08").cast("date"), 1).otherwise(0))
    return materialize.counter_mismatches(weekly, rows, ["timeline_bucket", "hazard_family"], counters)


def knowledge_binding(spark, sf_dir):
    source = ledgers._source(spark, sf_dir)
    week = nz.week_of(F.col("observation_date")).alias("timeline_bucket")
    crop = evidence.crop_days(source).select("field_id", week, "knowledge_time")
    acquired = evidence.acquisition_ledger(source).select("field_id", nz.week_of(F.col("spectral_source_date")).alias("timeline_bucket"), "knowledge_time")
    weeks = source.select("field_id", week).distinct()
    return materialize.knowledge_bounds(weeks, {"crop": crop, "spectral": acquired}, ["field_id", "timeline_bucket"])


def week_totals(spark, sf_dir):
    """The small table that a timeline is served from."""
    rows = monitoring._signals(spark, sf_dir).withColumn("timeline_bucket", nz.week_of(F.col("observation_date")))
    return rows.groupBy("timeline_bucket", "hazard_family").agg(F.countDistinct("field_id").alias("fields"), F.sum((F.col("risk_rank") >= 2).cast("int")).alias("reportable_days"), F.max("risk_rank").alias("peak_rank"))


_NAMES = ["daily_field_grid", "daily_pressure_grid", "stage_summary", "hazard_labels", "counter_audit", "knowledge_binding", "week_totals"]
QUERIES = {name: globals()[name] for name in _NAMES}

_PLACE = """
pl AS (SELECT DISTINCT 'field-' || user_id AS field_id, floor((29.0::DOUBLE + (user_id % 40)::DOUBLE * 0.03::DOUBLE - 28.0::DOUBLE) / 0.05::DOUBLE)::BIGINT AS grid_x,
  floor((-2.0::DOUBLE + (user_id // 40)::DOUBLE * 0.02::DOUBLE - -4.0::DOUBLE) / 0.05::DOUBLE)::BIGINT AS grid_y FROM events)"""


def _modal(source: str, keys: str, value: str) -> str:
    return f"(SELECT {keys}, {value} FROM {source} GROUP BY {keys}, {value} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {value}) = 1)"


ORACLES = {
    "daily_field_grid": f"""WITH {monitoring.SIGNALS}, {_PLACE}, j AS (SELECT sig.*, grid_x, grid_y FROM sig JOIN pl USING (field_id)
        QUALIFY row_number() OVER (PARTITION BY observation_date, grid_x, grid_y, field_id ORDER BY risk_rank DESC, crop_instance_id) = 1),
      t AS (SELECT observation_date, grid_x, grid_y, count(*) AS field_count, count(*) FILTER (WHERE pressure_observed) AS observed_count, count(*) FILTER (WHERE risk_rank >= 2) AS pressed_count, max(risk_rank) AS peak_rank FROM j GROUP BY 1, 2, 3)
      SELECT t.*, a.crop_name, b.stage_family FROM t JOIN {_modal("j", "observation_date, grid_x, grid_y", "crop_name")} a USING (observation_date, grid_x, grid_y) JOIN {_modal("j", "observation_date, grid_x, grid_y", "stage_family")} b USING (observation_date, grid_x, grid_y)""",
    "daily_pressure_grid": f"""WITH {ledgers.SOURCE}, {_PLACE} SELECT observation_date, hazard_family, grid_x, grid_y, count(DISTINCT field_id) AS field_count, count(DISTINCT CASE WHEN pressure_active THEN field_id END) AS active_count,
      count(*) FILTER (WHERE NOT pressure_observed) AS unobserved_count, max(pressure_rank) AS peak_rank FROM press JOIN pl USING (field_id) GROUP BY 1, 2, 3, 4""",
    "stage_summary": f"""WITH {monitoring.GRIDDED}, busy AS (SELECT timeline_bucket, hazard_family, cell_x, cell_y, 'g:' || cell_x || ':' || cell_y AS component_id FROM act WHERE active_count >= 1),
      cn AS (SELECT l.*, arg_max_crop.crop_name FROM loc l JOIN (SELECT date_trunc('week', observation_date)::DATE AS timeline_bucket, field_id, crop_instance_id, arg_max(crop_name, observation_date) AS crop_name FROM sig GROUP BY 1, 2, 3) arg_max_crop USING (timeline_bucket, field_id, crop_instance_id)),
      j AS (SELECT b.timeline_bucket, b.hazard_family, component_id, crop_name, stage_bucket, c.crop_instance_id, c.field_id, evaluable, event_state FROM busy b LEFT JOIN cn c USING (timeline_bucket, cell_x, cell_y)
        LEFT JOIN (SELECT * FROM lanes WHERE canonical) l ON l.timeline_bucket = b.timeline_bucket AND l.hazard_family = b.hazard_family AND l.crop_instance_id = c.crop_instance_id)
      SELECT timeline_bucket, hazard_family, component_id, crop_name, stage_bucket, count(DISTINCT crop_instance_id) AS monitored, count(DISTINCT CASE WHEN evaluable THEN crop_instance_id END) AS evaluable,
        count(DISTINCT CASE WHEN event_state IN ('ACTIVE', 'SEVERE') THEN crop_instance_id END) AS affected, count(*) FILTER (WHERE field_id IS NULL) AS missing_cells,
        round(count(DISTINCT CASE WHEN event_state IN ('ACTIVE', 'SEVERE') THEN crop_instance_id END) / nullif(count(DISTINCT CASE WHEN evaluable THEN crop_instance_id END), 0), 9) AS rate FROM j GROUP BY 1, 2, 3, 4, 5""",
    "hazard_labels": f"""WITH {monitoring.RAW}, t AS (SELECT hazard_family, count(*) AS member_days, count(DISTINCT field_id) AS fields, round(median(ndvi), 9) AS median_ndvi, round(quantile_cont(psri, 0.9), 9) AS p90_psri, max(risk_rank) AS peak_rank FROM daily GROUP BY 1)
      SELECT t.*, b.risk_band FROM t JOIN {_modal("daily", "hazard_family", "risk_band")} b USING (hazard_family)""",
    "counter_audit": f"""WITH {monitoring.SIGNALS}, t AS (SELECT date_trunc('week', observation_date)::DATE AS timeline_bucket, hazard_family, count(DISTINCT CASE WHEN risk_rank >= 3 THEN field_id END) AS p, count(DISTINCT CASE WHEN new_response_evidence THEN field_id END) AS f FROM sig GROUP BY 1, 2)
      SELECT timeline_bucket, hazard_family, p + 1 AS pressed, f AS fresh, p AS pressed_counted, f AS fresh_counted FROM t WHERE timeline_bucket = DATE '2024-01-08'""",
    "knowledge_binding": f"""WITH {ledgers.SOURCE}, c AS (SELECT field_id, date_trunc('week', observation_date)::DATE AS timeline_bucket, max(stage_available_at) AS crop_known FROM src GROUP BY 1, 2),
      s AS (SELECT field_id, date_trunc('week', spectral_source_date)::DATE AS timeline_bucket, max(knowledge_time) AS spectral_known FROM ledger GROUP BY 1, 2)
      SELECT field_id, timeline_bucket, crop_known, spectral_known, greatest(timeline_bucket + 6, crop_known, coalesce(spectral_known, timeline_bucket + 6)) AS knowledge_time FROM c LEFT JOIN s USING (field_id, timeline_bucket)""",
    "week_totals": f"""WITH {monitoring.RAW} SELECT date_trunc('week', observation_date)::DATE AS timeline_bucket, hazard_family, count(DISTINCT field_id) AS fields, sum((risk_rank >= 2)::INT)::BIGINT AS reportable_days, max(risk_rank) AS peak_rank FROM daily GROUP BY 1, 2""",
}

"""Daily episodes, source assembly and release checks over the driver's event table, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from echoloom.durable import stored
from echoloom.operators import cells, checks, episodes, evidence, tracking
from echoloom.plans import evidence as ledgers
from echoloom.plans import monitoring
from echoloom.sources import assembly

RELEASE = "2024-02-29"


def _ledgers(spark, sf_dir):
    source = stored(ledgers._source(spark, sf_dir))
    return evidence.crop_days(source), evidence.pressure_days(source), stored(evidence.acquisition_ledger(source))


def _days(spark, sf_dir):
    crops, pressure, acquisitions = _ledgers(spark, sf_dir)
    return episodes.gathered_days(pressure, acquisitions), crops


def _replayed(spark, sf_dir):
    return episodes.replay(_days(spark, sf_dir)[0])


def episode_days(spark, sf_dir):
    return episodes.episode_days(_replayed(spark, sf_dir))


def episode_windows(spark, sf_dir):
    return episodes.episode_windows(_replayed(spark, sf_dir))


def ambiguous_responses(spark, sf_dir):
    return episodes.ambiguous_counts(_replayed(spark, sf_dir))


def dominant_signals(spark, sf_dir):
    return episodes.dominant_signals(_days(spark, sf_dir)[0])


def crop_of_decision(spark, sf_dir):
    """The crop that a decision day could know of."""
    _, pressure, _ = _ledgers(spark, sf_dir)
    crops, _, _ = _ledgers(spark, sf_dir)
    known = pressure.select("field_id", "crop_instance_id", F.date_add(F.to_date("observation_date"), 3).alias("decision_date")).distinct()
    return episodes.crop_as_of(known, crops, ["crop_name", "stage_bucket"])


def evidence_checks(spark, sf_dir):
    return checks.suite(checks.evidence_checks(*_ledgers(spark, sf_dir), RELEASE))


def tracking_checks(spark, sf_dir):
    comps, members, tracked = monitoring._tracks(spark, sf_dir)
    assigned = stored(tracking.assignments(tracked))
    return checks.suite(checks.tracking_checks(comps, members, assigned, stored(tracking.crop_incidents(members, assigned))))


def coverage_checks(spark, sf_dir):
    return checks.suite(checks.coverage_checks(monitoring._parts(spark, sf_dir)[0]))


def unsupported_hazards(spark, sf_dir):
    context, lanes = monitoring._parts(spark, sf_dir)
    base = cells.stage_baseline(context, lanes, "2024-01-10", monitoring.GRID).where("hazard_family <> 'heat'")
    return checks.unsupported_hazards(lanes, base, "2024-01-10")


def death_claims(spark, sf_dir):
    """Documents whose text claims a death or a loss."""
    return checks.death_claims(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["text"]).select("doc_id")


def rewritten_weeks(spark, sf_dir):
    """An old release of weekly states against a new one that dropped, changed, reopened and slipped in some."""
    rows = monitoring.week_lanes(spark, sf_dir).select("timeline_bucket", "crop_instance_id", "hazard_family", "field_id", "rank")
    keys = ["timeline_bucket", "crop_instance_id", "hazard_family"]
    n = F.substring("field_id", 7, 20).cast("long")
    old = rows.where((n % 5 != 4) & (F.col("timeline_bucket") <= F.lit("2024-01-15").cast("date"))).withColumn("state", F.when(F.col("rank") == 2, "CLOSED_DATA_CENSORED").otherwise("ACTIVE"))
    new = rows.where(n % 7 != 3).withColumn("state", F.when((F.col("rank") == 2) & (n % 2 == 0), "CLOSED_DATA_CENSORED").otherwise("ACTIVE"))
    return checks.rewritten_weeks(old, new, keys, "state")


def _origins(spark, sf_dir):
    rows = stored(monitoring._signals(spark, sf_dir))
    derived = rows.where("spectral_source_date is not null").select("field_id", "spectral_source_date").distinct().withColumn("d", F.lit(True))
    external = rows.where(F.dayofmonth("observation_date") % 4 == 0).select("field_id", F.date_sub("observation_date", 12).alias("spectral_source_date")).distinct().withColumn("x", F.lit(True))
    origin = F.when(F.col("d") & F.col("x"), "external_and_derived").when(F.col("d"), "derived").otherwise("external")
    return rows, derived.join(external, ["field_id", "spectral_source_date"], "full").select("field_id", "spectral_source_date", origin.alias("origin"))


def acquisition_reconciliation(spark, sf_dir):
    """Acquisitions that a crop owns on their day, and those from before any crop of the field."""
    rows, candidates = _origins(spark, sf_dir)
    first = rows.groupBy("field_id").agg(F.min("observation_date").alias("first"))
    return checks.reconciled(candidates, candidates.join(first, "field_id").where("spectral_source_date >= first").drop("first"))


def assembled_parts(spark, sf_dir):
    """Three parts of different columns as one table."""
    e = monitoring._events(spark, sf_dir).select("event_id", "user_id", "event_type", F.round("value", 6).alias("value"))
    return assembly.assembled([e.where("event_id % 3 = 0").drop("value"), e.where("event_id % 3 = 1").drop("event_type"), e.where("event_id % 3 = 2")])


def hashed_parts(spark, sf_dir):
    e = assembly.with_partition(monitoring._events(spark, sf_dir), "user_id", 16)
    return e.groupBy("part").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


def canonical_latest(spark, sf_dir):
    """One row a field and day under canonical names, whatever the source calls them."""
    e = monitoring._events(spark, sf_dir).select(F.col("user_id").alias("Field ID"), F.to_date("ts").alias("Obs-Date"), F.col("event_type").alias("Hazard"), F.col("event_id").alias("Revision"))
    names = {"field_id": ["field"], "observation_date": ["obs_date"], "hazard_family": ["hazard"], "revision": ["version"], "note": []}
    return assembly.latest_rows(assembly.renamed(e, names, ["field_id", "observation_date"]), ["field_id", "observation_date"], "revision").drop("note")


def enriched_source(spark, sf_dir):
    """The signals with a richer source, and the quality of their acquisitions."""
    rows = monitoring._signals(spark, sf_dir).select("field_id", "observation_date", "spectral_source_date", F.when(F.dayofmonth("observation_date") % 2 == 0, F.round("ndvi", 6)).alias("ndvi"))
    rich = monitoring._signals(spark, sf_dir).where(F.dayofmonth("observation_date") % 3 != 0).select("field_id", "observation_date", F.round("psri", 6).alias("ndvi"), F.date_add("observation_date", 1).alias("weather_available_at"))
    quality = rows.where("spectral_source_date is not null").groupBy("field_id", "spectral_source_date").agg((F.count("*") % 2 == 0).alias("good"))
    return assembly.enriched(rows, rich, quality, ["field_id", "observation_date"], ["ndvi"])


_NAMES = ["episode_days", "episode_windows", "ambiguous_responses", "dominant_signals", "crop_of_decision", "evidence_checks", "tracking_checks", "coverage_checks", "unsupported_hazards", "death_claims",
          "rewritten_weeks", "acquisition_reconciliation", "assembled_parts", "hashed_parts", "canonical_latest", "enriched_source"]
QUERIES = {name: globals()[name] for name in _NAMES}

DAYS = ledgers.SOURCE + """,
pd AS (SELECT *, greatest(observation_date, knowledge_time) AS decision_date FROM press),
ad AS (SELECT *, greatest(spectral_source_date, knowledge_time) AS decision_date FROM ledger WHERE new_response_evidence AND response_class IN ('recovery', 'medium_decline', 'severe_decline'))"""
_CHECKS = ["crop_keys_repeat", "pressure_keys_repeat", "acquisition_ids_repeat", "blank_keys", "pressure_known_after_release", "acquisitions_known_after_release", "acquisitions_known_before_source", "crops_known_before_day",
           "rank_without_observation", "observed_without_rank", "reference_not_earlier", "reference_not_usable", "evidence_of_rejected", "response_of_rejected", "missing_reason_kept"]
ORACLES = {
    "dominant_signals": f"""WITH {DAYS}, k AS (SELECT field_id, crop_instance_id, decision_date FROM pd UNION SELECT field_id, crop_instance_id, decision_date FROM ad),
      l AS (SELECT field_id, crop_instance_id, decision_date, min((-pressure_rank, hazard_family)) FILTER (WHERE pressure_observed) AS m, max(knowledge_time) AS lk FROM pd GROUP BY 1, 2, 3),
      a AS (SELECT field_id, crop_instance_id, decision_date, max((spectral_source_date, knowledge_time, CASE response_class WHEN 'recovery' THEN 0 WHEN 'medium_decline' THEN 1 ELSE 2 END, acquisition_id, response_class)) AS r, max(knowledge_time) AS ak FROM ad GROUP BY 1, 2, 3)
      SELECT field_id, crop_instance_id, decision_date, m IS NOT NULL AS pressure_observed, coalesce(-m[1], 0)::INT AS risk_rank, coalesce(m[2], 'none') AS hazard_family, coalesce(r[5], 'no_new_event_response') AS response_class,
        r IS NOT NULL AS new_response_evidence, greatest(lk, ak) AS knowledge_date FROM k LEFT JOIN l USING (field_id, crop_instance_id, decision_date) LEFT JOIN a USING (field_id, crop_instance_id, decision_date)""",
    "crop_of_decision": f"""WITH {ledgers.SOURCE}, q AS (SELECT DISTINCT field_id, crop_instance_id, observation_date + 3 AS decision_date FROM src)
      SELECT q.field_id, q.crop_instance_id, q.decision_date, arg_max(crop_name, (s.observation_date, s.stage_available_at)) AS crop_name, arg_max(s.stage_family, (s.observation_date, s.stage_available_at)) AS stage_bucket
      FROM q JOIN src s ON s.field_id = q.field_id AND s.crop_instance_id = q.crop_instance_id AND greatest(s.observation_date, s.stage_available_at) <= q.decision_date GROUP BY 1, 2, 3""",
    "evidence_checks": f"WITH {ledgers.SOURCE} SELECT unnest([{', '.join(repr(c) for c in _CHECKS)}]) AS \"check\", 0::BIGINT AS violations",
    "coverage_checks": "SELECT unnest(['centroid_coverage', 'stage_coverage', 'stage_coverage_of_crop']) AS \"check\", 0::BIGINT AS violations",
    "unsupported_hazards": f"""WITH {monitoring.WEEKS} SELECT DISTINCT hazard_family FROM lanes WHERE canonical AND timeline_bucket + 6 > DATE '2024-01-10' AND hazard_family NOT IN (
      SELECT hazard_family FROM lanes WHERE timeline_bucket + 6 <= DATE '2024-01-10' AND hazard_family <> 'heat')""",
    "death_claims": r"SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)\b(dead|death|died|dying|killed|total loss|crop loss)\b')",
    "rewritten_weeks": f"""WITH {monitoring.WEEKS}, r AS (SELECT timeline_bucket, crop_instance_id, hazard_family, rank, substr(field_id, 7)::BIGINT AS n FROM lanes),
      o AS (SELECT *, CASE WHEN rank = 2 THEN 'CLOSED_DATA_CENSORED' ELSE 'ACTIVE' END AS state FROM r WHERE n % 5 <> 4 AND timeline_bucket <= DATE '2024-01-15'),
      w AS (SELECT *, CASE WHEN rank = 2 AND n % 2 = 0 THEN 'CLOSED_DATA_CENSORED' ELSE 'ACTIVE' END AS state FROM r WHERE n % 7 <> 3),
      b AS (SELECT timeline_bucket, crop_instance_id, hazard_family, o.state AS a, w.state AS b, (SELECT max(timeline_bucket) FROM o) AS last FROM o FULL JOIN w USING (timeline_bucket, crop_instance_id, hazard_family)),
      s AS (SELECT timeline_bucket, crop_instance_id, hazard_family, CASE WHEN b IS NULL THEN 'removed' WHEN a IS NULL AND timeline_bucket <= last THEN 'slipped_in' WHEN a <> b AND timeline_bucket = last AND a = 'CLOSED_DATA_CENSORED' THEN 'reopened' WHEN a <> b THEN 'rewritten' END AS status FROM b)
      SELECT * FROM s WHERE status IS NOT NULL""",
    "acquisition_reconciliation": f"""WITH {monitoring.SIGNALS}, d AS (SELECT DISTINCT field_id, spectral_source_date FROM sig WHERE spectral_source_date IS NOT NULL), x AS (SELECT DISTINCT field_id, observation_date - 12 AS spectral_source_date FROM sig WHERE day(observation_date) % 4 = 0),
      c AS (SELECT field_id, spectral_source_date, CASE WHEN d.field_id IS NOT NULL AND x.field_id IS NOT NULL THEN 'external_and_derived' WHEN d.field_id IS NOT NULL THEN 'derived' ELSE 'external' END AS origin FROM d FULL JOIN x USING (field_id, spectral_source_date)),
      f AS (SELECT field_id, min(observation_date) AS first FROM sig GROUP BY 1), m AS (SELECT c.*, spectral_source_date >= first AS own FROM c JOIN f USING (field_id))
      SELECT origin, count(*) AS candidates, count(*) FILTER (WHERE own) AS published, count(*) FILTER (WHERE NOT own) AS excluded, true AS balanced FROM m GROUP BY 1""",
    "assembled_parts": "SELECT event_id, user_id, CASE WHEN event_id % 3 <> 1 THEN event_type END AS event_type, CASE WHEN event_id % 3 <> 0 THEN round(value, 6) END AS value FROM events",
    "hashed_parts": "SELECT (('0x' || substr(md5(user_id::VARCHAR), 1, 8))::BIGINT % 16)::INT AS part, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
    "canonical_latest": "SELECT user_id AS field_id, ts::DATE AS observation_date, arg_max(event_type, event_id) AS hazard_family, max(event_id) AS revision FROM events GROUP BY 1, 2",
    "enriched_source": f"""WITH {monitoring.SIGNALS}, r AS (SELECT field_id, observation_date, spectral_source_date, CASE WHEN day(observation_date) % 2 = 0 THEN round(ndvi, 6) END AS ndvi, round(psri, 6) AS other, day(observation_date) % 3 <> 0 AS rich FROM sig),
      a AS (SELECT field_id, spectral_source_date, min(observation_date) AS spectral_available_at, count(*) % 2 = 0 AS good FROM r WHERE spectral_source_date IS NOT NULL GROUP BY 1, 2)
      SELECT r.field_id, r.observation_date, r.spectral_source_date, coalesce(ndvi, CASE WHEN rich THEN other END) AS ndvi, spectral_available_at, good, CASE WHEN rich THEN observation_date + 1 ELSE observation_date END AS weather_available_at, observation_date AS stage_available_at
      FROM r LEFT JOIN a ON a.field_id = r.field_id AND a.spectral_source_date = r.spectral_source_date""",
}

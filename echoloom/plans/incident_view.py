"""The incident viewer over the driver's event table, and its SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from echoloom.durable import stored
from echoloom.operators import cells, checks, evidence, finalizer, incident_view
from echoloom.plans import evidence as ledgers
from echoloom.plans import learning, monitoring

SIZE = monitoring.GRID.size_km
PREVIEW = "2024-01-12"


def _parts(spark, sf_dir):
    """Incidents of a crop and hazard: their weeks with a claim, their members with cell and state, and the field weeks."""
    context, lanes = monitoring._parts(spark, sf_dir)
    placed = cells.on_grid(context, monitoring.GRID)
    own = lanes.where("canonical").join(placed.select("timeline_bucket", "crop_instance_id", "crop_name", "cell_x", "cell_y"), ["timeline_bucket", "crop_instance_id"])
    members = stored(own.select(F.concat_ws("/", "crop_name", "hazard_family").alias("incident_id"), "timeline_bucket", "field_id", "crop_instance_id", "event_state", "fresh", "cell_x", "cell_y"))
    some = {k: F.countDistinct(F.when(F.col("event_state") == k.upper(), F.col("field_id"))) for k in ("active", "severe")}
    weekly = members.groupBy("incident_id", "timeline_bucket").agg(F.countDistinct("field_id").alias("affected"), *[v.alias(k) for k, v in some.items()])
    return stored(weekly), members, stored(placed.select("timeline_bucket", "crop_instance_id", "stage_bucket", "evaluable", "cell_x", "cell_y"))


def incident_footprints(spark, sf_dir):
    _, members, _ = _parts(spark, sf_dir)
    out = incident_view.footprints(members, SIZE)
    return out.select("incident_id", "timeline_bucket", "role", F.array_join(F.transform("cells", lambda c: F.concat_ws(":", c["cell_x"].cast("string"), c["cell_y"].cast("string"))), ",").alias("cells"), F.round("area_km2", 6).alias("area_km2"), "coincident")


def incident_boundaries(spark, sf_dir):
    return incident_view.footprints(_parts(spark, sf_dir)[1], SIZE).select("incident_id", "timeline_bucket", "role", "boundary")


def frame_fields(spark, sf_dir):
    weekly, members, context = _parts(spark, sf_dir)
    return incident_view.frame_fields(members.drop("cell_x", "cell_y"), weekly, context).select("incident_id", "timeline_bucket", "field_id", "event_state", "affected", "stage_bucket", "evaluable")


def _days(spark, sf_dir):
    return monitoring._signals(spark, sf_dir).select("crop_instance_id", "observation_date", "pressure_observed", "risk_rank", "response_class")


def story_day_members(spark, sf_dir):
    return incident_view.story_days(_parts(spark, sf_dir)[1], _days(spark, sf_dir)).select("incident_id", "crop_instance_id", "observation_date", "risk_rank")


def _evidence(spark, sf_dir):
    source = stored(ledgers._source(spark, sf_dir))
    pressure = evidence.pressure_days(source).withColumn("knowledge_time", F.date_add("observation_date", (F.substring("field_id", 7, 20).cast("long") % 3).cast("int")))
    return pressure, evidence.acquisition_ledger(source)


def late_pressure(spark, sf_dir):
    return incident_view.late_pressure(_evidence(spark, sf_dir)[0]).groupBy("hazard_family", "days_late").agg(F.count("*").alias("n"))


def acquisition_marks(spark, sf_dir):
    return incident_view.acquisition_marks(_evidence(spark, sf_dir)[1]).select("acquisition_id", "mark", "why")


def incident_checkpoints(spark, sf_dir):
    weekly, members, _ = _parts(spark, sf_dir)
    out = incident_view.checkpoints(weekly, members, *_evidence(spark, sf_dir))
    return out.select("incident_id", "timeline_bucket", "affected", "known_through", "complete", "responses", "member_fields")


def _claimed(weekly):
    """Weeks as a release states them: some counters one too high, and claims that a state would make."""
    n = F.length("incident_id") + F.weekofyear("timeline_bucket")
    claim = F.when(n % 3 == 0, "severe_impact").when(n % 3 == 1, "fresh_impact").otherwise("none")
    return weekly.withColumns({"affected": F.col("affected") + (n % 4 == 0).cast("int"), "active": F.col("active") + (n % 5 == 0).cast("int"), "claim": claim})


def lifecycle_reconciliation(spark, sf_dir):
    weekly, members, _ = _parts(spark, sf_dir)
    out = incident_view.reconciliation(_claimed(weekly), members)
    return out.select("incident_id", "timeline_bucket", "claim", "reasons", "support", "contradicted")


def contradiction_diagnosis(spark, sf_dir):
    """Why a week is contradicted: the first diagnosis that holds."""
    rows = lifecycle_reconciliation(spark, sf_dir)
    rules = [("consistent", ~F.col("contradicted")), ("counter_and_claim", F.col("reasons").contains("mismatch") & F.col("reasons").contains("unsupported")), ("counter_only", F.col("reasons").contains("mismatch")), ("quiet_claim", F.col("support") == "quiet")]
    return checks.diagnosed(rows, rules, "claim_only").select("incident_id", "timeline_bucket", "diagnosis", "same")


def incident_spine(spark, sf_dir):
    weekly, members, _ = _parts(spark, sf_dir)
    return incident_view.spine(weekly, incident_view.story_days(members, _days(spark, sf_dir))).select("incident_id", "day", "affected", "day_members", "day_observed", "covered")


def viewer_checks(spark, sf_dir):
    weekly, members, context = _parts(spark, sf_dir)
    days = incident_view.story_days(members, _days(spark, sf_dir))
    return checks.suite({
        "weeks_repeat": checks.duplicates(weekly, ["incident_id", "timeline_bucket"]), "members_repeat": checks.duplicates(members, ["incident_id", "timeline_bucket", "field_id"]),
        "members_without_week": checks.orphans(members, weekly, ["incident_id", "timeline_bucket"]), "members_without_context": checks.orphans(members, context, ["timeline_bucket", "crop_instance_id"]),
        "weeks_without_members": checks.orphans(weekly, members, ["incident_id", "timeline_bucket"]), "not_mondays": weekly.where("weekday(timeline_bucket) <> 0"),
        "days_outside_week": days.where("observation_date < timeline_bucket or observation_date > date_add(timeline_bucket, 6)"), "more_severe_than_affected": weekly.where("active + severe > affected"),
    })


def archetype_preview(spark, sf_dir):
    rows = learning._signals(spark, sf_dir)
    anchors = stored(learning.learning.anchors(learning._story_days(rows), learning._story_events(rows), learning.MATURE, learning.LEAST))
    labels = rows.groupBy(F.col("crop_instance_id").alias("event_id")).agg(F.max("risk_band").alias("label"), F.when(F.min("n") % 5 == 0, "calibration").otherwise("train").alias("split"))
    return incident_view.preview(labels, anchors, PREVIEW).select("event_id", "mask", "shown_label")


def motif_export(spark, sf_dir):
    weekly, members, _ = _parts(spark, sf_dir)
    labels = monitoring._signals(spark, sf_dir).where("risk_rank >= 4").groupBy("crop_instance_id").agg(F.max("hazard_family").alias("label"))
    return incident_view.export(members, weekly, labels).select("incident_id", "timeline_bucket", "field_id", "affected", "severe", "label")


def incident_drilldown(spark, sf_dir):
    weekly, members, _ = _parts(spark, sf_dir)
    return incident_view.drilldown(weekly, members, _days(spark, sf_dir))


def incident_stage_rates(spark, sf_dir):
    weekly, members, context = _parts(spark, sf_dir)
    return incident_view.stage_rates(weekly, members, context).withColumn("rate", F.round("rate", 9))


def incident_weeks(spark, sf_dir):
    weekly, members, context = _parts(spark, sf_dir)
    return incident_view.with_totals(weekly, incident_view.stage_rates(weekly, members, context))


def _final_inputs(spark, sf_dir):
    """Members with role and episode, the scaffold, follow-ups and lineage (a crop's drought splits off its heat)."""
    weekly, members, context = _parts(spark, sf_dir)
    core, fresh = F.col("event_state").isin("ACTIVE", "SEVERE"), F.col("fresh")
    key = F.concat_ws("/", "field_id", "crop_instance_id", F.substring_index("incident_id", "/", -1)).alias("episode_key")
    own = members.select("incident_id", "timeline_bucket", key, F.when(core, "pressure_core").when(fresh, "impact_lag").otherwise("watch_frontier").alias("membership_role"), "event_state", fresh.alias("fresh_decline"), F.lit(False).alias("fresh_recovery"), "cell_x", "cell_y")
    own = stored(own)
    healed = _days(spark, sf_dir).where("response_class = 'recovery'").select("crop_instance_id", F.date_trunc("week", "observation_date").cast("date").alias("timeline_bucket")).distinct()
    held = members.select("incident_id", "field_id", "crop_instance_id").distinct()
    seen = healed.join(held, "crop_instance_id").select(key, "timeline_bucket", F.lit("RECOVERING").alias("event_state"), F.lit(False).alias("fresh_decline"), F.lit(True).alias("fresh_recovery"))
    weeks = stored(finalizer.scaffold(own, context))
    # The first week of a crop's drought that follows a week of its heat: one edge a crop.
    crop = F.substring_index("incident_id", "/", 1).alias("crop")
    heat, dry = (weekly.where(F.col("incident_id").endswith(h)).select(crop, "incident_id", "timeline_bucket") for h in ("/heat", "/drought"))
    edges = heat.select("crop", F.col("incident_id").alias("parent_incident_id"), F.date_add("timeline_bucket", 7).alias("timeline_bucket")).join(dry.select("crop", F.col("incident_id").alias("child_incident_id"), "timeline_bucket"), ["crop", "timeline_bucket"])
    edges = edges.groupBy("parent_incident_id", "child_incident_id").agg(F.max("timeline_bucket").alias("timeline_bucket")).withColumn("relation", F.lit("split"))
    return weeks, own, edges, stored(finalizer.follow_ups(own, seen))


def story_scaffold(spark, sf_dir):
    return _final_inputs(spark, sf_dir)[0].select("incident_id", "timeline_bucket", "adequate", "core_count", "is_tail")


def follow_up_evidence(spark, sf_dir):
    return _final_inputs(spark, sf_dir)[3].select("incident_id", "episode_key", "timeline_bucket", "fresh_recovery")


def final_story_weeks(spark, sf_dir):
    return finalizer.finalize(*_final_inputs(spark, sf_dir))


def final_story_windows(spark, sf_dir):
    return finalizer.story_windows(final_story_weeks(spark, sf_dir))


_NAMES = ["story_scaffold", "follow_up_evidence", "final_story_weeks", "final_story_windows", "incident_footprints", "incident_boundaries", "frame_fields", "story_day_members", "late_pressure", "acquisition_marks", "incident_checkpoints", "lifecycle_reconciliation", "contradiction_diagnosis", "incident_spine",
          "viewer_checks", "archetype_preview", "motif_export", "incident_drilldown", "incident_stage_rates", "incident_weeks"]
QUERIES = {name: globals()[name] for name in _NAMES}

LOCATED = monitoring.WEEKS + f""",
loc AS (SELECT *, CASE substr(field_id, 7)::BIGINT % 3 WHEN 0 THEN 'Maize' WHEN 1 THEN 'Beans' ELSE 'Rice' END AS crop_name, floor((centroid_lon - 29.0::DOUBLE) * {monitoring.GRID.km_per_lon!r}::DOUBLE / 5.0::DOUBLE)::BIGINT AS cell_x,
  floor((centroid_lat - -2.0::DOUBLE) * 110.574::DOUBLE / 5.0::DOUBLE)::BIGINT AS cell_y FROM context),
mem AS (SELECT c.crop_name || '/' || hazard_family AS incident_id, l.timeline_bucket, l.field_id, l.crop_instance_id, event_state, fresh, cell_x, cell_y FROM lanes l JOIN loc c USING (timeline_bucket, crop_instance_id) WHERE canonical),
iw AS (SELECT incident_id, timeline_bucket, count(DISTINCT field_id) AS affected, count(DISTINCT CASE WHEN event_state = 'ACTIVE' THEN field_id END) AS active, count(DISTINCT CASE WHEN event_state = 'SEVERE' THEN field_id END) AS severe FROM mem GROUP BY 1, 2),
sday AS (SELECT DISTINCT m.incident_id, m.timeline_bucket, s.crop_instance_id, s.observation_date, s.pressure_observed, s.risk_rank, s.response_class FROM mem m JOIN sig s ON s.crop_instance_id = m.crop_instance_id AND date_trunc('week', s.observation_date) = m.timeline_bucket)"""
RECONCILED = LOCATED + """,
st AS (SELECT *, (length(incident_id) + week(timeline_bucket)) AS n FROM iw),
cl AS (SELECT incident_id, timeline_bucket, affected + (n % 4 = 0)::INT AS affected, active + (n % 5 = 0)::INT AS active, severe, CASE n % 3 WHEN 0 THEN 'severe_impact' WHEN 1 THEN 'fresh_impact' ELSE 'none' END AS claim FROM st),
mm AS (SELECT incident_id, timeline_bucket, count(DISTINCT field_id) AS a, count(DISTINCT CASE WHEN event_state = 'ACTIVE' THEN field_id END) AS b, count(DISTINCT CASE WHEN event_state = 'SEVERE' THEN field_id END) AS c, count(DISTINCT CASE WHEN fresh THEN field_id END) AS f FROM mem GROUP BY 1, 2),
rec AS (SELECT incident_id, timeline_bucket, claim, concat_ws('+', CASE WHEN affected <> a THEN 'affected_mismatch' END, CASE WHEN active <> b THEN 'active_mismatch' END, CASE WHEN severe <> c THEN 'severe_mismatch' END,
    CASE WHEN claim = 'severe_impact' AND c = 0 THEN 'severity_unsupported' END, CASE WHEN claim = 'fresh_impact' AND f = 0 THEN 'impact_unsupported' END) AS reasons,
  CASE WHEN b + c > 0 THEN 'pressure' WHEN a > 0 THEN 'watch_only' ELSE 'quiet' END AS support FROM cl JOIN mm USING (incident_id, timeline_bucket))"""
RATES = LOCATED + """,
ce AS (SELECT DISTINCT incident_id, timeline_bucket, cell_x, cell_y FROM mem), he AS (SELECT ce.*, loc.crop_instance_id, loc.stage_bucket, loc.evaluable FROM ce LEFT JOIN loc USING (timeline_bucket, cell_x, cell_y)),
be AS (SELECT incident_id, timeline_bucket, stage_bucket, count(DISTINCT CASE WHEN evaluable THEN crop_instance_id END) AS evaluable_instances FROM he GROUP BY 1, 2, 3),
ab AS (SELECT m.incident_id, m.timeline_bucket, loc.stage_bucket, count(DISTINCT m.crop_instance_id) AS affected_instances FROM mem m JOIN loc USING (timeline_bucket, crop_instance_id) GROUP BY 1, 2, 3),
mi AS (SELECT incident_id, timeline_bucket, count(*) FILTER (WHERE NOT found) AS missing_cells FROM (SELECT incident_id, timeline_bucket, cell_x, cell_y, coalesce(bool_or(evaluable), false) AS found FROM he GROUP BY 1, 2, 3, 4) GROUP BY 1, 2),
ra AS (SELECT be.*, coalesce(affected_instances, 0) AS affected_instances, missing_cells, round(coalesce(coalesce(affected_instances, 0) / nullif(evaluable_instances, 0), 0), 9) AS rate FROM be LEFT JOIN ab USING (incident_id, timeline_bucket, stage_bucket) JOIN mi USING (incident_id, timeline_bucket))"""
_VIEWER = ["weeks_repeat", "members_repeat", "members_without_week", "members_without_context", "weeks_without_members", "not_mondays", "days_outside_week", "more_severe_than_affected"]
ORACLES = {
    "story_scaffold": f"""WITH {LOCATED}, o AS (SELECT incident_id, timeline_bucket, list(DISTINCT (cell_x, cell_y)) AS own, count(*) FILTER (WHERE event_state IN ('ACTIVE', 'SEVERE')) AS core FROM mem GROUP BY 1, 2),
      w AS (SELECT incident_id, unnest(generate_series(min(timeline_bucket), max(timeline_bucket) + 28, INTERVAL 7 DAY))::DATE AS timeline_bucket FROM o GROUP BY 1),
      r AS (SELECT w.*, own, core, last_value(own IGNORE NULLS) OVER (PARTITION BY w.incident_id ORDER BY w.timeline_bucket) AS cells FROM w LEFT JOIN o USING (incident_id, timeline_bucket)),
      s AS (SELECT timeline_bucket, cell_x, cell_y, bool_or(evaluable) AS seen FROM loc GROUP BY 1, 2, 3), u AS (SELECT incident_id, timeline_bucket, unnest(cells) AS c FROM r),
      a AS (SELECT u.incident_id, u.timeline_bucket, bool_and(coalesce(seen, false)) AS adequate FROM u LEFT JOIN s ON s.timeline_bucket = u.timeline_bucket AND s.cell_x = c[1] AND s.cell_y = c[2] GROUP BY 1, 2)
      SELECT r.incident_id, r.timeline_bucket, adequate, coalesce(core, 0) AS core_count, own IS NULL AS is_tail FROM r JOIN a USING (incident_id, timeline_bucket)""",
    "follow_up_evidence": f"""WITH {LOCATED}, k AS (SELECT incident_id, timeline_bucket, concat_ws('/', field_id, crop_instance_id, split_part(incident_id, '/', 2)) AS episode_key, crop_instance_id FROM mem),
      e AS (SELECT DISTINCT k.episode_key, date_trunc('week', s.observation_date)::DATE AS timeline_bucket FROM k JOIN sig s USING (crop_instance_id) WHERE s.response_class = 'recovery'),
      h AS (SELECT incident_id, episode_key, min(timeline_bucket) AS a, max(timeline_bucket) AS z FROM k GROUP BY 1, 2)
      SELECT h.incident_id, e.episode_key, e.timeline_bucket, true AS fresh_recovery FROM e JOIN h USING (episode_key) WHERE e.timeline_bucket BETWEEN a AND z + 28
      AND NOT EXISTS (SELECT 1 FROM k WHERE k.incident_id = h.incident_id AND k.episode_key = e.episode_key AND k.timeline_bucket = e.timeline_bucket)""",
    "incident_footprints": f"""WITH {LOCATED}, r AS (SELECT incident_id, timeline_bucket, CASE WHEN event_state IN ('ACTIVE', 'SEVERE') THEN 'core' ELSE 'watch' END AS role, cell_x, cell_y FROM mem UNION ALL SELECT incident_id, timeline_bucket, 'combined', cell_x, cell_y FROM mem),
      f AS (SELECT incident_id, timeline_bucket, role, list_transform(list_sort(list(DISTINCT (cell_x, cell_y))), lambda c: c[1]::VARCHAR || ':' || c[2]::VARCHAR) AS l FROM r GROUP BY 1, 2, 3), g AS (SELECT *, array_to_string(l, ',') AS cells FROM f)
      SELECT incident_id, timeline_bucket, role, cells, round(len(l) * {SIZE * SIZE!r}::DOUBLE, 6) AS area_km2, count(*) OVER (PARTITION BY timeline_bucket, role, cells) > 1 AS coincident FROM g""",
    "frame_fields": f"WITH {LOCATED} SELECT m.incident_id, m.timeline_bucket, m.field_id, m.event_state, affected, stage_bucket, evaluable FROM mem m JOIN iw USING (incident_id, timeline_bucket) JOIN loc USING (timeline_bucket, crop_instance_id)",
    "story_day_members": f"WITH {LOCATED} SELECT incident_id, crop_instance_id, observation_date, risk_rank FROM sday",
    "late_pressure": f"WITH {ledgers.SOURCE}, l AS (SELECT hazard_family, (substr(field_id, 7)::BIGINT % 3)::INT AS days_late FROM press) SELECT hazard_family, days_late, count(*) AS n FROM l WHERE days_late > 0 GROUP BY 1, 2",
    "acquisition_marks": f"""WITH {ledgers.SOURCE} SELECT acquisition_id, CASE WHEN status <> 'usable' THEN 'attempt' WHEN response_class IN ('medium_decline', 'severe_decline', 'recovery') THEN 'update' ELSE 'look' END AS mark,
      CASE WHEN status <> 'usable' THEN regexp_replace(status, '^rejected_', '') END AS why FROM ledger""",
    "lifecycle_reconciliation": f"WITH {RECONCILED} SELECT *, reasons <> '' AS contradicted FROM rec",
    "contradiction_diagnosis": f"""WITH {RECONCILED}, d AS (SELECT incident_id, timeline_bucket, CASE WHEN reasons = '' THEN 'consistent' WHEN reasons LIKE '%mismatch%' AND reasons LIKE '%unsupported%' THEN 'counter_and_claim' WHEN reasons LIKE '%mismatch%' THEN 'counter_only'
      WHEN support = 'quiet' THEN 'quiet_claim' ELSE 'claim_only' END AS diagnosis FROM rec) SELECT *, count(*) OVER (PARTITION BY diagnosis) AS same FROM d""",
    "incident_spine": f"""WITH {LOCATED}, sp AS (SELECT incident_id, unnest(generate_series(min(timeline_bucket), max(timeline_bucket) + 6, INTERVAL 1 DAY))::DATE AS day FROM iw GROUP BY 1),
      o AS (SELECT incident_id, observation_date AS day, count(DISTINCT crop_instance_id) AS day_members, count(*) FILTER (WHERE pressure_observed) AS day_observed FROM sday GROUP BY 1, 2)
      SELECT sp.incident_id, sp.day, coalesce(affected, 0) AS affected, coalesce(day_members, 0) AS day_members, coalesce(day_observed, 0) AS day_observed, affected IS NOT NULL AS covered
      FROM sp LEFT JOIN iw ON iw.incident_id = sp.incident_id AND iw.timeline_bucket = date_trunc('week', sp.day)::DATE LEFT JOIN o ON o.incident_id = sp.incident_id AND o.day = sp.day""",
    "viewer_checks": f"SELECT unnest([{', '.join(repr(c) for c in _VIEWER)}]) AS \"check\", 0::BIGINT AS violations",
    "archetype_preview": f"""WITH {learning.ANCHORS}, lb AS (SELECT crop_instance_id AS event_id, max(risk_band) AS label, min(n) % 5 = 0 AS held FROM sg GROUP BY 1),
      m AS (SELECT event_id, label, CASE WHEN held THEN 'held_back' WHEN outcome <> 'eligible' THEN 'not_eligible' WHEN anchor_date > DATE '{PREVIEW}' THEN 'before_anchor' END AS mask FROM lb LEFT JOIN an USING (event_id)) SELECT event_id, mask, CASE WHEN mask IS NULL THEN label END AS shown_label FROM m""",
    "motif_export": f"""WITH {LOCATED}, lb AS (SELECT crop_instance_id, max(hazard_family) AS label FROM sig WHERE risk_rank >= 4 GROUP BY 1)
      SELECT m.incident_id, m.timeline_bucket, m.field_id, affected, severe, coalesce(label, 'unlabelled') AS label FROM mem m JOIN iw USING (incident_id, timeline_bucket) LEFT JOIN lb ON lb.crop_instance_id = m.crop_instance_id""",
    "incident_drilldown": f"""WITH {LOCATED}, e AS (SELECT incident_id, timeline_bucket, count(*) FILTER (WHERE pressure_observed) AS observed_days, max(risk_rank) AS peak_rank, count(*) FILTER (WHERE response_class IN ('medium_decline', 'severe_decline')) AS declines,
        count(*) FILTER (WHERE response_class = 'recovery') AS recoveries FROM sday GROUP BY 1, 2)
      SELECT iw.*, observed_days, peak_rank, declines, recoveries, row_number() OVER w AS week_number, coalesce((timeline_bucket - lag(timeline_bucket) OVER w) // 7 - 1, 0)::INT AS gap_weeks FROM iw JOIN e USING (incident_id, timeline_bucket) WINDOW w AS (PARTITION BY incident_id ORDER BY timeline_bucket)""",
    "incident_stage_rates": f"WITH {RATES} SELECT incident_id, timeline_bucket, stage_bucket, evaluable_instances, affected_instances, missing_cells, rate FROM ra",
    "incident_weeks": f"""WITH {RATES}, t AS (SELECT incident_id, timeline_bucket, sum(evaluable_instances)::BIGINT AS evaluable_total, sum(affected_instances)::BIGINT AS affected_total, max(missing_cells) AS missing_cells FROM ra GROUP BY 1, 2)
      SELECT iw.*, evaluable_total, affected_total, missing_cells, missing_cells = 0 AND evaluable_total >= 1 AS adequate FROM iw JOIN t USING (incident_id, timeline_bucket)""",
}

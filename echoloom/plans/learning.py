"""Features, ownership, models and their evaluation over the driver's event table, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from echoloom.durable import stored
from echoloom.operators import learning, prototypes, tracking
from echoloom.operators.serving import shares
from echoloom.plans import monitoring

MATURE, LEAST, CUTOFF = 6, 3, "2024-01-26"
FEATURES = ("ndvi", "ndmi", "psri")
KINDS = {"ndvi": ("continuous", "index"), "ndmi": ("continuous", "index"), "psri": ("continuous", "index"), "observed": ("binary", "quality"), "risk_rank": ("continuous", "pressure")}


def _signals(spark, sf_dir):
    return stored(monitoring._signals(spark, sf_dir).withColumn("n", F.substring("field_id", 7, 20).cast("long")))


def _story_days(rows):
    state = F.when(F.col("risk_rank") >= 4, "SEVERE").when(F.col("risk_rank") >= 3, "ACTIVE").otherwise("WATCH")
    return rows.select(F.col("crop_instance_id").alias("event_id"), "observation_date", state.alias("state"), F.col("risk_rank"), F.col("pressure_observed").alias("usable"), "response_class", "ndvi_delta", F.col("ndvi").alias("intensity"))


def _story_events(rows):
    last = F.max("observation_date")
    return rows.groupBy(F.col("crop_instance_id").alias("event_id")).agg(
        F.min("observation_date").alias("start_date"), F.when(last < F.lit(CUTOFF).cast("date"), last).alias("end_date"), (F.min("n") % 4 == 0).alias("boundary"))


def event_anchors(spark, sf_dir):
    rows = _signals(spark, sf_dir)
    out = learning.anchors(_story_days(rows), _story_events(rows), MATURE, LEAST)
    return _rounded(out)


def anchor_leaks(spark, sf_dir):
    """Anchors that read past themselves: there are none."""
    return event_anchors(spark, sf_dir).where("evidence_to > anchor_date").agg(F.count("*").alias("leaks"))


def _incidents(spark, sf_dir):
    """Incidents of a crop and hazard: their weeks, and their members."""
    context, lanes = monitoring._parts(spark, sf_dir)
    weeks = context.groupBy("timeline_bucket", "crop_name").agg(F.countDistinct("field_id").alias("monitored"), F.countDistinct(F.when(F.col("evaluable"), F.col("field_id"))).alias("evaluable"))
    own = lanes.where("canonical").join(context.select("timeline_bucket", "crop_instance_id", "crop_name", "stage_bucket"), ["timeline_bucket", "crop_instance_id"])
    incident = F.concat_ws("/", "crop_name", "hazard_family").alias("incident_id")
    counts = own.groupBy(incident, "timeline_bucket", "crop_name").agg(
        F.countDistinct("field_id").alias("affected"), F.countDistinct(F.when(F.col("event_state") == "ACTIVE", F.col("field_id"))).alias("active"), F.countDistinct(F.when(F.col("event_state") == "SEVERE", F.col("field_id"))).alias("severe"))
    return stored(counts.join(weeks, ["timeline_bucket", "crop_name"]).drop("crop_name")), stored(own.select(incident, "timeline_bucket", "field_id", "stage_bucket"))


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) + 0.0 for c, t in df.dtypes if t == "double"})  # no negative nought


def incident_features(spark, sf_dir):
    return _rounded(learning.incident_features(*_incidents(spark, sf_dir)))


def incident_prefixes(spark, sf_dir):
    return _rounded(learning.incident_features(*_incidents(spark, sf_dir), learning.HORIZONS))


def archetype_features(spark, sf_dir):
    """Features scaled within their hazard, groups weighing alike."""
    rows = _signals(spark, sf_dir).withColumn("observed", F.col("pressure_observed").cast("int"))
    schema = learning.weighted_schema(rows.where("hazard_family <> 'none'"), KINDS, ["hazard_family"])
    out = learning.weighted_features(rows.select("field_id", "observation_date", "hazard_family", *KINDS), schema, KINDS, ["hazard_family"])
    return out.withColumns({c: F.round(c, 6) for c in KINDS})


def purged_split(spark, sf_dir):
    """Splits by week; a field that several have goes as its earliest does."""
    week = F.weekofyear("observation_date")
    split = F.when(week <= 2, "train").when(week == 3, "calibration").otherwise("test")
    rows = _signals(spark, sf_dir).select("crop_instance_id", "observation_date", "hazard_family", split.alias("own_split"), F.concat_ws("/", "crop_name", F.col("n").cast("string")).alias("purge_group"))
    return learning.purged_split(rows, "purge_group", "own_split", ["train", "calibration", "test"]).select("crop_instance_id", "observation_date", "purge_group", "own_split", "purged_split")


def _claims(rows):
    return rows.where("pressure_observed and risk_rank >= 2").select(F.col("field_id").alias("key"), F.concat_ws("/", "hazard_family", "crop_season").alias("owner_id"), F.col("observation_date").alias("claimed"), F.date_add("observation_date", (F.col("n") % 3).cast("int")).alias("known"))


def ownership_spans(spark, sf_dir):
    return learning.ownership(_claims(_signals(spark, sf_dir)))


def owned_evidence(spark, sf_dir):
    rows = _signals(spark, sf_dir)
    evidence = rows.where("is_new_acquisition").select(F.col("field_id").alias("key"), F.col("spectral_source_date").alias("day"), "response_class")
    return learning.owned_evidence(evidence, learning.ownership(_claims(rows)))


def learning_snapshots(spark, sf_dir):
    rows = _signals(spark, sf_dir)
    lanes = rows.where("pressure_observed").select("field_id", F.col("observation_date").alias("day"), F.col("risk_rank").alias("rank"))
    looks = rows.where("is_new_acquisition").select("field_id", F.col("observation_date").alias("day"), F.col("response_class").isin(*learning.DECLINES).alias("declined"))
    return learning.cumulative_snapshots(lanes, looks, "field_id")


def landmark_rows(spark, sf_dir):
    return learning.landmarks(learning_snapshots(spark, sf_dir), "field_id", ["weather_horizon", "s2_horizon"], "as_of").select("field_id", "weather_horizon", "s2_horizon", "as_of", "hot_days", "declines")


def review_overlay(spark, sf_dir):
    rows = _signals(spark, sf_dir).groupBy("crop_instance_id").agg(F.max("risk_band").alias("label"), F.min("n").alias("n"))
    reviews = rows.where("n % 3 = 0").select("crop_instance_id", F.when(F.col("n") % 2 == 0, "novel").otherwise("reviewed").alias("reviewed_label"))
    return learning.overlay(rows, reviews, "crop_instance_id", "label").select("crop_instance_id", "label", "final_label", "was_reviewed")


def label_stability(spark, sf_dir):
    """How well two subsamples' labellings agree, label by label."""
    rows = _signals(spark, sf_dir).withColumn("key", F.concat_ws("/", "field_id", F.col("observation_date").cast("string")))
    left = learning.hashed_share(rows, "key", "a", 80).select("key", F.col("hazard_family").alias("label"))
    right = learning.hashed_share(rows, "key", "b", 80).select("key", F.when(F.col("risk_rank") >= 3, F.col("hazard_family")).otherwise("none").alias("label"))
    return learning.best_jaccard(left, right, "key", "label").withColumn("best_jaccard", F.round("best_jaccard", 9))


def archetype_assignment(spark, sf_dir):
    """Nearest frozen prototypes by one matrix product a batch."""
    rows, model = monitoring._model(spark, sf_dir)
    out = learning.matrix_assign(rows.select("field_id", "observation_date", "hazard_family", *FEATURES), model.withColumnRenamed("risk_band", "label"), FEATURES, "hazard_family", "label", ["field_id", "observation_date"])
    return out.select("field_id", "observation_date", "hazard_family", "label", F.round("distance", 6).alias("distance"), (F.col("distance") <= F.col("radius") + 1e-9).alias("inside"))


def quality_gates(spark, sf_dir):
    rows, model = monitoring._model(spark, sf_dir)
    judged = prototypes.assign(rows.drop("risk_band"), model, FEATURES, ["hazard_family"], "risk_band", ["field_id", "observation_date", "hazard_family"])
    measured = judged.groupBy("hazard_family").agg(F.avg(F.col("accepted").cast("int")).alias("accept"), F.avg((F.col("assignment") == "novel").cast("int")).alias("novel"), F.count("*").alias("n"))
    return learning.gates(measured, {"accept": (">=", 0.65), "novel": ("<=", 0.35), "n": (">=", 50.0)}).withColumn("value", F.round("value", 9))


def motif_rows(spark, sf_dir):
    """The week's share of each hazard for each incident, which feeds the motifs."""
    _, members = _incidents(spark, sf_dir)
    return shares(members, ["incident_id"], "stage_bucket").withColumn("share", F.round("share", 9))


def _labelled(spark, sf_dir):
    """Daily rows with a reviewed label (some are novel) and a split by day, in one stratum a hazard."""
    rows = _signals(spark, sf_dir).where("hazard_family <> 'none'")
    label = F.when(F.col("n") % 5 != 0, F.when(F.col("ndvi") < 0.5, "low").otherwise("high"))
    split = F.when(F.dayofmonth("observation_date") % 3 == 0, "calibration").when(F.dayofmonth("observation_date") % 3 == 1, "train").otherwise("test")
    return stored(rows.select("field_id", "observation_date", "hazard_family", *FEATURES, label.alias("motif"), split.alias("split")))


def calibrated_model(spark, sf_dir):
    return learning.calibrated_model(_labelled(spark, sf_dir), FEATURES, ["hazard_family"], "motif", "split")


def open_set_assignment(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    model = stored(learning.calibrated_model(rows, FEATURES, ["hazard_family"], "motif", "split"))
    return learning.open_set(rows.drop("motif"), model, FEATURES, ["hazard_family"], "motif", ["field_id", "observation_date"])


def rolling_evaluation(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    model = stored(learning.calibrated_model(rows, FEATURES, ["hazard_family"], "motif", "split"))
    judged = learning.open_set(rows.drop("motif"), model, FEATURES, ["hazard_family"], "motif", ["field_id", "observation_date"])
    judged = judged.join(rows.where("split = 'test'").select("field_id", "observation_date", F.col("motif").alias("truth")), ["field_id", "observation_date"])
    return learning.evaluation(judged.withColumn("week", F.weekofyear("observation_date")), "truth", ["week"])


def motif_discovery(spark, sf_dir):
    rows = _signals(spark, sf_dir).where("hazard_family <> 'none'").select(F.concat_ws("/", "field_id", F.col("observation_date").cast("string")).alias("key"), "hazard_family", *FEATURES)
    return learning.discover(rows, FEATURES, "hazard_family", "key", least=10, samples=5)


def motif_prototypes(spark, sf_dir):
    rows = stored(_signals(spark, sf_dir).where("hazard_family <> 'none'").select(F.concat_ws("/", "field_id", F.col("observation_date").cast("string")).alias("key"), "hazard_family", *FEATURES))
    return learning.cluster_model(rows, stored(learning.discover(rows, FEATURES, "hazard_family", "key", least=10, samples=5)), FEATURES, "hazard_family", "key")


def lesson_eligibility(spark, sf_dir):
    lives = monitoring.incident_lifecycles(spark, sf_dir)
    stories = tracking.lifecycle_windows(lives).select("incident_id", F.col("incident_state").alias("state"), "confirmed_week", "last_week", ((F.date_diff("last_week", "opened_week") / 7).cast("int") + 1).alias("weeks"))
    return learning.eligibility(stories, "2024-01-31")


_NAMES = [
    "event_anchors", "anchor_leaks", "incident_features", "incident_prefixes", "archetype_features", "purged_split", "ownership_spans", "owned_evidence", "learning_snapshots", "landmark_rows", "review_overlay",
    "label_stability", "archetype_assignment", "quality_gates", "motif_rows", "calibrated_model", "open_set_assignment", "rolling_evaluation", "motif_discovery", "motif_prototypes", "lesson_eligibility",
]
QUERIES = {name: globals()[name] for name in _NAMES}

SIG = monitoring.SIGNALS + ", sg AS (SELECT *, substr(field_id, 7)::BIGINT AS n, response_class AS rc FROM sig)"
ANCHORS = SIG + f""",
d AS (SELECT crop_instance_id AS event_id, observation_date AS day, CASE WHEN risk_rank >= 4 THEN 'SEVERE' WHEN risk_rank >= 3 THEN 'ACTIVE' ELSE 'WATCH' END AS state, risk_rank, pressure_observed AS usable, rc, d1, ndvi,
  sum(pressure_observed::INT) OVER (PARTITION BY crop_instance_id ORDER BY observation_date) AS nth FROM sg),
ev AS (SELECT crop_instance_id AS event_id, min(observation_date) AS start_date, CASE WHEN max(observation_date) < DATE '{CUTOFF}' THEN max(observation_date) END AS end_date, min(n) % 4 = 0 AS boundary FROM sg GROUP BY 1),
kn AS (SELECT ev.*, ripe, coalesce(ripe, end_date) AS anchor_date FROM ev LEFT JOIN (SELECT event_id, min(day) AS ripe FROM d WHERE usable AND nth = {MATURE} GROUP BY 1) USING (event_id)),
al AS (SELECT d.*, anchor_date, start_date FROM d JOIN kn USING (event_id)),
ins AS (SELECT *, sum((usable AND risk_rank < 3)::INT) OVER (PARTITION BY event_id ORDER BY day) AS island, min(CASE WHEN rc IN ('medium_decline', 'severe_decline') THEN day END) OVER (PARTITION BY event_id) AS ff FROM al WHERE anchor_date IS NULL OR day <= anchor_date),
runs AS (SELECT event_id, max(run) AS longest FROM (SELECT event_id, island, count(*) AS run FROM ins WHERE usable AND risk_rank >= 3 GROUP BY 1, 2) GROUP BY 1),
wh AS (SELECT event_id, count(*) FILTER (WHERE usable) AS usable_days, count(*) FILTER (WHERE NOT usable) AS missing_days, bool_or(state IN ('ACTIVE', 'SEVERE')) AS grave, max(risk_rank) FILTER (WHERE usable) AS peak_rank,
  avg(risk_rank) FILTER (WHERE usable) AS mean_rank, regr_slope(CASE WHEN usable THEN risk_rank END, day - start_date) AS slope, count(*) FILTER (WHERE usable AND risk_rank >= 3) AS hot, count(*) FILTER (WHERE rc IN ('medium_decline', 'severe_decline')) AS declines,
  count(*) FILTER (WHERE rc = 'recovery' AND day > ff) AS recoveries, min(ff) AS ff, min(d1) FILTER (WHERE rc IN ('medium_decline', 'severe_decline', 'recovery')) AS worst, max(ndvi) AS intensity, max(day) AS evidence_to FROM ins GROUP BY 1),
an AS (SELECT kn.*, wh.* EXCLUDE (event_id), coalesce(longest, 0) AS longest, coalesce(after, 0) AS rows_after_anchor, CASE WHEN end_date IS NOT NULL AND boundary AND ripe IS NULL THEN 'season_boundary_before_maturity' WHEN NOT grave THEN 'watch_only'
    WHEN usable_days < {LEAST} OR (end_date IS NULL AND ripe IS NULL) THEN 'insufficient_evidence' ELSE 'eligible' END AS outcome
  FROM kn JOIN wh USING (event_id) LEFT JOIN runs USING (event_id) LEFT JOIN (SELECT event_id, count(*) AS after FROM al WHERE day > anchor_date GROUP BY 1) USING (event_id))"""
INCIDENTS = monitoring.WEEKS + """,
cx AS (SELECT *, CASE substr(field_id, 7)::BIGINT % 3 WHEN 0 THEN 'Maize' WHEN 1 THEN 'Beans' ELSE 'Rice' END AS crop_name FROM context),
wk AS (SELECT timeline_bucket, crop_name, count(DISTINCT field_id) AS monitored, count(DISTINCT CASE WHEN evaluable THEN field_id END) AS evaluable FROM cx GROUP BY 1, 2),
ow AS (SELECT l.timeline_bucket, c.crop_name, c.crop_name || '/' || hazard_family AS incident_id, l.field_id, event_state, stage_bucket FROM lanes l JOIN cx c USING (timeline_bucket, crop_instance_id) WHERE canonical),
iw AS (SELECT incident_id, timeline_bucket, count(DISTINCT field_id) AS affected, count(DISTINCT CASE WHEN event_state = 'ACTIVE' THEN field_id END) AS active, count(DISTINCT CASE WHEN event_state = 'SEVERE' THEN field_id END) AS severe, any_value(monitored) AS monitored, any_value(evaluable) AS evaluable
  FROM ow JOIN wk USING (timeline_bucket, crop_name) GROUP BY 1, 2),
ir AS (SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY timeline_bucket) AS nth, affected / monitored AS rate FROM iw)"""


def _features(horizons: str) -> str:
    return f"""WITH {INCIDENTS}, hz AS ({horizons}),
      r AS (SELECT ir.*, horizon FROM ir JOIN hz USING (incident_id) WHERE nth <= horizon),
      b AS (SELECT incident_id, horizon, min(timeline_bucket) AS first_week, max(timeline_bucket) AS through_week, avg((active + severe > 0)::INT) AS pressure_fraction, max(rate) AS peak_rate, sum(rate) AS cumulative_rate, arg_min(nth, (-rate, nth)) AS pk,
        sum(severe) / greatest(sum(affected), 1) AS severe_fraction, sum(greatest(monitored - evaluable, 0)) / greatest(sum(monitored), 1) AS gap_fraction FROM r GROUP BY 1, 2),
      o AS (SELECT r.horizon, r.nth, ow.* FROM ow JOIN r USING (incident_id, timeline_bucket)),
      e AS (SELECT incident_id, horizon, -sum(p * ln(p)) / ln(7) AS stage_entropy FROM (SELECT incident_id, horizon, stage_bucket, count(*) / sum(count(*)) OVER (PARTITION BY incident_id, horizon) AS p FROM o GROUP BY 1, 2, 3) GROUP BY 1, 2),
      m AS (SELECT DISTINCT incident_id, horizon, nth, field_id FROM o), z AS (SELECT incident_id, horizon, nth + 1 AS nth, count(*) AS was FROM m WHERE nth + 1 <= horizon GROUP BY 1, 2, 3),
      s AS (SELECT a.incident_id, a.horizon, b.nth, count(*) AS stayed FROM m a JOIN m b ON a.incident_id = b.incident_id AND a.horizon = b.horizon AND b.nth = a.nth + 1 AND a.field_id = b.field_id GROUP BY 1, 2, 3),
      k AS (SELECT z.incident_id, z.horizon, avg(coalesce(stayed, 0) / was) AS retention FROM z LEFT JOIN s USING (incident_id, horizon, nth) GROUP BY 1, 2)
      SELECT incident_id, horizon, first_week, through_week, round(pressure_fraction, 6) AS pressure_fraction, round(peak_rate, 6) AS peak_rate, round(cumulative_rate, 6) AS cumulative_rate, round(severe_fraction, 6) AS severe_fraction, round(gap_fraction, 6) AS gap_fraction,
        round(coalesce(stage_entropy, 0), 6) + 0.0 AS stage_entropy, round(coalesce(retention, 0), 6) AS retention, (retention IS NULL)::INT AS retention_missing, round((pk - 1) / greatest(horizon - 1, 1), 6) AS peak_position
      FROM b LEFT JOIN e USING (incident_id, horizon) LEFT JOIN k USING (incident_id, horizon)"""


_GROUP = {name: sum(g == group for _, g in KINDS.values()) ** 0.5 for name, (_, group) in KINDS.items()}
_WEIGHTED = ", ".join(
    (f"round(CASE WHEN {n}_m IS NULL THEN 0.0 ELSE greatest(-5, least(5, ({n} - {n}_m) / CASE WHEN {n}_s < 1e-9 THEN 1 ELSE {n}_s END)) END / {_GROUP[n]!r}::DOUBLE, 6) AS {n}" if kind == "continuous"
     else f"round(CASE WHEN ndvi_m IS NULL THEN 0.0 ELSE greatest(0, least(1, {n})) END / {_GROUP[n]!r}::DOUBLE, 6) AS {n}") for n, (kind, _) in KINDS.items())
_MEDIANS = ", ".join(f"quantile_cont({n}, 0.5) AS {n}_m, quantile_cont({n}, 0.75) - quantile_cont({n}, 0.25) AS {n}_s" for n, (kind, _) in KINDS.items() if kind == "continuous")
CLAIMS = SIG + """,
cl AS (SELECT field_id AS key, hazard_family || '/' || crop_season AS owner_id, observation_date AS claimed, observation_date + (n % 3)::INT AS known FROM sg WHERE pressure_observed AND risk_rank >= 2),
fc AS (SELECT key, claimed, min((owner_id, known)) AS c FROM cl GROUP BY 1, 2), tn AS (SELECT key, claimed, c[1] AS owner_id, c[2] AS known, lag(c[1]) OVER (PARTITION BY key ORDER BY claimed) AS was FROM fc),
sp AS (SELECT key, owner_id, claimed AS from_date, lead(claimed) OVER (PARTITION BY key ORDER BY claimed) AS until_date, greatest(claimed, known) AS known_from FROM tn WHERE owner_id IS DISTINCT FROM was)"""
SNAPS = SIG + """,
un AS (SELECT field_id, observation_date AS day, 1 AS w, (risk_rank >= 3)::INT AS hot, risk_rank AS rank, 0 AS s, 0 AS fell FROM sg WHERE pressure_observed UNION ALL
  SELECT field_id, observation_date, 0, 0, 0, 1, (rc IN ('medium_decline', 'severe_decline'))::INT FROM sg WHERE is_new_acquisition),
dy AS (SELECT field_id, day, sum(w) AS w, sum(hot) AS hot, sum(s) AS s, sum(fell) AS fell, max(rank) AS rank FROM un GROUP BY 1, 2),
sn AS (SELECT field_id, day AS as_of, (sum(w) OVER o)::BIGINT AS weather_days, (sum(hot) OVER o)::BIGINT AS hot_days, max(rank) OVER o AS peak_rank, (sum(s) OVER o)::BIGINT AS looks, (sum(fell) OVER o)::BIGINT AS declines FROM dy WINDOW o AS (PARTITION BY field_id ORDER BY day)),
sb AS (SELECT *, CASE WHEN weather_days >= 49 THEN 49 WHEN weather_days >= 21 THEN 21 WHEN weather_days >= 7 THEN 7 ELSE 0 END AS weather_horizon, CASE WHEN looks >= 6 THEN 6 WHEN looks >= 3 THEN 3 WHEN looks >= 1 THEN 1 ELSE 0 END AS s2_horizon FROM sn)"""


def _if(expression: str, name: str, places: int | None = 6) -> str:
    value = f"round({expression}, {places}) + 0.0" if places is not None else expression
    return f"CASE WHEN outcome = 'eligible' THEN {value} END AS {name}"


_PICKED = f"""picked AS (
  SELECT field_id, observation_date, hazard_family, proto, radius, distance FROM (
    SELECT field_id, observation_date, h.hazard_family, proto, radius, sqrt((ndvi - p1) * (ndvi - p1) + (ndmi - p2) * (ndmi - p2) + (psri - p3) * (psri - p3)) AS distance FROM hz h JOIN model USING (hazard_family))
  QUALIFY row_number() OVER (PARTITION BY field_id, observation_date, hazard_family ORDER BY distance, proto) = 1)"""
ORACLES = {
    "event_anchors": f"""WITH {ANCHORS} SELECT event_id, anchor_date, CASE WHEN ripe IS NOT NULL THEN 'mature' WHEN end_date IS NOT NULL THEN 'early_closure' END AS anchor_kind, outcome, usable_days, missing_days, rows_after_anchor, evidence_to,
      {_if('peak_rank', 'peak_rank', None)}, {_if('mean_rank', 'mean_rank')}, {_if('coalesce(CASE WHEN isfinite(slope) THEN slope END, 0.0)', 'rank_slope')}, {_if('hot / usable_days', 'elevated_fraction')}, {_if('longest / usable_days', 'longest_fraction')}, {_if('(declines > 0)::INT', 'decline_any', None)},
      {_if('least(1.0, declines / usable_days)', 'decline_fraction')}, {_if('CASE WHEN ff IS NULL OR anchor_date - start_date <= 0 THEN 0.0 ELSE least(1.0, greatest(0.0, (ff - start_date) / (anchor_date - start_date))) END', 'decline_position')},
      {_if('(recoveries > 0)::INT', 'recovery_after_decline', None)}, {_if('worst', 'worst_ndvi')}, {_if('(worst IS NULL)::INT', 'worst_ndvi_missing', None)}, {_if('intensity', 'intensity')}, {_if(f'usable_days / {MATURE}', 'usable_fraction')} FROM an""",
    "anchor_leaks": "SELECT 0::BIGINT AS leaks",
    "incident_features": _features("SELECT incident_id, max(nth)::INT AS horizon FROM ir GROUP BY 1"),
    "incident_prefixes": _features("SELECT incident_id, h::INT AS horizon FROM (SELECT incident_id, max(nth) AS w FROM ir GROUP BY 1), (SELECT unnest([1, 2, 4, 8]) AS h) WHERE w >= h"),
    "archetype_features": f"""WITH {SIG}, q AS (SELECT *, pressure_observed::INT AS observed FROM sg), sc AS (SELECT hazard_family, {_MEDIANS} FROM q WHERE hazard_family <> 'none' GROUP BY 1)
      SELECT field_id, observation_date, hazard_family, {_WEIGHTED} FROM q LEFT JOIN sc USING (hazard_family)""",
    "purged_split": f"""WITH {SIG}, s AS (SELECT *, crop_name || '/' || n AS purge_group, CASE WHEN week(observation_date) <= 2 THEN 1 WHEN week(observation_date) = 3 THEN 2 ELSE 3 END AS place FROM sg)
      SELECT crop_instance_id, observation_date, purge_group, ['train', 'calibration', 'test'][place] AS own_split, CASE WHEN place = min(place) OVER (PARTITION BY purge_group) THEN ['train', 'calibration', 'test'][place] ELSE 'embargo' END AS purged_split FROM s""",
    "ownership_spans": f"WITH {CLAIMS} SELECT * FROM sp",
    "owned_evidence": f"""WITH {CLAIMS}, ac AS (SELECT field_id AS key, spectral_source_date AS day, rc AS response_class FROM sg WHERE is_new_acquisition),
      hd AS (SELECT ac.*, sp.owner_id AS held FROM ac ASOF LEFT JOIN sp ON ac.key = sp.key AND ac.day >= sp.from_date), cm AS (SELECT key, date_trunc('week', from_date)::DATE AS week, arg_min(owner_id, from_date) AS coming FROM sp GROUP BY 1, 2)
      SELECT hd.key, day, response_class, coalesce(held, coming) AS owner_id, CASE WHEN held IS NOT NULL THEN 'as_of' WHEN coming IS NOT NULL THEN 'same_week' ELSE 'none' END AS owned_by FROM hd LEFT JOIN cm ON cm.key = hd.key AND cm.week = date_trunc('week', hd.day)""",
    "learning_snapshots": f"WITH {SNAPS} SELECT * FROM sb",
    "landmark_rows": f"WITH {SNAPS} SELECT field_id, weather_horizon, s2_horizon, as_of, hot_days, declines FROM sb QUALIFY row_number() OVER (PARTITION BY field_id, weather_horizon, s2_horizon ORDER BY as_of DESC) = 1",
    "review_overlay": f"""WITH {SIG}, r AS (SELECT crop_instance_id, max(risk_band) AS label, min(n) AS n FROM sg GROUP BY 1)
      SELECT crop_instance_id, label, CASE WHEN n % 3 <> 0 THEN label WHEN n % 2 = 0 THEN NULL ELSE 'reviewed' END AS final_label, n % 3 = 0 AS was_reviewed FROM r""",
    "label_stability": f"""WITH {SIG}, k AS (SELECT field_id || '/' || observation_date AS key, hazard_family AS a, CASE WHEN risk_rank >= 3 THEN hazard_family ELSE 'none' END AS b FROM sg),
      j AS (SELECT a, b FROM k WHERE ('0x' || substr(md5('a' || key), 1, 8))::BIGINT % 100 < 80 AND ('0x' || substr(md5('b' || key), 1, 8))::BIGINT % 100 < 80),
      p AS (SELECT a, b, count(*) AS n FROM j GROUP BY 1, 2), x AS (SELECT a, count(*) AS na FROM j GROUP BY 1), y AS (SELECT b, count(*) AS nb FROM j GROUP BY 1)
      SELECT a, round(max(n / (na + nb - n)), 9) AS best_jaccard, any_value(na) AS n FROM p JOIN x USING (a) JOIN y USING (b) GROUP BY 1""",
    "archetype_assignment": f"WITH {monitoring._MODEL}, {_PICKED} SELECT field_id, observation_date, hazard_family, proto AS label, round(distance, 6) AS distance, distance <= radius + 1e-9 AS inside FROM picked",
    "motif_rows": f"WITH {INCIDENTS} SELECT incident_id, stage_bucket, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY incident_id), 9) AS share FROM ow GROUP BY 1, 2",
}

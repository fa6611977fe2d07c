"""Learning from incidents: features at anchors and horizons, ownership, calibrated open-set models, evaluation.

Everything is aggregates, windows and equality joins over incident weeks and their members; models are
small tables (a row a stratum and label) that are joined to the rows they judge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echoloom.operators.prototypes import density_clusters, distance
from echoloom.operators.temporal import asof_join, latest

DECLINES = ("medium_decline", "severe_decline")
#: Age and evidence steps at which a prefix is looked at.
HORIZONS = (1, 2, 4, 8)
WEATHER_BINS, S2_BINS = (7, 21, 49), (1, 3, 6)
#: The usable days that make an event mature.
MATURE_DAYS = 21


def anchors(days: DataFrame, events: DataFrame, mature: int = MATURE_DAYS, least: int = 7) -> DataFrame:
    """Each event's anchor (its `mature`-th usable day, or its early closing), outcome, and features up to there.

    `days` has event_id, observation_date, state, risk_rank, usable, response_class, ndvi_delta and
    intensity; `events` has event_id, start_date, end_date (null while open) and boundary.  Nothing after
    the anchor is read; later rows are only counted.
    """
    order = Window.partitionBy("event_id").orderBy("observation_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = days.withColumn("nth", F.sum(F.col("usable").cast("int")).over(order))
    ripe = rows.where(F.col("usable") & (F.col("nth") == mature)).groupBy("event_id").agg(F.min("observation_date").alias("ripe_date"))
    known = events.join(ripe, "event_id", "left").withColumn("anchor_date", F.coalesce("ripe_date", "end_date"))
    inside = rows.join(known.select("event_id", "anchor_date", "start_date"), "event_id")
    after = inside.where(F.col("observation_date") > F.col("anchor_date")).groupBy("event_id").agg(F.count("*").alias("rows_after_anchor"))
    inside = inside.where(F.col("anchor_date").isNull() | (F.col("observation_date") <= F.col("anchor_date")))
    usable, fell = F.col("usable"), F.col("response_class").isin(*DECLINES)
    rank = F.when(usable, F.col("risk_rank"))
    run = Window.partitionBy("event_id").orderBy("observation_date")
    calm = F.sum(F.when(usable & (F.col("risk_rank") < 3), 1).otherwise(0)).over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first_fall = F.min(F.when(fell, F.col("observation_date"))).over(Window.partitionBy("event_id"))
    inside = inside.withColumns({"island": calm, "first_fall": first_fall})
    runs = inside.where(usable & (F.col("risk_rank") >= 3)).groupBy("event_id", "island").agg(F.count("*").alias("run")).groupBy("event_id").agg(F.max("run").alias("longest"))
    whole = inside.groupBy("event_id").agg(
        F.count_if(usable).alias("usable_days"), F.count_if(~usable).alias("missing_days"), F.bool_or(F.col("state").isin("ACTIVE", "SEVERE")).alias("grave"), F.max(rank).alias("peak_rank"), F.avg(rank).alias("mean_rank"),
        F.regr_slope(rank.cast("double"), F.date_diff("observation_date", "start_date").cast("double")).alias("rank_slope"), F.count_if(usable & (F.col("risk_rank") >= 3)).alias("elevated_days"),
        F.count_if(fell).alias("declines"), F.count_if((F.col("response_class") == "recovery") & (F.col("observation_date") > F.col("first_fall"))).alias("recoveries"), F.min("first_fall").alias("first_fall"),
        F.min(F.when(F.col("response_class").isin(*DECLINES, "recovery"), F.col("ndvi_delta"))).alias("worst_ndvi"), F.max("intensity").alias("intensity"), F.max("observation_date").alias("evidence_to"),
    )
    out = known.join(whole, "event_id", "left").join(runs, "event_id", "left").join(after, "event_id", "left").fillna(0, ["usable_days", "missing_days", "longest", "rows_after_anchor"])
    closed = F.col("end_date").isNotNull()
    outcome = (
        F.when(closed & F.col("boundary") & F.col("ripe_date").isNull(), "season_boundary_before_maturity").when(~F.coalesce("grave", F.lit(False)), "watch_only")
        .when((F.col("usable_days") < least) | (~closed & F.col("ripe_date").isNull()), "insufficient_evidence").otherwise("eligible")
    )
    span = F.date_diff("anchor_date", "start_date")
    place = F.when(F.col("first_fall").isNull() | (span <= 0), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.date_diff("first_fall", "start_date") / span)))
    features = {
        "peak_rank": F.col("peak_rank"), "mean_rank": F.col("mean_rank"), "rank_slope": F.coalesce("rank_slope", F.lit(0.0)), "elevated_fraction": F.col("elevated_days") / F.col("usable_days"), "longest_fraction": F.col("longest") / F.col("usable_days"),
        "decline_any": (F.col("declines") > 0).cast("int"), "decline_fraction": F.least(F.lit(1.0), F.col("declines") / F.col("usable_days")), "decline_position": place, "recovery_after_decline": (F.col("recoveries") > 0).cast("int"),
        "worst_ndvi": F.col("worst_ndvi"), "worst_ndvi_missing": F.col("worst_ndvi").isNull().cast("int"), "intensity": F.col("intensity"), "usable_fraction": F.col("usable_days") / mature,
    }
    out = out.withColumns({"outcome": outcome, "anchor_kind": F.when(F.col("ripe_date").isNotNull(), "mature").when(closed, "early_closure")})
    return out.select("event_id", "anchor_date", "anchor_kind", "outcome", "usable_days", "missing_days", "rows_after_anchor", "evidence_to", *[F.when(F.col("outcome") == "eligible", v).alias(n) for n, v in features.items()])


def incident_features(weekly: DataFrame, members: DataFrame, horizons: Sequence[int] | None = None) -> DataFrame:
    """One row of features an incident, or one for each horizon (its first so many weeks) that it has reached.

    `weekly` has incident_id, timeline_bucket, affected, monitored, evaluable, active, severe;
    `members` has incident_id, timeline_bucket, field_id, stage_bucket.  A horizon's row reads no later week.
    """
    order = Window.partitionBy("incident_id").orderBy("timeline_bucket")
    rows = weekly.withColumns({"nth": F.row_number().over(order), "rate": F.coalesce(F.try_divide("affected", "monitored"), F.lit(0.0))})
    size = rows.groupBy("incident_id").agg(F.max("nth").alias("weeks"))
    if horizons is None:
        size = size.withColumn("horizon", F.col("weeks"))
    else:
        size = size.withColumn("horizon", F.explode(F.array(*map(F.lit, horizons)))).where("weeks >= horizon")
    keys = ["incident_id", "horizon"]
    rows = rows.join(size.drop("weeks"), "incident_id").where("nth <= horizon")
    own = members.join(rows.select(*keys, "timeline_bucket", "nth"), ["incident_id", "timeline_bucket"])
    base = rows.groupBy(*keys).agg(
        F.min("timeline_bucket").alias("first_week"), F.max("timeline_bucket").alias("through_week"), F.avg(((F.col("active") + F.col("severe")) > 0).cast("int")).alias("pressure_fraction"),
        F.max("rate").alias("peak_rate"), F.sum("rate").alias("cumulative_rate"), F.min_by("nth", F.struct(-F.col("rate"), "nth")).alias("peak_nth"),
        (F.sum("severe") / F.greatest(F.sum("affected"), F.lit(1))).alias("severe_fraction"), (F.sum(F.greatest(F.col("monitored") - F.col("evaluable"), F.lit(0))) / F.greatest(F.sum("monitored"), F.lit(1))).alias("gap_fraction"),
    )
    stages = own.groupBy(*keys, "stage_bucket").agg(F.count("*").alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy(*keys))
    entropy = stages.withColumn("p", p).groupBy(*keys).agg((-F.sum(F.col("p") * F.log("p")) / math.log(7)).alias("stage_entropy"))
    now = own.select(*keys, "nth", "field_id").distinct()
    before = now.select(*keys, (F.col("nth") + 1).alias("nth"), "field_id")
    sizes = before.groupBy(*keys, "nth").agg(F.count("*").alias("was"))
    stayed = now.join(before, [*keys, "nth", "field_id"]).groupBy(*keys, "nth").agg(F.count("*").alias("stayed"))
    kept = sizes.where("nth <= horizon").join(stayed, [*keys, "nth"], "left").groupBy(*keys).agg(F.avg(F.coalesce("stayed", F.lit(0)) / F.col("was")).alias("retention"))
    out = base.join(entropy, keys, "left").join(kept, keys, "left")
    return out.withColumns({
        "peak_position": (F.col("peak_nth") - 1) / F.greatest(F.col("horizon") - 1, F.lit(1)), "stage_entropy": F.coalesce("stage_entropy", F.lit(0.0)), "retention_missing": F.col("retention").isNull().cast("int"), "retention": F.coalesce("retention", F.lit(0.0)),
    }).drop("peak_nth")


def weighted_schema(rows: DataFrame, kinds: Mapping[str, tuple[str, str]], by: Sequence[str]) -> DataFrame:
    """Median and scale of each feature within its stratum; `kinds` gives a feature's kind and its group.

    The scale of a continuous feature is its interquartile range (one, if that is near zero); others keep theirs.
    """
    aggs = []
    for name, (kind, _) in kinds.items():
        low, middle, high = (F.percentile(name, F.lit(q)) for q in (0.25, 0.5, 0.75))
        wide = F.coalesce(high - low, F.lit(1.0))
        aggs += [F.coalesce(middle, F.lit(0.0)).alias(f"{name}_center"), (F.when(wide < 1e-9, 1.0).otherwise(wide) if kind == "continuous" else F.lit(1.0)).alias(f"{name}_scale")]
    return rows.groupBy(*by).agg(*aggs)


def weighted_features(rows: DataFrame, schema: DataFrame, kinds: Mapping[str, tuple[str, str]], by: Sequence[str]) -> DataFrame:
    """Features ready for distances: continuous ones centred, scaled and clipped at 5, others clipped to 0..1.

    Each is divided by the root of its group's size, so that a group counts as one feature.  Rows of a
    stratum that the schema does not know are all zero.
    """
    sizes: dict[str, int] = {}
    for _, group in kinds.values():
        sizes[group] = sizes.get(group, 0) + 1
    cells = {}
    for name, (kind, group) in kinds.items():
        value = F.coalesce((F.col(name) - F.col(f"{name}_center")) / F.col(f"{name}_scale"), F.lit(0.0)) if kind == "continuous" else F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        low, high = (-5.0, 5.0) if kind == "continuous" else (0.0, 1.0)
        known = F.col(f"{name}_scale").isNotNull()
        cells[name] = F.when(known, F.greatest(F.lit(low), F.least(F.lit(high), value))).otherwise(0.0) / math.sqrt(sizes[group])
    return rows.join(schema, list(by), "left").withColumns(cells).drop(*[f"{n}{s}" for n in kinds for s in ("_center", "_scale")])


def purged_split(rows: DataFrame, group: str, split: str, order: Sequence[str]) -> DataFrame:
    """Of a purge group that several splits hold, the earliest split keeps its rows; the others are embargoed."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(split))
    first = F.min(F.when(place > 0, place)).over(Window.partitionBy(group))
    return rows.withColumn("purged_split", F.when(place == first, F.col(split)).otherwise("embargo"))


def eligibility(stories: DataFrame, through: str, weeks: int = 2) -> DataFrame:
    """Each incident's standing as a lesson: complete, live, too short, or closed for want of data; the first that holds."""
    terminal = F.col("state").startswith("CLOSED_") | (F.col("state") == "MERGED_INTO")
    reason = (
        F.when(F.col("confirmed_week").isNull(), "never_confirmed").when(F.col("state").isin("CLOSED_DATA_CENSORED", "CLOSED_SEASON_CENSORED"), "censored").when(F.col("state") == "MERGED_INTO", "merged")
        .when(~terminal, "live").when(F.col("last_week") > F.lit(through).cast("date"), "after_cutoff").when(F.col("weeks") < weeks, "too_short").otherwise("eligible")
    )
    return stories.withColumn("eligibility", reason).withColumn("is_eligible", F.col("eligibility") == "eligible")


def ownership(claims: DataFrame) -> DataFrame:
    """(key, owner_id, from_date, until_date, known_from): who owns a key from when on, until the next owner.

    `claims` has key, owner_id, claimed (a date) and known (a date).  Spans are half open; a claim by the
    present owner changes nothing; of claims on one day the least owner wins.
    """
    first = claims.groupBy("key", "claimed").agg(F.min(F.struct("owner_id", "known")).alias("c")).select("key", "claimed", "c.*")
    order = Window.partitionBy("key").orderBy("claimed")
    turns = first.withColumn("was", F.lag("owner_id").over(order)).where(~F.col("was").eqNullSafe(F.col("owner_id")))
    return turns.select("key", "owner_id", F.col("claimed").alias("from_date"), F.lead("claimed").over(order).alias("until_date"), F.greatest("claimed", "known").alias("known_from"))


def owned_evidence(evidence: DataFrame, spans: DataFrame) -> DataFrame:
    """Evidence rows (key, day, known) with their owner: as of their day, or, if there is none yet, the one who comes that week.

    A span's end stops it; what nobody owns stays without an owner.
    """
    spans = spans.select("key", "owner_id", "from_date", "until_date")
    held = asof_join(evidence, spans, ["key"], "day", "from_date", ["from_date", "owner_id", "until_date"])
    week = F.date_add(F.date_trunc("week", F.col("day")).cast("date"), 6)
    coming = spans.groupBy("key", F.date_add(F.date_trunc("week", F.col("from_date")).cast("date"), 6).alias("week_end")).agg(F.min_by("owner_id", "from_date").alias("coming_owner"))
    out = held.withColumn("week_end", week).join(coming, ["key", "week_end"], "left").drop("week_end")
    how = F.when(F.col("owner_id").isNotNull(), "as_of").when(F.col("coming_owner").isNotNull(), "same_week").otherwise("none")
    return out.withColumns({"owned_by": how, "owner_id": F.coalesce("owner_id", "coming_owner")}).drop("coming_owner", "from_date", "until_date")


def bin_of(value: Column, steps: Sequence[int]) -> Column:
    """The largest step that a value has reached, or nought."""
    out = F.lit(0)
    for step in steps:
        out = F.when(value >= step, step).otherwise(out)
    return out


def cumulative_snapshots(lanes: DataFrame, looks: DataFrame, key: str) -> DataFrame:
    """At each cutoff of either kind of evidence, both kinds' totals so far, and how mature they are.

    `lanes` has key, day, rank; `looks` has key, day, declined.  Cutoffs are the union of both kinds' days;
    totals are running sums over one sorted union, so that no as-of pair is formed.
    """
    a = lanes.select(key, "day", F.lit(1).alias("w"), (F.col("rank") >= 3).cast("int").alias("hot"), F.col("rank").cast("int").alias("rank"), F.lit(0).alias("s"), F.lit(0).alias("fell"))
    b = looks.select(key, "day", F.lit(0).alias("w"), F.lit(0).alias("hot"), F.lit(0).alias("rank"), F.lit(1).alias("s"), F.col("declined").cast("int").alias("fell"))
    daily = a.unionByName(b).groupBy(key, "day").agg(*[F.sum(c).alias(c) for c in ("w", "hot", "s", "fell")], F.max("rank").alias("rank"))
    so_far = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = daily.select(key, F.col("day").alias("as_of"), F.sum("w").over(so_far).alias("weather_days"), F.sum("hot").over(so_far).alias("hot_days"), F.max("rank").over(so_far).alias("peak_rank"), F.sum("s").over(so_far).alias("looks"), F.sum("fell").over(so_far).alias("declines"))
    return out.withColumns({"weather_horizon": bin_of(F.col("weather_days"), WEATHER_BINS), "s2_horizon": bin_of(F.col("looks"), S2_BINS)})


def landmarks(rows: DataFrame, key: str, maturity: Sequence[str], as_of: str) -> DataFrame:
    """One row a key and maturity, the latest, so that long stays do not weigh more."""
    return latest(rows, [key, *maturity], [F.desc(as_of)])


def overlay(assigned: DataFrame, reviews: DataFrame, key: str, label: str) -> DataFrame:
    """Assignments with what reviewers said instead; a review of "novel" takes the label away."""
    said = reviews.select(key, F.col("reviewed_label"), F.lit(True).alias("_said"))
    out = assigned.join(said, key, "left")
    final = F.when(F.col("_said"), F.when(F.col("reviewed_label") != "novel", F.col("reviewed_label"))).otherwise(F.col(label))
    return out.withColumns({"final_label": final, "was_reviewed": F.coalesce("_said", F.lit(False))}).drop("_said")


def calibrated_model(rows: DataFrame, features: Sequence[str], by: Sequence[str], label: str, split: str, quantile: float = 0.95, false_accepts: float = 0.05, least: int = 2) -> DataFrame:
    """Centres from train medians, radii and margins from the calibration split: a row a stratum and label.

    A radius holds `quantile` of the label's own calibration rows, but no more than the budget of novel
    ones (label null): it stays under the (floor(budget * n) + 1)-th nearest.  A label whose radius that
    leaves at nought is dropped.  The margin is the 5 % quantile of how much farther, in radii, the
    nearest other centre is.
    """
    train = rows.where((F.col(split) == "train") & F.col(label).isNotNull())
    centres = train.groupBy(*by, label).agg(*[F.percentile(c, F.lit(0.5)).alias(f"{c}_proto") for c in features], F.count("*").alias("training_support")).where(F.col("training_support") >= least)
    held = rows.where(F.col(split) == "calibration").withColumn("_row", F.monotonically_increasing_id())
    near = held.withColumnRenamed(label, "_truth").join(centres, list(by)).withColumn("_d", distance(features, "_proto"))
    own = near.where(F.col("_truth") == F.col(label)).groupBy(*by, label).agg(F.percentile("_d", F.lit(quantile)).alias("positive_radius"), F.count("*").alias("calibration_support"))
    strange = near.where(F.col("_truth").isNull())
    order = Window.partitionBy(*by, label).orderBy("_d", "_row")
    strange = strange.withColumns({"_n": F.row_number().over(order), "_m": F.count("*").over(Window.partitionBy(*by, label))})
    cap = strange.where(F.col("_n") == F.floor(F.col("_m") * false_accepts) + 1).select(*by, label, F.col("_d").alias("novel_cap"), F.col("_m").alias("novel_support"))
    model = centres.join(own, [*by, label]).where(F.col("calibration_support") >= least).join(cap, [*by, label], "left")
    # Just under the nearest novel row that the budget does not allow.
    model = model.withColumn("radius", F.least("positive_radius", F.coalesce(F.col("novel_cap") * (1 - 1e-12), F.lit(float("inf"))))).where("radius > 1e-9")
    ratios = near.join(model.select(*by, label, "radius"), [*by, label]).withColumn("_ratio", F.col("_d") / F.col("radius"))
    mine = ratios.where(F.col("_truth") == F.col(label)).select("_row", F.col("_ratio").alias("_mine"))
    others = ratios.where(F.col("_truth") != F.col(label)).groupBy("_row").agg(F.min("_ratio").alias("_other"), F.first("_truth").alias(label), *[F.first(c).alias(c) for c in by])
    margin = others.join(mine, "_row").groupBy(*by, label).agg(F.percentile(F.col("_other") - F.col("_mine"), F.lit(0.05)).alias("margin"))
    return model.join(margin, [*by, label], "left").withColumn("margin", F.greatest(F.coalesce("margin", F.lit(0.0)), F.lit(0.0)))


def open_set(rows: DataFrame, model: DataFrame, features: Sequence[str], by: Sequence[str], label: str, key: Sequence[str], ready: Column | None = None) -> DataFrame:
    """Each row's nearest centre in radii: tentative if it is inside and clear of the next, novel if not, pending without a model.

    `ready` says which rows have evidence enough; others are pending as well.
    """
    near = rows.join(model, list(by), "left").withColumn("ratio", distance(features, "_proto") / F.col("radius"))
    order = Window.partitionBy(*key).orderBy(F.asc_nulls_last("ratio"), label)
    near = near.withColumns({"_n": F.row_number().over(order), "next_ratio": F.lead("ratio").over(order)}).where("_n = 1")
    clear = F.coalesce(F.col("next_ratio") - F.col("ratio") >= F.col("margin"), F.lit(True))
    lacking = F.col("radius").isNull() if ready is None else F.col("radius").isNull() | ~ready
    status = F.when(lacking, "pending").when((F.col("ratio") <= 1) & clear, "tentative").otherwise("novel")
    return near.withColumn("status", status).select(*key, *by, "ratio", "status", F.when(F.col("status") == "tentative", F.col(label)).alias("assigned"))


def latest_horizon(assigned: DataFrame, key: str, horizon: str) -> DataFrame:
    """Of an incident's assignments the one of the longest horizon that is not pending, or else the longest."""
    return latest(assigned, [key], [F.asc((F.col("status") == "pending").cast("int")), F.desc(horizon)])


def evaluation(judged: DataFrame, truth: str, by: Sequence[str] = ()) -> DataFrame:
    """Acceptance, precision of the accepted, false acceptance of novel rows; a row for each group."""
    accepted, known = F.col("assigned").isNotNull(), F.col(truth).isNotNull()
    return judged.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(accepted.cast("int")).alias("acceptance"), F.avg(F.when(accepted & known, (F.col("assigned") == F.col(truth)).cast("int"))).alias("precision"),
        F.avg(F.when(~known, accepted.cast("int"))).alias("false_acceptance"), F.avg((F.col("status") == "pending").cast("int")).alias("pending"),
    )


def gates(measured: DataFrame, limits: Mapping[str, tuple[str, float]]) -> DataFrame:
    """(gate, value, passed): measured columns against limits such as ("<=", 0.05); a missing value does not pass."""
    cells = [F.struct(F.lit(name).alias("gate"), F.col(name).cast("double").alias("value"), F.coalesce(F.expr(f"`{name}` {op} {limit!r}"), F.lit(False)).alias("passed")) for name, (op, limit) in limits.items()]
    keys = [c for c in measured.columns if c not in limits]
    return measured.select(*keys, F.explode(F.array(*cells)).alias("g")).select(*keys, "g.*")


def best_jaccard(left: DataFrame, right: DataFrame, key: str, label: str) -> DataFrame:
    """For each label of one labelling its best Jaccard with any label of another, over the keys that both have."""
    both = left.select(key, F.col(label).alias("a")).join(right.select(key, F.col(label).alias("b")), key)
    sizes = {c: both.groupBy(c).agg(F.count("*").alias(f"n_{c}")) for c in "ab"}
    pairs = both.groupBy("a", "b").agg(F.count("*").alias("n")).join(sizes["a"], "a").join(sizes["b"], "b")
    return pairs.groupBy("a").agg(F.max(F.col("n") / (F.col("n_a") + F.col("n_b") - F.col("n"))).alias("best_jaccard"), F.first("n_a").alias("n"))


def hashed_share(rows: DataFrame, key: str, salt: str, percent: int) -> DataFrame:
    """The same `percent` of the keys for a salt, everywhere and always: a subsample for stability runs."""
    number = F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")
    return rows.where(F.pmod(number, F.lit(100)) < percent)


def matrix_assign(rows: DataFrame, model: DataFrame, features: Sequence[str], by: str, label: str, key: Sequence[str]) -> DataFrame:
    """The nearest centre of each row's stratum by one matrix product a batch; a batch streams through, nothing is grouped.

    The model (a row a stratum and label) comes to the driver and goes to every task; it must be frozen
    and small, as models are.
    """
    held: dict = {}
    for r in model.collect():  # a row a stratum and label
        held.setdefault(r[by], []).append((r[label], [r[f"{c}_proto"] for c in features], r["radius"]))
    frozen = {s: ([x[0] for x in sorted(v)], np.array([x[1] for x in sorted(v)]), np.array([x[2] for x in sorted(v)])) for s, v in held.items()}
    kind = rows.select(*key, by).schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", label string, distance double, radius double"
    names = [*key, by, "label", "distance", "radius"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in features], axis=1) if batch.num_rows else np.zeros((0, len(features)))
            strata = np.array(batch.column(by).to_pylist(), dtype=object)
            found: list = [(None, None, None)] * batch.num_rows
            for stratum, (labels, centres, radius) in frozen.items():
                at = np.flatnonzero(strata == stratum)
                square = (x[at] ** 2).sum(axis=1)[:, None] - 2 * x[at] @ centres.T + (centres**2).sum(axis=1)[None]
                # The product says which centres can be nearest; those are measured plainly, ties to the first label.
                close = square <= square.min(axis=1)[:, None] + 1e-9 * (1 + (x[at] ** 2).sum(axis=1)[:, None])
                for i, near in zip(at.tolist(), close):
                    far = [(math.sqrt(sum(d * d for d in (x[i] - centres[j]).tolist())), j) for j in np.flatnonzero(near).tolist()]
                    d, j = min(far)
                    found[i] = labels[j], d, float(radius[j])
            columns = [batch.column(c) for c in (*key, by)] + [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select(*key, by, *features).mapInArrow(run, kind)


def discover(rows: DataFrame, features: Sequence[str], by: str, key: str, share: float = 0.005, least: int = 100, samples: int = 20, most: int = 2000) -> DataFrame:
    """(key, by, cluster): density clusters within each stratum; -1 is noise.

    The least cluster grows with the stratum (`share` of it, `least` at the least).  Of a stratum of more
    than `most` rows the `most` of least key hash are clustered, which bounds the group; the others are
    for `matrix_assign` to label by the clusters' centres.
    """
    order = Window.partitionBy(by).orderBy(F.md5(F.col(key).cast("string")))
    some = rows.withColumns({"_n": F.row_number().over(order), "_size": F.count("*").over(Window.partitionBy(by))}).where(F.col("_n") <= most)
    kind = rows.select(key, by).schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", cluster int"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(key)
        x = np.stack([table.column(c).to_numpy().astype(float) for c in features], axis=1)
        size = min(table.num_rows, most)
        labels = density_clusters(x, max(least, math.ceil(share * size)), samples) if table.num_rows > least else np.full(table.num_rows, -1)
        return pa.table({key: table.column(key), by: table.column(by), "cluster": pa.array(labels.astype(np.int32))})

    return some.select(key, by, *features).groupBy(by).applyInArrow(run, kind)


def cluster_model(rows: DataFrame, clusters: DataFrame, features: Sequence[str], by: str, key: str, quantile: float = 0.95) -> DataFrame:
    """A prototype for each cluster: its member nearest to the medians, and the radius that holds most members."""
    own = rows.join(clusters.where("cluster >= 0").select(key, "cluster"), key)
    centre = own.groupBy(by, "cluster").agg(*[F.percentile(c, F.lit(0.5)).alias(f"{c}_proto") for c in features])
    medoid = latest(own.join(centre, [by, "cluster"]).withColumn("_d", distance(features, "_proto")), [by, "cluster"], [F.asc("_d"), F.asc(key)])
    named = medoid.select(by, "cluster", F.concat(F.lit("motif_"), F.substring(F.sha2(F.concat_ws("\x1f", F.col(by).cast("string"), F.col(key).cast("string")), 256), 1, 24)).alias("motif_id"), *[F.col(c).alias(f"{c}_proto") for c in features])
    far = own.join(named, [by, "cluster"]).withColumn("_d", distance(features, "_proto")).groupBy(by, "cluster").agg(F.percentile("_d", F.lit(quantile)).alias("radius"), F.count("*").alias("support"))
    return named.join(far, [by, "cluster"])

"""Weekly components of significant cells, their links over weeks, and what depends on them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echoloom.durable import stored
from echoloom.functions import normalize as nz
from echoloom.functions.statistics import best_assignment
from echoloom.operators.automata import names_of, run_machines

CORE_STATES = ("ACTIVE", "SEVERE")
ROLES = ("pressure_core", "impact_lag", "watch_frontier")


def weekly_components(cells: DataFrame) -> DataFrame:
    """8-neighbour components of each week's and hazard's significant cells.

    A week's cells of one hazard are few (the grid bounds them), so a group is labelled in one pass.
    """

    def label(group: pd.DataFrame) -> pd.DataFrame:
        places = {(int(x), int(y)) for x, y in zip(group.cell_x, group.cell_y)}
        names: dict[tuple[int, int], str] = {}
        for start in sorted(places):
            if start in names:
                continue
            name, todo = f"g:{start[0]}:{start[1]}", [start]
            names[start] = name
            while todo:
                x, y = todo.pop()
                for other in ((x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
                    if other in places and other not in names:
                        names[other] = name
                        todo.append(other)
        return group.assign(component=[names[int(x), int(y)] for x, y in zip(group.cell_x, group.cell_y)])

    rows = cells.select("timeline_bucket", "hazard_family", "cell_x", "cell_y")
    return rows.groupBy("timeline_bucket", "hazard_family").applyInPandas(label, rows.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", component string")


def component_summary(labelled: DataFrame, size_km: float = 5.0) -> DataFrame:
    """One row a component: its cells, centre, and an identity made of them."""
    cell = F.concat_ws(":", F.lit("g"), F.col("cell_x").cast("string"), F.col("cell_y").cast("string"))
    grouped = labelled.groupBy("timeline_bucket", "hazard_family", "component").agg(
        F.sort_array(F.collect_set(cell)).alias("cells"), ((F.avg("cell_x") + 0.5) * size_km).alias("center_x_km"), ((F.avg("cell_y") + 0.5) * size_km).alias("center_y_km")
    )
    identity = nz.stable_id("component", F.col("hazard_family"), F.col("timeline_bucket"), F.concat_ws(",", "cells"))
    return grouped.withColumn("component_id", identity).withColumn("cell_count", F.size("cells")).drop("component")


def component_members(components: DataFrame, rows: DataFrame, reach: int = 1) -> DataFrame:
    """(component_id, timeline_bucket, hazard_family, field_id, ..., membership_role): the fields of each component.

    `rows` has timeline_bucket, hazard_family, cell_x, cell_y, field_id, event_state, fresh and more.
    Active and severe fields belong to a component only inside its cells; others as far as `reach`
    cells away, where a fresh decline makes them its impact and anything else its frontier.  A field in
    reach of several goes to the nearest, then to one that holds active cells of it, then by id.
    """
    cells = components.select("timeline_bucket", "hazard_family", "component_id", F.explode("cells").alias("cell"))
    cells = cells.withColumns({"cell_x": F.split("cell", ":")[1].cast("long"), "cell_y": F.split("cell", ":")[2].cast("long")})
    around = F.array(*[F.lit(k) for k in range(-reach, reach + 1)])
    near = cells.withColumn("i", F.explode(around)).withColumn("j", F.explode(around))
    near = near.select("timeline_bucket", "hazard_family", "component_id", (F.col("cell_x") + F.col("i")).alias("cell_x"), (F.col("cell_y") + F.col("j")).alias("cell_y"), F.greatest(F.abs("i"), F.abs("j")).alias("away"))
    near = near.groupBy("timeline_bucket", "hazard_family", "component_id", "cell_x", "cell_y").agg(F.min("away").alias("away"))
    joined = rows.join(near, ["timeline_bucket", "hazard_family", "cell_x", "cell_y"])
    core = F.col("event_state").isin(*CORE_STATES)
    joined = joined.where(~core | (F.col("away") == 0))
    role = F.when(core, ROLES[0]).when(F.col("fresh"), ROLES[1]).otherwise(ROLES[2])
    order = Window.partitionBy("timeline_bucket", "hazard_family", "field_id").orderBy("away", F.desc(core.cast("int")), "component_id")
    return joined.withColumns({"membership_role": role, "n": F.row_number().over(order)}).where("n = 1").drop("n")


def without_core(components: DataFrame, members: DataFrame) -> DataFrame:
    """Components that hold no core field: there should be none."""
    return components.join(members.where(F.col("membership_role") == ROLES[0]).select("component_id").distinct(), "component_id", "left_anti")


def member_sets(components: DataFrame, members: DataFrame) -> DataFrame:
    """Components with the sorted sets of their fields and episodes and the counts of their stages."""
    sets = members.groupBy("component_id").agg(F.sort_array(F.collect_set("field_id")).alias("fields"), F.sort_array(F.collect_set("episode_id")).alias("episodes"))
    stages = members.groupBy("component_id", "stage_family").agg(F.count("*").alias("n")).groupBy("component_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("stage_family", "n")))).alias("stages"))
    nothing = F.array().cast("array<string>")
    out = components.join(sets, "component_id", "left").join(stages, "component_id", "left")
    return out.withColumns({"fields": F.coalesce("fields", nothing), "episodes": F.coalesce("episodes", nothing), "stages": F.coalesce("stages", F.create_map().cast("map<string,bigint>"))})


@dataclass(frozen=True)
class LinkPolicy:
    """Which components may be one exposure in another week, as the shipped policy has them."""

    max_gap_weeks: int = 2
    max_km: float = 15.0
    episode_weight: float = 0.35
    cell_weight: float = 0.25
    field_weight: float = 0.25
    distance_weight: float = 0.15
    gap_penalty: float = 0.1
    threshold: float = 0.35
    related_score: float = 0.30
    related_jaccard: float = 0.20


def _jaccard(a: str, b: str):
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def _cosine_of_counts(a: str, b: str):
    names = F.array_union(F.map_keys(a), F.map_keys(b))

    def total(f):
        return F.aggregate(names, F.lit(0.0), lambda s, k: s + f(k))

    def at(m, k):
        return F.coalesce(F.element_at(F.col(m), k), F.lit(0)).cast("double")

    size = F.sqrt(total(lambda k: at(a, k) * at(a, k))) * F.sqrt(total(lambda k: at(b, k) * at(b, k)))
    return F.coalesce(F.try_divide(total(lambda k: at(a, k) * at(b, k)), size), F.lit(0.0))


def score_links(components: DataFrame, policy: LinkPolicy = LinkPolicy()) -> DataFrame:
    """Candidate links over one to `max_gap_weeks` weeks, same hazard: episodes, cells, fields, centres.

    The week offset is an equality: an earlier component names the weeks in which it may go on.  The
    stages' cosine is shown but takes no part in the score.
    """
    shown = ["hazard_family", "component_id", "cells", "fields", "episodes", "stages", "center_x_km", "center_y_km"]
    earlier = components.select(*[F.col(c).alias(f"a_{c}") for c in shown], F.col("timeline_bucket").alias("a_week"))
    earlier = earlier.withColumn("gap_weeks", F.explode(F.sequence(F.lit(1), F.lit(policy.max_gap_weeks)))).withColumn("b_week", F.date_add("a_week", F.col("gap_weeks") * 7))
    later = components.select(*[F.col(c).alias(f"b_{c}") for c in shown], F.col("timeline_bucket").alias("b_week"))
    pairs = earlier.join(later, (earlier.a_hazard_family == later.b_hazard_family) & (earlier.b_week == later.b_week)).drop(later.b_week)
    distance = F.sqrt(F.pow(F.col("a_center_x_km") - F.col("b_center_x_km"), 2) + F.pow(F.col("a_center_y_km") - F.col("b_center_y_km"), 2))
    measures = {f"{k}_jaccard": _jaccard(f"a_{k}s", f"b_{k}s") for k in ("episode", "cell", "field")}
    pairs = pairs.withColumns({**measures, "distance_km": distance, "stage_cosine": _cosine_of_counts("a_stages", "b_stages")})
    touching = F.greatest(*[F.col(m) for m in measures]) > 0
    pairs = pairs.where(touching | (F.col("distance_km") <= policy.max_km))
    weights = {"episode_jaccard": policy.episode_weight, "cell_jaccard": policy.cell_weight, "field_jaccard": policy.field_weight}
    score = policy.distance_weight * F.exp(-F.col("distance_km") / policy.max_km)
    for name, weight in weights.items():
        score = score + weight * F.col(name)
    score = score / (sum(weights.values()) + policy.distance_weight) - policy.gap_penalty * (F.col("gap_weeks") - 1)
    return pairs.select(
        F.col("a_hazard_family").alias("hazard_family"), "a_week", "b_week", "gap_weeks", F.col("a_component_id").alias("previous_id"), F.col("b_component_id").alias("current_id"),
        "distance_km", *measures, "stage_cosine", score.alias("score"),
    )


TRACK = (
    "kind string, hazard_family string, timeline_bucket date, component_id string, exposure_id string, previous_id string, related_exposure_id string, relation string, score double"
)


def _exposure_of(component: str) -> str:
    return component.replace("component_", "exposure_", 1)


def _blocks_of(pairs: list[tuple]) -> list[list[tuple]]:
    """Pairs (previous, current, ...) that share an end, put together."""
    of: dict = {}
    for pair in pairs:
        joined = [pair]
        for end in (("a", pair[0]), ("b", pair[1])):
            if end in of and of[end] is not joined:
                joined = of[end] + [p for p in joined if p not in of[end]]
        for p in joined:
            of["a", p[0]] = of["b", p[1]] = joined
    return list({id(block): block for block in of.values()}.values())


def _assign(pairs: list[tuple]) -> dict[str, tuple[str, float]]:
    """The one-to-one links of the largest total: current to (previous, score), block by block."""
    out = {}
    for block in _blocks_of(pairs):
        rows, columns = ({x: n for n, x in enumerate(sorted({p[side] for p in block}))} for side in (0, 1))
        benefit = np.full((len(rows), len(columns)), -np.inf)
        for a, b, score, _ in block:
            benefit[rows[a], columns[b]] = score
        names, wide = list(rows), list(columns)
        for i, j in enumerate(best_assignment(benefit)):
            if j >= 0:
                out[wide[j]] = names[i], float(benefit[i, j])
    return out


def track_family(components: pd.DataFrame, pairs: pd.DataFrame, policy: LinkPolicy) -> pd.DataFrame:
    """One family of linked components, week by week: which exposure each goes on, and how exposures relate.

    An exposure is continued from its latest component only, so that it has one component a week; one
    that merges into another ends there.
    """
    latest: dict[str, str] = {}  # component that an exposure has come to -> exposure
    out: list[tuple] = []
    by_week = {week: list(zip(g.previous_id, g.current_id, g.score, g.overlap)) for week, g in pairs.groupby("b_week")} if len(pairs) else {}
    for week, own in components.sort_values(["timeline_bucket", "component_id"]).groupby("timeline_bucket", sort=True):
        open_ = [p for p in by_week.get(week, ()) if p[0] in latest]
        taken = _assign([p for p in open_ if p[2] >= policy.threshold])
        went_on = {before for before, _ in taken.values()}
        exposure = {}
        for component, hazard in zip(own.component_id, own.hazard_family):
            before, score = taken.get(component, (None, None))
            exposure[component] = latest[before] if before else _exposure_of(component)
            out.append(("assignment", hazard, week, component, exposure[component], before, None, "continued" if before else "new", score))
        merged = set()
        for before, component, score, overlap in sorted(open_):
            if score < policy.related_score or overlap < policy.related_jaccard or taken.get(component, (None,))[0] == before:
                continue
            relation = {(True, False): "split", (False, True): "merge"}.get((before in went_on, component in taken), "related_unmatched")
            merged |= {before} if relation == "merge" else set()
            out.append(("lineage", own.hazard_family.iloc[0], week, component, exposure[component], before, latest[before], relation, score))
        for before in went_on | merged:
            del latest[before]
        latest |= exposure and {c: e for c, e in exposure.items()}
    return pd.DataFrame(out, columns=names_of(TRACK))


def _families(components: DataFrame, scores: DataFrame) -> DataFrame:
    """(component_id, family): components that any chain of candidate links joins, by the least id.

    Each round every component takes the least name among its neighbours', and then its name's name,
    which halves what is left; names are stored each round, so that no plan grows.
    """
    links = scores.select(F.col("previous_id").alias("a"), F.col("current_id").alias("b"))
    links = stored(links.union(links.select("b", "a")).distinct())
    named = stored(components.select(F.col("component_id").alias("a"), F.col("component_id").alias("family")))
    while True:
        least = links.join(named.select(F.col("a").alias("b"), "family"), "b").groupBy("a").agg(F.min("family").alias("near"))
        step = named.join(least, "a", "left").select("a", F.least("family", F.coalesce("near", "family")).alias("family"), F.col("family").alias("before"))
        jump = step.select(F.col("a").alias("family"), F.col("family").alias("further"))
        new = stored(step.join(jump, "family").select("a", F.least("family", "further").alias("family"), "before"))
        if not new.where("family <> before").limit(1).count():
            return new.select(F.col("a").alias("component_id"), "family")
        named = new.drop("before")


def track(components: DataFrame, scores: DataFrame, policy: LinkPolicy = LinkPolicy()) -> DataFrame:
    """TRACK rows of all components: assignments to exposures, and lineage between exposures.

    Families of linked components do not touch each other and are tracked side by side.
    """
    families = _families(components, scores)
    own = components.select("component_id", "timeline_bucket", "hazard_family").join(families, "component_id")
    overlap = F.greatest("episode_jaccard", "cell_jaccard", "field_jaccard").alias("overlap")
    pairs = scores.select("b_week", "previous_id", "current_id", "score", overlap).join(families.select(F.col("component_id").alias("current_id"), F.col("family").alias("of")), "current_id")

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return track_family(a, b, policy)

    return own.groupBy("family").cogroup(pairs.groupBy("of")).applyInPandas(run, TRACK)


def assignments(tracked: DataFrame) -> DataFrame:
    return tracked.where("kind = 'assignment'").select("timeline_bucket", "hazard_family", "component_id", "exposure_id", F.col("relation").alias("assignment_kind"), "previous_id", F.col("score").alias("link_score"))


def lineage(tracked: DataFrame) -> DataFrame:
    """Edges from an exposure to another: splits, merges, and what was near but not matched."""
    return tracked.where("kind = 'lineage'").select("timeline_bucket", F.col("related_exposure_id").alias("parent_id"), F.col("exposure_id").alias("child_id"), "previous_id", F.col("component_id").alias("current_id"), "relation", "score")


def exposure_weeks(members: DataFrame, assigned: DataFrame) -> DataFrame:
    """Each exposure's core fields from week to week: persisting, entering, exiting, Jaccard."""
    core = members.where(F.col("membership_role") == ROLES[0]).join(assigned.select("component_id", "exposure_id"), "component_id")
    weekly = core.groupBy("exposure_id", "hazard_family", "timeline_bucket").agg(F.sort_array(F.collect_set("field_id")).alias("now"))
    order = Window.partitionBy("exposure_id").orderBy("timeline_bucket")
    weekly = weekly.withColumns({"before": F.coalesce(F.lag("now").over(order), F.array().cast("array<string>")), "prior_timeline_bucket": F.lag("timeline_bucket").over(order)})
    both = F.size(F.array_intersect("now", "before"))
    return weekly.select(
        "exposure_id", "hazard_family", "timeline_bucket", "prior_timeline_bucket", both.alias("persisting"), (F.size("now") - both).alias("entering"), (F.size("before") - both).alias("exiting"),
        F.size(F.array_union("now", "before")).alias("union_count"), (both / F.size(F.array_union("now", "before"))).alias("jaccard"),
        F.coalesce(F.date_diff("timeline_bucket", "prior_timeline_bucket") == 7, F.lit(False)).alias("is_consecutive_week"),
    )


def crop_incidents(members: DataFrame, assigned: DataFrame) -> DataFrame:
    """(incident_id, exposure_id, hazard_family, crop_name, weeks, fields): an exposure's core and impact by crop."""
    own = members.where(F.col("membership_role").isin(*ROLES[:2])).join(assigned.select("component_id", "exposure_id"), "component_id")
    out = own.groupBy("exposure_id", "hazard_family", "crop_name").agg(F.min("timeline_bucket").alias("first_week"), F.max("timeline_bucket").alias("last_week"), F.countDistinct("field_id").alias("field_count"))
    return out.withColumn("incident_id", nz.stable_id("incident", F.col("exposure_id"), F.col("crop_name")))


def incident_lineage(edges: DataFrame, incidents: DataFrame) -> DataFrame:
    """Edges of exposures as edges of incidents of the same crop; an edge with one end missing is dropped."""
    parent, child = (incidents.select(F.col("exposure_id").alias(f"{k}_id"), "crop_name", F.col("incident_id").alias(f"{k}_incident_id")) for k in ("parent", "child"))
    return edges.join(parent, "parent_id").join(child, ["child_id", "crop_name"]).where("parent_incident_id <> child_incident_id").select("timeline_bucket", "crop_name", "parent_incident_id", "child_incident_id", "relation", "score")


def remap_segments(edges: DataFrame, segments: DataFrame) -> DataFrame:
    """Edges between the segments of their ends that are active in the edge's week; others are dropped.

    `segments` has base_id, segment_id, first_week, last_week; a base's segments do not overlap.
    """
    def named(kind: str) -> DataFrame:
        return segments.select(F.col("base_id").alias(f"{kind}_incident_id"), F.col("segment_id").alias(f"{kind}_segment_id"), F.col("first_week").alias(f"{kind}_first"), F.col("last_week").alias(f"{kind}_last"))

    out = edges
    for kind in ("parent", "child"):
        out = out.join(named(kind), f"{kind}_incident_id").where((F.col("timeline_bucket") >= F.col(f"{kind}_first")) & (F.col("timeline_bucket") <= F.col(f"{kind}_last")))
    return out.select("timeline_bucket", "parent_segment_id", "child_segment_id", "relation")


def cyclic(edges: DataFrame, parent: str, child: str) -> DataFrame:
    """The nodes on or behind cycles: what is left when nodes without parents are taken away, again and again."""
    left = stored(edges.select(F.col(parent).alias("p"), F.col(child).alias("c")).distinct())
    count = left.count()
    while count:
        kept = stored(left.join(left.select(F.col("c").alias("p")).distinct(), "p", "left_semi"))
        now = kept.count()
        left = kept
        if now == count:
            break
        count = now
    return left.select(F.col("c").alias("node")).distinct()


def crosswalk(old: DataFrame, new: DataFrame) -> DataFrame:
    """Overlap of old and new incidents over distinct (week, field); what matches nothing gets a row."""
    keys = ["timeline_bucket", "field_id"]
    old = old.select(F.col("incident_id").alias("old_incident_id"), *keys).distinct()
    new = new.select(F.col("incident_id").alias("new_incident_id"), *keys).distinct()
    sizes_old = old.groupBy("old_incident_id").agg(F.count("*").alias("old_count"))
    sizes_new = new.groupBy("new_incident_id").agg(F.count("*").alias("new_count"))
    overlap = old.join(new, keys).groupBy("old_incident_id", "new_incident_id").agg(F.count("*").alias("overlap_count"))
    both = overlap.join(sizes_old, "old_incident_id").join(sizes_new, "new_incident_id").withColumn("match_status", F.lit("overlap"))
    only_old = sizes_old.join(overlap, "old_incident_id", "left_anti").withColumns({"match_status": F.lit("unmatched_old"), "new_count": F.lit(0).cast("long"), "overlap_count": F.lit(0).cast("long")})
    only_new = sizes_new.join(overlap, "new_incident_id", "left_anti").withColumns({"match_status": F.lit("unmatched_new"), "old_count": F.lit(0).cast("long"), "overlap_count": F.lit(0).cast("long")})
    rows = both.unionByName(only_old, allowMissingColumns=True).unionByName(only_new, allowMissingColumns=True)
    union = F.col("old_count") + F.col("new_count") - F.col("overlap_count")
    return rows.withColumns({
        "union_count": union, "jaccard": F.col("overlap_count") / union,
        "old_coverage": F.coalesce(F.try_divide("overlap_count", "old_count"), F.lit(0.0)), "new_coverage": F.coalesce(F.try_divide("overlap_count", "new_count"), F.lit(0.0)),
    })


def footprint_trail(memberships: DataFrame) -> DataFrame:
    """A story's weekly field sets against the week before: overlap, Jaccard, and why a trail breaks."""
    weekly = memberships.groupBy("story_id", "timeline_bucket").agg(F.sort_array(F.collect_set("field_id")).alias("fields"))
    order = Window.partitionBy("story_id").orderBy("timeline_bucket")
    before = F.lag("fields").over(order)
    rows = weekly.withColumns({"before": before, "gap_days": F.date_diff("timeline_bucket", F.lag("timeline_bucket").over(order))})
    shared = F.size(F.array_intersect("fields", "before"))
    rows = rows.withColumns({
        "field_count": F.size("fields"), "persisting": F.when(F.col("before").isNull(), 0).otherwise(shared),
        "jaccard": F.when(F.col("before").isNull(), 0.0).otherwise(shared / F.size(F.array_union("fields", "before"))),
    })
    why = F.when(F.col("before").isNull(), "first_week").when(F.col("gap_days") != 7, "nonconsecutive_week").when(F.col("persisting") == 0, "zero_field_overlap")
    return rows.withColumns({"break_reason": why, "trail_segment_allowed": why.isNull()}).drop("before", "fields")


@dataclass(frozen=True)
class LifecyclePolicy:
    """Observed weeks that a change of state takes, as the shipped policy has them."""

    confirm_weeks: int = 2
    expire_weeks: int = 2
    quiet_weeks: int = 2
    recovery_weeks: int = 1
    grace_weeks: int = 2
    severe_fields: int = 2
    fresh_fields: int = 1


#: What an adequately covered week does, by state and sign.  A plain name is the next state; otherwise a
#: counter goes up, and at its limit (a field of the policy) the state becomes the last one named.
WEEKS = {
    ("CANDIDATE", "grave"): "CONFIRMED",
    ("CANDIDATE", "support"): ("support", "confirm_weeks", "CONFIRMED"),
    ("CANDIDATE", "none"): ("absent", "expire_weeks", "CLOSED_CANDIDATE_EXPIRED"),
    **{(state, "present"): "ACTIVE" for state in ("CONFIRMED", "RELAPSED", "ACTIVE")},
    **{(state, "present"): "RELAPSED" for state in ("PRESSURE_QUIET", "RECOVERING")},
    ("PRESSURE_QUIET", "impact"): ("quiet", "quiet_weeks", "RECOVERING"),
    ("PRESSURE_QUIET", "healed"): ("quiet", "quiet_weeks", "CLOSED_RECOVERED"),
    ("PRESSURE_QUIET", "silent"): ("quiet", "quiet_weeks", "CLOSED_PRESSURE_QUIET_UNCONFIRMED"),
    ("RECOVERING", "impact"): ("unresolved", "grace_weeks", "CLOSED_RESPONSE_UNRESOLVED"),
    ("RECOVERING", "healed"): ("recovery", "recovery_weeks", "CLOSED_RECOVERED"),
    ("RECOVERING", "silent"): "CLOSED_RESPONSE_UNRESOLVED",
}
#: A counter's rivals, which begin again when it goes up.
RIVALS = {"support": ("absent",), "absent": ("support",), "unresolved": ("recovery",)}
#: What a week says outright, and the state that follows whatever the state was.
VERDICTS = {"merged": "MERGED_INTO", "season_boundary": "CLOSED_SEASON_CENSORED", "data_censored": "CLOSED_DATA_CENSORED"}


class Lifecycle:
    """An incident's state from week to week.  Weeks without adequate coverage freeze its clocks."""

    def __init__(self, policy: LifecyclePolicy) -> None:
        self.policy, self.state = policy, "CANDIDATE"
        self.support = self.absent = self.quiet = self.recovery = self.unresolved = 0
        self.relapses = self.data_gaps = self.gap_streak = 0
        self.first_week = self.confirmed_week = self.pressure_off_week = self.recovered_week = self.closed_week = self.merged_into = self.last_week = None

    @property
    def closed(self) -> bool:
        return self.closed_week is not None

    def _sign(self, seen: dict) -> str:
        fresh, impact, present = seen.get("fresh_decline") or 0, (seen.get("impact") or 0) > 0, bool(seen.get("present"))
        if self.state == "CANDIDATE":
            if not seen.get("support", present or impact or fresh > 0):
                return "none"
            return "grave" if (seen.get("severe") or 0) >= self.policy.severe_fields and fresh >= self.policy.fresh_fields else "support"
        healed = seen.get("recovery", max(seen.get("fresh_recovery") or 0, seen.get("recovered_impact") or 0) > 0)
        return "present" if present else "impact" if impact else "healed" if healed else "silent"

    def _enter(self, state: str, week) -> None:
        if state == "RECOVERING":
            self.unresolved = 1
        if state == "RELAPSED":
            self.relapses += 1
            self.quiet = self.recovery = self.unresolved = 0
            self.pressure_off_week = None
        if state == "ACTIVE":
            self.quiet = 0
        if state == "CONFIRMED":
            self.confirmed_week = week
        if state == "CLOSED_RECOVERED":
            self.recovered_week = week
        if state.startswith("CLOSED_") or state == "MERGED_INTO":
            self.closed_week = week
        self.state = state

    def advance(self, week, seen: dict) -> str:
        if self.last_week is not None and week <= self.last_week:
            raise ValueError("weeks must rise")
        self.last_week = week
        if self.closed:
            return self.state
        verdict = next((v for v in VERDICTS if seen.get(v)), None)
        lacking = verdict == "data_censored" or (verdict is None and not seen.get("adequate", True))
        if lacking:
            self.data_gaps, self.gap_streak = self.data_gaps + 1, self.gap_streak + 1
        if verdict:
            self.merged_into = seen["merged"] if verdict == "merged" else None
            self._enter(VERDICTS[verdict], week)
        elif not lacking:
            self.gap_streak = 0
            self._week(week, self._sign(seen))
        return self.state

    def _week(self, week, sign: str) -> None:
        if sign in ("grave", "support", "present", "impact") and self.first_week is None:
            self.first_week = week
        if (self.state, sign) not in WEEKS:  # pressure has just gone
            self.state, self.quiet, self.pressure_off_week = "PRESSURE_QUIET", 0, week
        does = WEEKS[self.state, sign]
        if isinstance(does, str):
            return self._enter(does, week)
        counter, limit, state = does
        setattr(self, counter, getattr(self, counter) + 1)
        for rival in RIVALS.get(counter, ()):
            setattr(self, rival, 0)
        if getattr(self, counter) >= getattr(self.policy, limit):
            self._enter(state, week)
        return None


LIFE = (
    "incident_id string, timeline_bucket date, incident_state string, quiet_streak int, relapse_count int, data_gap_count int, coverage_gap_streak int, first_evidence_week date,"
    " confirmed_week date, pressure_off_week date, recovered_week date, closed_week date, merged_into_incident_id string"
)
#: What a week may say of an incident; a column that is missing says nothing.
SEEN = ("present", "adequate", "severe", "fresh_decline", "impact", "fresh_recovery", "recovered_impact", "merged", "season_boundary", "data_censored")


class _LifeMachine:
    def __init__(self, policy: LifecyclePolicy, columns: list[str]) -> None:
        self.life, self.columns = Lifecycle(policy), columns

    def day(self, row: tuple) -> list[tuple]:
        life, week = self.life, row[1]
        state = life.advance(week, {k: v for k, v in zip(self.columns, row[2:]) if v is not None})
        return [(row[0], week, state, life.quiet, life.relapses, life.data_gaps, life.gap_streak, life.first_week, life.confirmed_week, life.pressure_off_week, life.recovered_week, life.closed_week, life.merged_into)]

    def end(self) -> list[tuple]:
        return []


def incident_lifecycles(weeks: DataFrame, policy: LifecyclePolicy = LifecyclePolicy()) -> DataFrame:
    """(incident_id, timeline_bucket, some of SEEN) to the state after each week; an incident has a row a week."""
    columns = [c for c in SEEN if c in weeks.columns]
    return run_machines(weeks, "incident_id", ["timeline_bucket"], ["timeline_bucket", *columns], lambda row: _LifeMachine(policy, columns), LIFE)


def lifecycle_windows(lives: DataFrame) -> DataFrame:
    """One row an incident: how it stands at its last week, and whether it is still open there."""
    last = F.max_by(F.struct("incident_state", "relapse_count", "data_gap_count", "confirmed_week", "closed_week"), "timeline_bucket").alias("last")
    out = lives.groupBy("incident_id").agg(F.min("timeline_bucket").alias("opened_week"), F.max("timeline_bucket").alias("last_week"), last)
    return out.select("incident_id", "opened_week", "last_week", "last.*", F.col("last.closed_week").isNull().alias("right_censored"))

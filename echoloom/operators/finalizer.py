"""Crop stories made final: which incident owns an episode's impact, week by week, and how each story lives and ends.

Stories that share episodes or lineage form a group; groups are independent and run side by side, each
in the order of its weeks.  What a week needs (scaffold rows, members, follow-up evidence, lineage) is
put on end as notes of one table, so that one sorted pass feeds the machine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echoloom.operators.automata import run_machines
from echoloom.operators.stories import content_id
from echoloom.operators.tracking import ROLES, Lifecycle, LifecyclePolicy, _families

#: Weeks that a story is followed after its last evidence, and weeks without coverage that end it.
TAIL_WEEKS = GAP_WEEKS = 4
#: Notes of a week in the order in which they count.
KINDS = ("week", "member", "edge", "follow_up")
NOTE = "incident_id string, timeline_bucket date, kind int, episode_key string, other_id string, relation string, role string, event_state string, fresh_decline boolean, fresh_recovery boolean, adequate boolean, season_boundary boolean, last boolean"


def scaffold(members: DataFrame, coverage: DataFrame, tail: int = TAIL_WEEKS) -> DataFrame:
    """A row for every week of an incident from its first evidence to `tail` weeks after its last.

    Cells carry forward from the last week that had any; a week is adequate if `coverage` (cell_x, cell_y,
    timeline_bucket, evaluable) has an evaluable row in every one of them.
    """
    cell = F.concat_ws(":", F.col("cell_x").cast("string"), F.col("cell_y").cast("string"))
    own = members.groupBy("incident_id", "timeline_bucket").agg(F.sort_array(F.collect_set(cell)).alias("own_cells"), F.count_if(F.col("membership_role") == ROLES[0]).alias("core"))
    span = own.groupBy("incident_id").agg(F.min("timeline_bucket").alias("a"), F.max("timeline_bucket").alias("z"))
    weeks = span.select("incident_id", F.explode(F.sequence("a", F.date_add("z", 7 * tail), F.expr("interval 7 days"))).alias("timeline_bucket"), "z")
    order = Window.partitionBy("incident_id").orderBy("timeline_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = weeks.join(own, ["incident_id", "timeline_bucket"], "left").withColumn("cells", F.last("own_cells", ignorenulls=True).over(order))
    seen = coverage.groupBy("timeline_bucket", cell.alias("cell")).agg(F.bool_or("evaluable").alias("seen"))
    checked = rows.select("incident_id", "timeline_bucket", F.explode("cells").alias("cell")).join(seen, ["timeline_bucket", "cell"], "left").groupBy("incident_id", "timeline_bucket").agg(F.bool_and(F.coalesce("seen", F.lit(False))).alias("adequate"))
    out = rows.join(checked, ["incident_id", "timeline_bucket"], "left")
    return out.select("incident_id", "timeline_bucket", F.coalesce("adequate", F.lit(False)).alias("adequate"), F.coalesce("core", F.lit(0)).alias("core_count"), F.col("own_cells").isNull().alias("is_tail"), "cells")


def follow_ups(members: DataFrame, episodes: DataFrame, tail: int = TAIL_WEEKS) -> DataFrame:
    """Fresh evidence of episodes that a story once held, in weeks in which it is no member of it any more.

    `episodes` has episode_key, timeline_bucket, event_state, fresh_decline, fresh_recovery; of several rows
    a week the gravest state counts.  Episodes are followed to `tail` weeks after they were last held.
    """
    rank = F.element_at(F.create_map(*[F.lit(x) for p in (("SEVERE", 4), ("ACTIVE", 3), ("WATCH", 2), ("RECOVERING", 1)) for x in p]), F.col("event_state"))
    weekly = episodes.groupBy("episode_key", "timeline_bucket").agg(F.max_by("event_state", F.coalesce(rank, F.lit(0))).alias("event_state"), F.bool_or("fresh_decline").alias("fresh_decline"), F.bool_or("fresh_recovery").alias("fresh_recovery"))
    held = members.groupBy("incident_id", "episode_key").agg(F.min("timeline_bucket").alias("from_week"), F.max("timeline_bucket").alias("to_week"))
    out = weekly.where("fresh_decline or fresh_recovery").join(held, "episode_key").where(F.col("timeline_bucket").between(F.col("from_week"), F.date_add("to_week", 7 * tail)))
    return out.join(members.select("incident_id", "episode_key", "timeline_bucket").distinct(), ["incident_id", "episode_key", "timeline_bucket"], "left_anti")


def notes(weeks: DataFrame, members: DataFrame, edges: DataFrame, late: DataFrame) -> DataFrame:
    """NOTE rows of all inputs, each with the group of stories it belongs to."""
    nothing = {c.split()[0]: F.lit(None).cast(c.split()[1]) for c in NOTE.split(", ")}

    def noted(rows: DataFrame, kind: str, **cells) -> DataFrame:
        filled = {**nothing, "incident_id": F.col("incident_id"), "timeline_bucket": F.col("timeline_bucket"), "kind": F.lit(KINDS.index(kind)), **cells}
        return rows.select(*[v.alias(k) for k, v in filled.items()])

    last = weeks.groupBy("incident_id").agg(F.max("timeline_bucket").alias("_last"))
    fresh = {c: F.col(c) for c in ("event_state", "fresh_decline", "fresh_recovery")}
    out = noted(weeks.join(last, "incident_id"), "week", adequate=F.col("adequate"), last=F.col("timeline_bucket") == F.col("_last"), season_boundary=F.col("season_boundary") if "season_boundary" in weeks.columns else F.lit(False))
    out = out.union(noted(members, "member", episode_key=F.col("episode_key"), role=F.col("membership_role"), **fresh))
    out = out.union(noted(edges.withColumn("incident_id", F.col("parent_incident_id")), "edge", other_id=F.col("child_incident_id"), relation=F.col("relation")))
    out = out.union(noted(late, "follow_up", episode_key=F.col("episode_key"), **fresh))
    # Stories that hold one episode, or have an edge, are of one group.
    hubs = members.groupBy("episode_key").agg(F.min("incident_id").alias("hub"))
    linked = members.join(hubs, "episode_key").select(F.col("hub").alias("previous_id"), F.col("incident_id").alias("current_id"))
    linked = linked.union(edges.select("parent_incident_id", "child_incident_id")).distinct()
    groups = _families(weeks.select(F.col("incident_id").alias("component_id")).distinct(), linked)
    return out.join(groups.select(F.col("component_id").alias("incident_id"), "family"), "incident_id")


FINAL = (
    "base_id string, story_id string, segment int, timeline_bucket date, story_state string, members int, core int, unresolved int, recovered int, fresh_declines int, fresh_recoveries int,"
    " owned_keys string, merged_into string, data_gap_count int, closed_week date"
)


class Story:
    """One segment of an incident: its life, and the episodes it answers for."""

    def __init__(self, base: str, segment: int, week, policy: LifecyclePolicy) -> None:
        self.base, self.segment = base, segment
        self.id = base if segment == 0 else content_id("incident_segment", base, week)
        self.life = Lifecycle(policy)
        self.seeds: dict[str, object] = {}
        self.unresolved: set[str] = set()
        self.recovered: set[str] = set()


class GroupMonitor:
    def __init__(self, policy: LifecyclePolicy) -> None:
        self.policy = policy
        self.open: dict[str, Story] = {}
        self.segments: dict[str, int] = {}
        self.week, self.held = None, []

    def day(self, row: tuple) -> list[tuple]:
        """Notes come sorted by week; a week is settled once the next one begins."""
        out = []
        if self.week is not None and row[2] != self.week:
            out, self.held = self._settle(), []
        self.week = row[2]
        self.held.append(row)
        return out

    def end(self) -> list[tuple]:
        return self._settle()

    def _of(self, kind: str) -> list[tuple]:
        return [r for r in self.held if r[3] == KINDS.index(kind)]

    def _admit(self, weeks: dict[str, tuple], members: dict[str, list]) -> None:
        for base in sorted(members):
            starts = any(m[7] in ROLES[:2] for m in members[base])
            if base not in self.open and starts and base in weeks and weeks[base][11]:
                self.open[base] = Story(base, self.segments.get(base, 0), self.week, self.policy)
            if base in self.open:
                self.open[base].seeds |= {m[4]: self.week for m in members[base]}

    def _transfer(self, members: dict[str, list]) -> dict[str, str]:
        """Unresolved episodes along this week's edges; which stories merge into which."""
        merged: dict[str, str] = {}
        edges = [(r[1], r[5], r[6]) for r in self._of("edge") if r[1] in self.open and r[5] in self.open]
        for parent in sorted({e[0] for e in edges}):
            into = sorted(c for p, c, kind in edges if p == parent and kind == "merge")
            apart = sorted(c for p, c, kind in edges if p == parent and kind == "split")
            if into and apart:
                raise ValueError(f"{parent} splits and merges in one week")
            if len(into) > 1:
                raise ValueError(f"{parent} merges into several stories")
            for key in sorted(self.open[parent].unresolved):
                holders = into or [c for c in apart if any(m[4] == key for m in members.get(c, ()))]
                if len(holders) > 1:
                    raise ValueError(f"several stories hold {key} after a split")
                for child in holders:
                    self.open[parent].unresolved.discard(key)
                    self.open[child].unresolved.add(key)
            if into:
                merged[parent] = self.open[into[0]].id
        return merged

    def _claim(self, members: dict[str, list], merged: dict[str, str]) -> dict[str, str]:
        """Episodes that a story's own rows claim; what others held of them goes to the claimant."""
        claims: dict[str, str] = {}
        for base, rows in sorted(members.items()):
            if base not in self.open:
                continue
            for m in rows:
                if m[7] == ROLES[1] or m[8] == "CLOSED_RESPONSE_UNRESOLVED" or m[9]:
                    if claims.setdefault(m[4], base) != base:
                        raise ValueError(f"two stories claim {m[4]}")
                    if base in merged:
                        raise ValueError(f"{base} claims an episode and merges away")
        for key, base in claims.items():
            held = any(key in s.unresolved for s in self.open.values())
            for other, s in self.open.items():
                if other != base:
                    s.seeds.pop(key, None)
                    s.unresolved.discard(key)
                    s.recovered.discard(key)
            if held:
                self.open[base].unresolved.add(key)
        return claims

    def _owner(self, key: str, claims: dict[str, str]) -> str | None:
        """Whose a piece of fresh evidence is: the claimant's, an unresolved or recovered owner's, the latest unique seed's."""
        if key in claims:
            return claims[key]
        for held in ("unresolved", "recovered"):
            owners = [b for b, s in self.open.items() if key in getattr(s, held)]
            if owners:
                return min(owners)
        seeds = sorted(((s.seeds[key], b) for b, s in self.open.items() if key in s.seeds), reverse=True)
        if len(seeds) > 1 and seeds[0][0] == seeds[1][0]:
            raise ValueError(f"several stories seeded {key} last")
        return seeds[0][1] if seeds else None

    def _settle(self) -> list[tuple]:
        weeks = {r[1]: r for r in self._of("week")}
        members: dict[str, list] = {}
        for r in self._of("member"):
            members.setdefault(r[1], []).append(r)
        self._admit(weeks, members)
        merged = self._transfer(members)
        claims = self._claim(members, merged)
        fell: dict[str, set] = {}
        healed: dict[str, set] = {}
        for r in [m for rows in members.values() for m in rows] + self._of("follow_up"):
            for told, said in ((fell, r[9]), (healed, r[10])):
                owner = self._owner(r[4], claims) if said else None
                if owner is not None:
                    told.setdefault(owner, set()).add(r[4])
        out = []
        for base in sorted(self.open):
            s, down, up = self.open[base], fell.get(base, set()), healed.get(base, set())
            up = up - down  # a decline in the same week stays unresolved
            s.recovered = (s.recovered | (up & s.unresolved)) - down
            s.unresolved = (s.unresolved | down) - up
            own = members.get(base, [])
            core = sum(m[7] == ROLES[0] for m in own)
            week = weeks.get(base)
            adequate = bool(week and week[11])
            censored = bool(week and week[13]) and not adequate and s.life.gap_streak + 1 >= GAP_WEEKS and base not in merged
            seen = {
                "present": core > 0, "adequate": adequate, "severe": sum(m[8] == "SEVERE" for m in own), "fresh_decline": len(down), "impact": len(s.unresolved), "fresh_recovery": len(up), "recovered_impact": len(s.recovered),
                "merged": merged.get(base), "season_boundary": bool(week and week[12]) and not core, "data_censored": censored,
            }
            state = s.life.advance(self.week, seen)
            out.append((base, s.id, s.segment, self.week, state, len(own), core, len(s.unresolved), len(s.recovered), len(down), len(up), "+".join(sorted(s.unresolved)), merged.get(base), s.life.data_gaps, s.life.closed_week))
            if s.life.closed or (week is not None and week[13]):
                self.segments[base] = s.segment + 1
        for row in out:
            if row[0] in self.open and (self.open[row[0]].life.closed or (row[0] in weeks and weeks[row[0]][13])):
                del self.open[row[0]]
        return out


def finalize(weeks: DataFrame, members: DataFrame, edges: DataFrame, late: DataFrame, policy: LifecyclePolicy = LifecyclePolicy()) -> DataFrame:
    """FINAL rows: every open story's week, with its state and the episodes whose impact it answers for."""
    columns = [c.split()[0] for c in NOTE.split(", ")]
    return run_machines(notes(weeks, members, edges, late), "family", ["timeline_bucket", "kind", "incident_id", "episode_key", "other_id"], columns, lambda row: GroupMonitor(policy), FINAL)


def story_windows(final: DataFrame) -> DataFrame:
    """One row a story: from its first week to its last, its peak week (the earliest of the largest) and its end."""
    peak = F.max_by("timeline_bucket", F.struct(F.col("core") + F.col("unresolved"), -F.unix_date("timeline_bucket"))).alias("peak_week")
    last = F.max_by(F.struct("story_state", "closed_week", "merged_into", "data_gap_count"), "timeline_bucket").alias("last")
    out = final.groupBy("story_id", "base_id", "segment").agg(F.min("timeline_bucket").alias("opened_week"), F.max("timeline_bucket").alias("last_week"), peak, F.sum("fresh_declines").alias("declines"), F.sum("fresh_recoveries").alias("recoveries"), last)
    return out.select("story_id", "base_id", "segment", "opened_week", "last_week", "peak_week", "declines", "recoveries", "last.*", F.col("last.closed_week").isNull().alias("right_censored"))

"""Event stories: a causal automaton for each crop instance, and what is read off its output.

A day is a *sign* to every open story, and a table says what a sign does in a state; what counts days
(quiet ones, ones without recovery) is settled by a second table when its time is up.  The batch path
and the streaming path run the same machine.  Everything after it is columns, windows and aggregates.
"""

from __future__ import annotations

import hashlib
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echoloom.functions import normalize as nz
from echoloom.operators.automata import names_of, run_machines
from echoloom.operators.signals import Policy

OPEN = ("WATCH", "ACTIVE", "SEVERE", "QUIET_PENDING", "RECOVERING")
DECLINES = ("medium_decline", "severe_decline")
EVIDENCE = (*DECLINES, "recovery")
LOOSE = "unattributed_decline"
#: States in which somebody should look at a story.
GRAVE = ("SEVERE", "RECOVERING", "CLOSED_RESPONSE_UNRESOLVED")

#: The signs of a day, gravest first: a severe decline, rank 4, rank 3, rank 2, less, and nothing seen.
SIGNS = ("blow", "peak", "press", "stir", "calm", "unseen")
#: By state, what each sign does: a state to go to, or a step of `Story.step`.
TABLE = {
    "WATCH": ("SEVERE", "SEVERE", "grade", "grade", "wane", "stay"),
    "ACTIVE": ("SEVERE", "SEVERE", "ACTIVE", "wane", "wane", "stay"),
    "SEVERE": ("SEVERE", "SEVERE", "SEVERE", "wane", "wane", "stay"),
    "QUIET_PENDING": ("SEVERE", "SEVERE", "ACTIVE", "wane", "wane", "stay"),
    "RECOVERING": ("SEVERE", "SEVERE", "ACTIVE", "mend", "mend", "heal"),
}
#: How a story ends, and why.
ENDINGS = {
    "healed": ("CLOSED_RECOVERED", "attributed_recovery_confirmed"),
    "watched": ("CLOSED_WATCH_QUIET", "watch_quiet_observed_deadline"),
    "quiet": ("CLOSED_PRESSURE_QUIET_UNCONFIRMED", "pressure_quiet_without_fresh_recovery_evidence"),
    "waited": ("CLOSED_RESPONSE_UNRESOLVED", "response_unresolved_observed_deadline"),
    "boundary": ("CLOSED_SEASON_BOUNDARY", "next_crop_instance_observed"),
}
#: The states that a story can open in, by grade.
GRADES = (None, "WATCH", "ACTIVE", "SEVERE")

CORE = (
    "field_id string, crop_name string, crop_season string, crop_instance_id string, observation_date date, event_state string, underlying_state string,"
    " hazard_signature string, max_risk_rank int, daily_pressure_rank int, pressure_observed boolean, reportable_day_count long, response_day_count long,"
    " is_data_gap_snapshot boolean, daily_response_class string, last_decline_date date, last_recovery_date date, event_start_date date, last_pressure_date date,"
    " stage_signature string, response_signature string, close_reason string, is_member boolean"
)
_NAMES = names_of(CORE)
#: What a machine reads of a causal signal, after the instance.
READ = ("field_id", "crop_name", "crop_season", "observation_date", "pressure_observed", "hazard_family", "risk_rank", "response_class", "new_response_evidence", "stage_family", "next_start")


def content_id(prefix: str, *parts, length: int = 24) -> str:
    text = "\x1f".join("" if p is None else str(p) for p in parts)
    return f"{prefix}_{hashlib.sha256(text.encode()).hexdigest()[:length]}"


def grade(recent: tuple, told: str | None) -> int:
    """What the last three observed ranks and a response ask for, as a place in GRADES."""
    now = recent[-1] if recent else -1
    lasting = [sum(rank >= level for rank in recent) >= 2 for level in (2, 3)]
    asked = [lasting[0] and 1, lasting[1] and 2, now >= 4 and 3, told == "medium_decline" and (2 if now >= 2 else 1), told == "severe_decline" and 3]
    return max(map(int, asked))


class Story:
    """One hazard's open event, and its counters of observed days."""

    __slots__ = ("hazard", "start", "state", "pressure_day", "peak", "reportable", "answered", "quiet", "waiting", "declined", "recovered", "stages", "responses", "reason")

    def __init__(self, hazard: str, start: date, state: str, pressed: bool) -> None:
        self.hazard, self.start, self.state = hazard, start, state
        self.pressure_day = start if pressed else None
        self.peak = self.reportable = self.answered = self.quiet = self.waiting = 0
        self.declined = self.recovered = self.reason = None
        self.stages: set[str] = set()
        self.responses: set[str] = set()

    @property
    def open(self) -> bool:
        return self.reason is None

    @property
    def unresolved(self) -> bool:
        return self.declined is not None and not (self.recovered is not None and self.recovered >= self.declined)

    @property
    def healed(self) -> bool:
        return self.declined is not None and not self.unresolved

    def end(self, how: str) -> None:
        self.state, self.reason = ENDINGS[how]

    def note(self, day: date, stage: str, rank: int, told: str | None) -> None:
        """What a day adds to the story's account, whatever it does to its state."""
        self.stages.add(stage)
        self.peak = max(self.peak, rank)
        if told in EVIDENCE:
            self.answered += 1
            self.responses.add(told)
            if told == "recovery":
                self.recovered = day
            else:
                self.declined = day
        self.reportable += told in DECLINES or rank >= 2

    def step(self, day: date, rank: int | None, told: str | None, asked: int, policy: Policy) -> None:
        sign = 0 if told == "severe_decline" else 5 if rank is None else (4, 4, 3, 2, 1)[min(rank, 4)]
        does = TABLE[self.state][sign]
        if rank is not None and (rank >= 3 or does == "grade"):
            self.pressure_day, self.quiet = day, 0
        if does in TABLE or (does == "grade" and rank >= 3):
            self.quiet = self.waiting = 0
        if does in TABLE:
            self.state = does
        elif does == "grade":
            self.state = GRADES[max(asked, 1)]
        elif does in ("mend", "heal") and told == "recovery" and self.healed:
            self.end("healed")
        elif does == "mend":
            self.waiting += 1
            if self.waiting >= policy.recovery_days:
                self.end("waited")
        elif does == "wane":
            self._wane(policy)

    def _wane(self, policy: Policy) -> None:
        self.quiet += 1
        watched = self.state == "WATCH"
        due = self.quiet >= policy.quiet_days.get(self.hazard, policy.quiet_days["other"])
        if due and not self.unresolved:
            self.end("healed" if self.healed else "watched" if watched else "quiet")
        elif due:
            self.state, self.waiting = "RECOVERING", 0
        elif not watched:
            self.state = "QUIET_PENDING"


class InstanceMonitor:
    """The running stories of one crop instance; `day` takes its rows in order and returns records."""

    def __init__(self, row: tuple, policy: Policy) -> None:
        instance, field, crop, season = row[:4]
        self.meta, self.policy = (field, crop, season, instance), policy
        self.stories: dict[str, Story] = {}
        self.recent: dict[str, tuple] = {}
        self.before: date | None = None
        self.next_start: date | None = None

    def record(self, s: Story, day: date, rank: int = 0, observed: bool = True, told: str | None = None, gap: bool = False, member: bool = False) -> tuple:
        return (
            *self.meta, day, "DATA_GAP" if gap else s.state, s.state, s.hazard, s.peak, rank, observed, s.reportable, s.answered, gap, told or "no_new_event_response",
            s.declined, s.recovered, s.start, s.pressure_day, ">".join(sorted(s.stages)) or "unknown", ">".join(sorted(s.responses)) or "spectral_missing", s.reason, member,
        )

    def _silence(self, day: date) -> list[tuple]:
        """The Mondays of a long silence before `day`, for each open story."""
        before, self.before = self.before, day
        if before is None or (day - before).days <= self.policy.data_gap_days:
            return []
        mondays = pd.date_range(before + timedelta(days=1), day - timedelta(days=1), freq="W-MON").date
        return [self.record(s, monday, observed=False, gap=True) for monday in mondays for s in self.stories.values()]

    def _answered_hazards(self, response: str | None, pressing: str | None) -> set[str]:
        """Which hazards a response is put down to: the pressing one, the loose one, or the only one unresolved."""
        if response in DECLINES:
            return {pressing or LOOSE}
        waiting = [h for h, s in self.stories.items() if s.unresolved] if response == "recovery" else []
        return set(waiting) if len(waiting) == 1 else set()

    def day(self, row: tuple) -> list[tuple]:
        """`row` is the instance and READ."""
        _, _, _, _, day, observed, hazard, rank, response, fresh, stage, self.next_start = row
        out = self._silence(day)
        response = response if fresh else None
        named = hazard if observed and hazard != "none" else None
        aimed = self._answered_hazards(response, named if rank >= 2 else None)
        openers = {h for h in (named, *(aimed if response in DECLINES else ())) if h}
        if observed:
            for h in {*self.recent, *self.stories, *openers}:
                self.recent[h] = (*self.recent.get(h, ())[-2:], rank if h == hazard else 0)
        begun = set()
        for h in sorted(openers.difference(self.stories)):
            state = GRADES[grade(self.recent.get(h, ()), response if h in aimed else None)]
            if state:
                self.stories[h] = Story(h, day, state, observed and rank >= 2)
                begun.add(h)
        for h, s in list(self.stories.items()):
            own, told = rank if observed and h == hazard else 0, response if h in aimed else None
            s.note(day, stage, own, told)
            if h not in begun:
                s.step(day, own if observed else None, told, grade(self.recent.get(h, ()), told), self.policy)
            out.append(self.record(s, day, own, observed, told, s.open and not observed and told is None, True))
            if not s.open:
                del self.stories[h]
                self.recent.pop(h, None)
        return out

    def end(self) -> list[tuple]:
        """A later crop instance of the field, if there is one, closes what is open."""
        out = []
        for s in self.stories.values() if self.next_start is not None else ():
            s.end("boundary")
            out.append(self.record(s, self.next_start))
        return out


def run_instance(days: pd.DataFrame, policy: Policy) -> pd.DataFrame:
    """One instance's records without Spark."""
    rows = list(days.sort_values("observation_date", kind="mergesort")[["crop_instance_id", *READ]].astype(object).where(lambda x: x.notna(), None).itertuples(index=False, name=None))
    machine = InstanceMonitor(rows[0], policy)
    return pd.DataFrame([r for row in rows for r in machine.day(row)] + machine.end(), columns=_NAMES)


def finished(records: DataFrame, policy: Policy) -> DataFrame:
    """The columns that follow from a machine's records."""
    shown, state = F.col("event_state"), F.col("underlying_state")
    return records.withColumns({
        "event_id": nz.stable_id("event", F.col("field_id"), F.col("crop_instance_id"), F.col("hazard_signature"), F.col("event_start_date"), F.lit(policy.version)),
        "current_risk_rank": F.when(F.col("pressure_observed"), F.col("daily_pressure_rank")), "right_censored": shown.isin(*OPEN) | F.col("is_data_gap_snapshot"),
        "requires_review": (F.col("hazard_signature") == LOOSE) | shown.isin(*GRAVE) | state.isin(*GRAVE),
    })


def with_next_start(signals: DataFrame) -> DataFrame:
    """Each signal with the day on which the field's next crop instance begins."""
    starts = signals.groupBy("field_id", "crop_instance_id").agg(F.min("crop_instance_start_date").alias("begun"))
    order = Window.partitionBy("field_id").orderBy("begun", "crop_instance_id")
    ends = starts.withColumn("next_start", F.lead("begun").over(order)).select("crop_instance_id", "next_start")
    return signals.join(ends, "crop_instance_id")


def daily_stories(signals: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """The daily records of all event stories; instances are independent, and bounded by a season."""
    records = run_machines(with_next_start(signals), "crop_instance_id", ["observation_date"], READ, lambda row: InstanceMonitor(row, policy), CORE)
    return finished(records, policy)


def event_windows(daily: DataFrame, as_of: str) -> DataFrame:
    """One row an event: its last record says how it stands."""
    last = Window.partitionBy("event_id").orderBy(F.desc("observation_date"), F.desc("is_member"))
    rows = daily.where("not is_data_gap_snapshot or is_member").withColumn("__n", F.row_number().over(last)).where("__n = 1")
    closed = ~F.col("underlying_state").isin(*OPEN)
    return rows.select(
        "field_id", "crop_instance_id", "event_id", "event_start_date", F.col("last_pressure_date").alias("active_end_date"),
        F.when(closed, F.col("observation_date")).alias("event_end_date"), F.col("underlying_state").alias("event_state"), "hazard_signature", "max_risk_rank",
        nz.band_of(F.col("max_risk_rank")).alias("max_risk_band"), "stage_signature", "response_signature",
        F.coalesce("close_reason", F.lit("input_boundary_right_censored")).alias("close_reason"), "reportable_day_count", "response_day_count",
        (F.date_diff("observation_date", "event_start_date") + 1).alias("window_span_days"), (~closed).alias("right_censored"), F.lit(as_of).cast("date").alias("as_of_date"),
    )


def weekly_snapshots(daily: DataFrame) -> DataFrame:
    """An event's last daily record in each week."""
    week = nz.week_of(F.col("observation_date"))
    last = Window.partitionBy("event_id", "timeline_bucket").orderBy(F.desc("observation_date"), F.desc("is_member"))
    return daily.withColumn("timeline_bucket", week).withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")


def map_frames(daily: DataFrame) -> DataFrame:
    """Snapshots with the week's own counts of reportable days and of responses."""
    own = daily.where("is_member").groupBy("event_id", nz.week_of(F.col("observation_date")).alias("timeline_bucket")).agg(
        F.count_if(F.col("daily_pressure_rank") >= 2).alias("weekly_reportable_days"), F.count_if(F.col("daily_response_class").isin(*EVIDENCE)).alias("weekly_response_days")
    )
    kept = weekly_snapshots(daily).select("timeline_bucket", "field_id", "event_id", "event_state", "hazard_signature", "max_risk_rank", "current_risk_rank", "requires_review")
    return kept.join(own, ["event_id", "timeline_bucket"], "left").fillna(0, ["weekly_reportable_days", "weekly_response_days"])


def onset_labels(daily: DataFrame) -> DataFrame:
    """What was known of an event on its first day; nothing later leaks."""
    first = Window.partitionBy("event_id").orderBy("observation_date")
    rows = daily.where("is_member").withColumn("__n", F.row_number().over(first)).where("__n = 1")
    return rows.select("event_id", "field_id", "hazard_signature", "event_state", "max_risk_rank", F.col("observation_date").alias("label_date"), F.lit(1).alias("window_span_days"))


def crop_instance_summary(signals: DataFrame) -> DataFrame:
    keys = ["field_id", "crop_name", "crop_season", "crop_instance_id"]
    return signals.groupBy(*keys).agg(
        F.min("crop_instance_start_date").alias("crop_instance_start_date"), F.max("observation_date").alias("last_observation_date"), F.count("*").alias("observation_count")
    )

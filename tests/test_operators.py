"""Operators whose semantics SQL cannot express, on small cases."""

import itertools
import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from echoloom.functions.statistics import benjamini_hochberg, benjamini_hochberg_by_value, best_assignment, normal_upper_tail
from echoloom.operators import cells, prototypes, signals, stories, temporal, tracking
from echoloom.operators.signals import Policy
from echoloom.sources import bundle, geometry, observations

POLICY = Policy()


def days(ranks, hazard="heat", responses=None, start=date(2025, 1, 1), step=1):
    """Causal signals of one instance: a rank for each day, None for a day nobody saw."""
    rows = []
    for k, rank in enumerate(ranks):
        response = (responses or {}).get(k)
        rows.append(("f", "Maize", "A", "i", start + timedelta(days=k * step), rank is not None, hazard if rank else "none", rank or 0, response or "no_new_acquisition", response is not None, "vegetative", None))
    names = ["field_id", "crop_name", "crop_season", "crop_instance_id", "observation_date", "pressure_observed", "hazard_family", "risk_rank", "response_class", "new_response_evidence", "stage_family", "next_start"]
    return pd.DataFrame(rows, columns=names)


def states(frame):
    out = stories.run_instance(frame, POLICY)
    return [(r.observation_date.day, r.event_state) for r in out.itertuples()]


def test_onset_needs_two_of_three_days():
    assert states(days([2, 0, 2])) == [(3, "WATCH")]
    assert states(days([3, 3])) == [(2, "ACTIVE")]
    assert states(days([4])) == [(1, "SEVERE")]
    assert states(days([2, 0, 0, 2])) == []


def test_quiet_days_close_an_event():
    assert states(days([3, 3, 0, 0, 0, 0]))[-1] == (6, "CLOSED_PRESSURE_QUIET_UNCONFIRMED")
    assert states(days([2, 2, 0, 0, 0, 0]))[-1] == (6, "CLOSED_WATCH_QUIET")
    assert states(days([3, 3, 0, 0, 3, 0]))[-1] == (6, "QUIET_PENDING")


def test_unobserved_days_freeze_the_clock():
    got = states(days([3, 3, 0, None, None, 0, 0, 0]))
    assert [s for d, s in got if d in (4, 5)] == ["DATA_GAP", "DATA_GAP"]
    assert got[-1] == (8, "CLOSED_PRESSURE_QUIET_UNCONFIRMED")


def test_decline_keeps_an_event_until_recovery():
    got = states(days([3, 3, 0, 0, 0, 0, 0], responses={1: "medium_decline", 6: "recovery"}))
    assert got[-2] == (6, "RECOVERING") and got[-1] == (7, "CLOSED_RECOVERED")


def test_decline_without_pressure_is_unattributed():
    out = stories.run_instance(days([0, 1], responses={1: "severe_decline"}), POLICY)
    assert list(out.hazard_signature) == ["unattributed_decline"] and list(out.event_state) == ["SEVERE"]


def test_gaps_show_on_mondays_and_boundaries_close():
    frame = days([3, 3, 3], step=10)
    frame["next_start"] = date(2025, 3, 1)
    out = stories.run_instance(frame, POLICY)
    gaps = out[out.is_data_gap_snapshot]
    assert [d.weekday() for d in gaps.observation_date] == [0] * len(gaps) and len(gaps) > 0
    assert out.iloc[-1].event_state == "CLOSED_SEASON_BOUNDARY" and out.iloc[-1].observation_date == date(2025, 3, 1)


def test_automaton_is_prefix_safe():
    rng = random.Random(3)
    ranks = [rng.choice([0, 1, 2, 3, 4, None]) for _ in range(60)]
    responses = {k: rng.choice(["medium_decline", "severe_decline", "recovery"]) for k in range(5, 60, 7)}
    whole = stories.run_instance(days(ranks, responses=responses), POLICY)
    for cut in (10, 25, 40):
        part = stories.run_instance(days(ranks[:cut], responses=responses), POLICY)
        same = whole[whole.observation_date <= date(2025, 1, 1) + timedelta(days=cut - 1)].reset_index(drop=True)
        pd.testing.assert_frame_equal(part.reset_index(drop=True), same)


def observations_of(spark, rows):
    base = {"crop_name": "Maize", "crop_season": "A", "crop_stage": "Vegetative", "risk_level": "LOW", "primary_risk_driver": "heat", "ndmi": 0.2, "psri": 0.1}
    data = [{**base, "field_id": "a", "observation_date": d, "spectral_echo_days": e, "ndvi": v} for d, e, v in rows]
    return observations.canonical(spark.createDataFrame(pd.DataFrame(data)))


def test_echoes_are_no_evidence(spark):
    rows = [(date(2025, 1, 1), 0, 0.5), (date(2025, 1, 2), 1, 0.5), (date(2025, 1, 8), 0, 0.34), (date(2025, 1, 9), 1, 0.34)]
    out = signals.causal_signals(observations_of(spark, rows)).orderBy("observation_date").collect()
    assert [r.is_new_acquisition for r in out] == [True, False, True, False]
    assert out[2].response_class == "severe_decline" and out[2].response_evidence == "ndvi" and out[2].reference_source_date == date(2025, 1, 1)
    assert out[3].response_class == "no_new_acquisition"
    early = signals.causal_signals(observations_of(spark, rows[:3])).orderBy("observation_date").collect()
    assert early == out[:3]


def test_aliases_and_missing_columns(spark):
    df = spark.createDataFrame([("a", "2025-01-01", "Maize", "A", "x", "LOW", "heat", "3", 0.1, 0.2, "bad")], ["Field", "Calendar Date", "Crop", "Season", "Stage", "Risk", "Driver", "Echo-Days", "NDVI", "ndmi", "psri"])
    row = observations.canonical(df).first()
    assert row.field_id == "a" and row.observation_date == date(2025, 1, 1) and row.spectral_echo_days == 3 and row.psri is None and row.spi_index is None
    with pytest.raises(ValueError, match="ndvi"):
        observations.canonical(df.drop("NDVI"))


def test_best_assignment_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n, m = rng.integers(1, 5, 2)
        benefit = np.where(rng.random((n, m)) < 0.3, -np.inf, rng.integers(0, 20, (n, m)) / 10)
        best = 0.0
        for columns in itertools.permutations([*range(m), *[-1] * n], int(n)):
            total = sum(benefit[i, j] for i, j in enumerate(columns) if j >= 0)
            best = max(best, total)
        chosen = best_assignment(benefit)
        used = [j for j in chosen if j >= 0]
        assert len(used) == len(set(used)) and sum(benefit[i, j] for i, j in enumerate(chosen) if j >= 0) == pytest.approx(best)


def test_tails_and_false_discovery(spark):
    df = spark.createDataFrame([(k, float(z)) for k, z in enumerate([0, 1.96, -1.0, 3.0, float("nan")])], "k int, z double").withColumn("p", normal_upper_tail("z"))
    got = {r.k: r.p for r in df.collect()}
    assert got[0] == pytest.approx(0.5) and got[1] == pytest.approx(0.0249978951, abs=1e-9) and got[4] == 1.0
    q = {r.k: r.q for r in benjamini_hochberg(df.withColumn("g", F.lit(1)), ["g"], "p", "q", ["k"]).collect()}
    assert q[3] == pytest.approx(got[3] * 5) and q[1] == pytest.approx(got[1] * 5 / 2) and q[4] == 1.0


def test_false_discovery_runs_down_the_ranks(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [None, "a", "b"][rng.integers(0, 3)], [None, float("nan"), -0.5, 1.5, -0.0, *(rng.integers(0, 20, 7) / 20).tolist()][rng.integers(0, 12)]) for k in range(300)]
    df = spark.createDataFrame(rows, "k int, g string, p double")
    want = {}
    for g in (None, "a", "b"):
        ranked = sorted((1.0 if p is None or p != p else min(max(p, 0.0), 1.0), k) for k, h, p in rows if h == g)
        least = 1.0
        for n in range(len(ranked), 0, -1):
            least = min(least, ranked[n - 1][0] * len(ranked) / n)
            want[ranked[n - 1][1]] = least
    for found in (benjamini_hochberg(df, ["g"], "p", "q", ["k"]), benjamini_hochberg_by_value(df, ["g"], "p", "q")):
        assert {r.k: r.q for r in found.collect()} == want and found.columns == ["k", "g", "p", "q"]
        # Such a frame takes a time that grows with the square of a key's rows.
        assert "currentrow$(), unboundedfollowing$()" not in found._jdf.queryExecution().optimizedPlan().toString()


def components_of(spark, rows):
    """(week, name, cells, fields) as components with their sets; an episode is a field."""
    data = []
    for week, name, places, fields in rows:
        xy = [tuple(map(int, c.split(":"))) for c in places]
        centre = [5 * (sum(p[k] for p in xy) / len(xy) + 0.5) for k in (0, 1)]
        data.append((date(2025, 1, 6) + timedelta(days=7 * week), "heat", f"component_{name}", [f"g:{c}" for c in sorted(places)], *centre, sorted(fields), sorted(fields), {"vegetative": len(fields)}))
    return spark.createDataFrame(data, "timeline_bucket date, hazard_family string, component_id string, cells array<string>, center_x_km double, center_y_km double, fields array<string>, episodes array<string>, stages map<string,bigint>")


def test_components_of_cells(spark):
    rows = [(date(2025, 1, 6), "heat", x, y) for x, y in ((0, 0), (1, 1), (5, 5))] + [(date(2025, 1, 13), "heat", x, y) for x, y in ((1, 1), (2, 1), (9, 9))]
    labelled = tracking.weekly_components(spark.createDataFrame(rows, "timeline_bucket date, hazard_family string, cell_x long, cell_y long"))
    comps = tracking.component_summary(labelled)
    assert sorted((r.timeline_bucket.day, r.cell_count) for r in comps.collect()) == [(6, 1), (6, 2), (13, 1), (13, 2)]
    lanes = [(date(2025, 1, 6), "heat", *p, f, s, fresh) for p, f, s, fresh in (((0, 0), "a", "ACTIVE", False), ((1, 1), "b", "SEVERE", True), ((2, 2), "c", "ACTIVE", True), ((2, 2), "d", "WATCH", True), ((2, 1), "e", "WATCH", False), ((3, 3), "f", "WATCH", False), ((5, 5), "g", "WATCH", False))]
    members = tracking.component_members(comps, spark.createDataFrame(lanes, "timeline_bucket date, hazard_family string, cell_x long, cell_y long, field_id string, event_state string, fresh boolean"))
    # An active field outside the cells belongs to none; (3, 3) touches no cell's neighbourhood.
    assert {r.field_id: r.membership_role for r in members.collect()} == {"a": "pressure_core", "b": "pressure_core", "d": "impact_lag", "e": "watch_frontier", "g": "watch_frontier"}
    assert sorted(r.cell_count for r in tracking.without_core(comps, members).where("timeline_bucket = date'2025-01-06'").collect()) == [1]


def test_link_scores_follow_the_weights(spark):
    pair = components_of(spark, [(0, "a", ["0:0", "1:0"], "xyz"), (2, "b", ["1:0", "2:0"], "yzw")])
    row = tracking.score_links(pair).collect()
    near = np.exp(-5.0 / 15.0)
    assert len(row) == 1 and row[0].gap_weeks == 2 and row[0].cell_jaccard == pytest.approx(1 / 3) and row[0].episode_jaccard == 0.5 and row[0].stage_cosine == pytest.approx(1.0)
    assert row[0].score == pytest.approx(0.35 * 0.5 + 0.25 / 3 + 0.25 * 0.5 + 0.15 * near - 0.1)
    far = components_of(spark, [(0, "a", ["0:0"], "x"), (1, "b", ["9:9"], "y"), (3, "c", ["0:0"], "x")])
    assert tracking.score_links(far).collect() == []


def test_splits_merges_and_gaps(spark):
    comps = components_of(spark, [
        (0, "a", ["0:0", "1:0"], "pqrs"), (1, "b", ["0:0"], "pqr"), (1, "c", ["1:0"], "s"), (3, "d", ["0:0", "1:0"], "pqrs"), (4, "e", ["0:0"], "pq"), (4, "z", ["40:40"], "k"), (7, "f", ["0:0"], "pq"),
    ])
    tracked = tracking.track(comps, tracking.score_links(comps)).collect()
    named = {r.component_id[-1]: r.exposure_id[-1] for r in tracked if r.kind == "assignment"}
    assert named == {"a": "a", "b": "a", "c": "c", "d": "a", "e": "a", "z": "z", "f": "f"}  # three weeks are too long a gap
    edges = {(r.related_exposure_id[-1], r.exposure_id[-1], r.relation) for r in tracked if r.kind == "lineage"}
    assert edges == {("a", "c", "split"), ("c", "a", "merge")}
    continued = [r for r in tracked if r.kind == "assignment" and r.relation == "continued"]
    assert {(r.previous_id[-1], r.component_id[-1]) for r in continued} == {("a", "b"), ("b", "d"), ("d", "e")}


def brute_tracking(rows, scores, threshold):
    """Week by week over everything, by trying all matchings."""
    latest, named = {}, {}
    for week in sorted({w for w, *_ in rows}):
        own = [n for w, n, *_ in rows if w == week]
        before = list(latest)
        best, chosen = -1.0, {}
        for picks in itertools.permutations([*before, *[None] * len(own)], len(own)):
            total, links = 0.0, {}
            for n, b in zip(own, picks):
                score = scores.get((b, n), -1.0)
                if b is not None and score >= threshold:
                    total, links[n] = total + score, b
            if total > best + 1e-12:
                best, chosen = total, links
        ended = set(chosen.values())
        for b in before:
            merged = [n for n in own if scores.get((b, n), -1) >= 0.3 and n in chosen and b not in ended]
            if merged:
                ended.add(b)
        for n in own:
            named[n] = latest[chosen[n]] if n in chosen else n
        latest = {b: e for b, e in latest.items() if b not in ended} | {n: named[n] for n in own}
    return named


def test_tracking_equals_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for week in range(5):
        for k in range(3):
            x = rng.randrange(0, 6)
            rows.append((week, f"{week}x{k}", sorted({f"{x + i}:{k // 2}" for i in range(rng.randrange(1, 4))}), rng.sample("abcdefgh", rng.randrange(1, 5))))
    comps = components_of(spark, rows)
    links = tracking.score_links(comps, tracking.LinkPolicy(related_jaccard=0.0))
    scores = {(r.previous_id[10:], r.current_id[10:]): r.score for r in links.collect()}
    expected = brute_tracking(rows, scores, 0.35)
    tracked = tracking.assignments(tracking.track(comps, links, tracking.LinkPolicy(related_jaccard=0.0))).collect()
    assert {r.component_id[10:]: r.exposure_id[9:] for r in tracked} == expected
    assert len({(r.exposure_id, r.timeline_bucket) for r in tracked}) == len(rows)


def test_lineage_segments_and_cycles(spark):
    day = date(2025, 1, 6)
    edges = spark.createDataFrame([(day, "a", "b", "split"), (day + timedelta(70), "a", "b", "merge"), (day, "a", "x", "split")], "timeline_bucket date, parent_incident_id string, child_incident_id string, relation string")
    segments = spark.createDataFrame([("a", "a1", day, day + timedelta(21)), ("a", "a2", day + timedelta(60), day + timedelta(90)), ("b", "b1", day, day + timedelta(30))], "base_id string, segment_id string, first_week date, last_week date")
    assert [(r.parent_segment_id, r.child_segment_id) for r in tracking.remap_segments(edges, segments).collect()] == [("a1", "b1")]
    graph = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("d", "e")], "p string, c string")
    assert sorted(r.node for r in tracking.cyclic(graph, "p", "c").collect()) == ["b", "c"]
    assert tracking.cyclic(graph.where("p <> 'c'"), "p", "c").collect() == []


def test_lifecycle():
    def run(*weeks):
        life = tracking.Lifecycle(tracking.LifecyclePolicy())
        return [life.advance(k, w) for k, w in enumerate(weeks)], life

    on, off = {"present": True}, {"present": False}
    assert run(on, on, on, off, off)[0] == ["CANDIDATE", "CONFIRMED", "ACTIVE", "PRESSURE_QUIET", "CLOSED_PRESSURE_QUIET_UNCONFIRMED"]
    assert run({"present": True, "severe": 2, "fresh_decline": 1})[0] == ["CONFIRMED"]
    assert run(off, off)[0][-1] == "CLOSED_CANDIDATE_EXPIRED"
    assert run(on, on, off, on, off, {"present": False, "impact": 1}, {"present": False, "recovery": True})[0][2:] == ["PRESSURE_QUIET", "RELAPSED", "PRESSURE_QUIET", "RECOVERING", "CLOSED_RECOVERED"]
    states_, life = run(on, on, off, {"adequate": False}, off)
    assert states_[3] == "PRESSURE_QUIET" and states_[4].startswith("CLOSED") and life.data_gaps == 1 and life.gap_streak == 0
    assert run(on, {"merged": "x"}, on)[0][1:] == ["MERGED_INTO", "MERGED_INTO"]
    assert run(on, on, off, {"present": False, "impact": 2}, {"present": False, "impact": 2})[0][-1] == "CLOSED_RESPONSE_UNRESOLVED"


def test_crosswalk_counts_distinct_field_weeks(spark):
    kind = "incident_id string, timeline_bucket int, field_id string"
    old = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], kind)
    new = spark.createDataFrame([("n", 1, "x"), ("n", 3, "x"), ("m", 9, "q")], kind)
    out = {(r.old_incident_id, r.new_incident_id): r for r in tracking.crosswalk(old, new).collect()}
    assert out["a", "n"].overlap_count == 1 and out["a", "n"].jaccard == pytest.approx(1 / 3) and out["a", "n"].old_coverage == 0.5
    assert out["b", None].match_status == "unmatched_old" and out[None, "m"].match_status == "unmatched_new" and len(out) == 3


def test_unique_join_refuses_repeats(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="repeated key"):
        temporal.unique_join(left, right, ["k"]).collect()


def test_prototypes_refuse_what_is_far(spark):
    rows = [("g", "a", float(i % 3), 0.0) for i in range(30)] + [("g", "b", 20.0 + i % 3, 0.0) for i in range(30)]
    model = prototypes.fit_prototypes(spark.createDataFrame(rows, "g string, l string, x double, y double"), ["x", "y"], ["g"], "l")
    asked = spark.createDataFrame([("g", 1, 1.0, 0.0), ("g", 2, 20.5, 0.0), ("g", 3, 11.0, 0.0), ("other", 4, 1.0, 0.0)], "g string, k int, x double, y double")
    out = {r.k: r.assignment for r in prototypes.assign(asked, model, ["x", "y"], ["g"], "l", ["k"]).collect()}
    assert out == {1: "a", 2: "b", 3: "novel"}


def test_density_clusters_find_groups_and_noise():
    rng = np.random.default_rng(2)
    points = np.vstack([rng.normal(0, 0.1, (40, 2)), rng.normal(5, 0.1, (40, 2)), [[2.5, 2.5], [-9, 9]]])
    labels = prototypes.density_clusters(points, 10, 5)
    assert len(set(labels[:40])) == 1 and len(set(labels[40:80])) == 1 and labels[0] != labels[40] and labels[81] == -1


def test_geometry(spark):
    square = '{"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}'
    wkt = "MULTIPOLYGON (((0 0, 4 0, 4 2, 0 2, 0 0)))"
    df = spark.createDataFrame([("a", square), ("b", wkt)], "f string, g string")
    out = {r.f: r for r in geometry.with_shapes(df, "g").collect()}
    assert (out["a"].centroid_lon, out["a"].centroid_lat) == (1.0, 1.0) and (out["b"].max_lon, out["b"].centroid_lon) == (4.0, 2.0)
    with pytest.raises(ValueError):
        geometry.with_shapes(spark.createDataFrame([("a", "junk")], "f string, g string"), "g")


def test_releases_are_immutable(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    root = str(tmp_path / "release")
    manifest = bundle.publish(spark, root, {"t": df}, {"version": 1})
    assert manifest["tables"]["t"]["rows"] == 2 and bundle.verify(spark, root) == [] and bundle.manifest_of(spark, root) == manifest
    with pytest.raises(FileExistsError):
        bundle.publish(spark, root, {"t": df}, {})


def test_streams_equal_batch(spark, small, tmp_path):
    from echoloom.plans import monitoring
    from echoloom.streaming import live

    batch = monitoring._signals(spark, small).where("crop_season = 'A'").select("field_id", "crop_name", "crop_season", "crop_instance_id", "observation_date", "pressure_observed", "hazard_family", "risk_rank", "response_class", "new_response_evidence", "stage_family")
    for k, (a, b) in enumerate((("2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-15"))):
        batch.where(f"observation_date between '{a}' and '{b}'").coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    batch.where("observation_date = '2024-01-03'").coalesce(1).write.parquet(str(tmp_path / "in/9"))  # comes again, and late
    source = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    query = live.story_stream(source).writeStream.format("memory").queryName("stories").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    rows = spark.table("stories").collect()
    late = sum(r.reportable_day_count for r in rows if r.event_state == "LATE_DAYS")
    assert late == batch.where("observation_date = '2024-01-03'").count()
    got = sorted((r.event_id, str(r.observation_date), r.event_state) for r in rows if r.event_state != "LATE_DAYS")
    expected = stories.daily_stories(batch.withColumn("crop_instance_start_date", F.col("observation_date")))
    assert got == sorted((r.event_id, str(r.observation_date), r.event_state) for r in expected.where("event_state <> 'CLOSED_SEASON_BOUNDARY'").collect()) and got


def story_days(ranks, responses=None, late=None):
    from echoloom.operators import field_stories

    rows = []
    for k, rank in enumerate(ranks):
        day = date(2025, 1, 1) + timedelta(days=k)
        lanes = [{"hazard": "heat", "observed": rank is not None, "rank": rank or 0, "day": day}]
        rows.append(("f", "i", day, lanes, [{"kind": c, "source": day} for c in (responses or {}).get(k, [])]))
    out = field_stories.compose(pd.DataFrame(rows, columns=["field_id", "crop_instance_id", "decision_date", "lanes", "responses"]), field_stories.FieldStoryPolicy())
    return [(r.decision_date.day, r.story_state) for r in out.itertuples()]


def test_field_stories():
    assert story_days([0, 2, 0, 0, 0]) == [(2, "CANDIDATE"), (3, "QUIET_PENDING"), (4, "QUIET_PENDING"), (5, "CLOSED_CANDIDATE_EXPIRED")]
    assert story_days([2, 2, 4]) == [(1, "CANDIDATE"), (2, "ACTIVE"), (3, "SEVERE")]
    assert story_days([3, 3] + [0] * 7)[-1] == (9, "CLOSED_PRESSURE_QUIET_NO_RESPONSE")
    assert story_days([3, 3] + [0] * 6 + [None, 0])[-2:] == [(9, "DATA_GAP"), (10, "CLOSED_PRESSURE_QUIET_NO_RESPONSE")]
    assert story_days([3, 3] + [None] * 7)[-1] == (9, "CLOSED_DATA_CENSORED")
    got = story_days([3, 3] + [0] * 9, {1: ["medium_decline"], 10: ["recovery"]})
    assert got[-2] == (10, "RECOVERING") and got[-1] == (11, "CLOSED_RECOVERED")


def test_field_weeks_and_cells_have_the_gates(spark, small):
    from echoloom.plans import monitoring

    rows = monitoring.significant_cells(spark, small).collect()
    assert rows and all(r.passes_coverage_gate or not r.is_significant for r in rows) and all(r.q_value >= r.p_value - 1e-12 for r in rows)
    assert cells.GridPolicy().km_per_lon == pytest.approx(111.2521857)

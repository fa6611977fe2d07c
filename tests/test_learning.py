"""Learning operators that SQL does not express, on small cases and against brute force."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from echoloom.operators import episodes, learning


def test_calibrated_model_equals_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        label = rng.choice(["a", "b", None])
        at = {"a": 0.0, "b": 4.0, None: rng.choice([2.0, 9.0])}[label]
        rows.append((i, "s", round(at + rng.gauss(0, 0.7), 3), round(rng.gauss(0, 0.7), 3), label, rng.choice(["train", "calibration", "test"])))
    df = spark.createDataFrame(rows, "k int, stratum string, x double, y double, motif string, split string")
    got = {r.motif: r for r in learning.calibrated_model(df, ["x", "y"], ["stratum"], "motif", "split").collect()}
    points = {(lab, sp): np.array([r[2:4] for r in rows if r[4] == lab and r[5] == sp]) for lab in ("a", "b", None) for sp in ("train", "calibration")}
    centres = {lab: np.median(points[lab, "train"], axis=0) for lab in "ab"}
    radii = {}
    for lab in "ab":
        own = np.quantile(np.linalg.norm(points[lab, "calibration"] - centres[lab], axis=1), 0.95)
        strange = np.sort(np.linalg.norm(points[None, "calibration"] - centres[lab], axis=1))
        radii[lab] = min(own, strange[int(0.05 * len(strange))])
        assert got[lab].positive_radius == pytest.approx(own) and got[lab].radius == pytest.approx(radii[lab], rel=1e-9)
    for lab, other in (("a", "b"), ("b", "a")):
        x = points[lab, "calibration"]
        gap = np.linalg.norm(x - centres[other], axis=1) / radii[other] - np.linalg.norm(x - centres[lab], axis=1) / radii[lab]
        assert got[lab].margin == pytest.approx(max(0.0, np.quantile(gap, 0.05)))
    # The budget holds: no more than 5 % of the novel calibration rows are inside a radius.
    judged = learning.open_set(df.drop("motif"), learning.calibrated_model(df, ["x", "y"], ["stratum"], "motif", "split"), ["x", "y"], ["stratum"], "motif", ["k"]).collect()
    status = {r.k: (r.status, r.assigned) for r in judged}
    inside = sum(status[r[0]][0] == "tentative" for r in rows if r[4] is None and r[5] == "calibration")
    assert len(status) == len(rows) and inside <= 2 * 0.05 * len(points[None, "calibration"]) + 1
    held = learning.open_set(df.drop("motif").withColumn("stratum", F.lit("other")), learning.calibrated_model(df, ["x", "y"], ["stratum"], "motif", "split"), ["x", "y"], ["stratum"], "motif", ["k"])
    assert {r.status for r in held.collect()} == {"pending"}


def test_evaluation_and_gates(spark):
    rows = [("w", "a", "a", "tentative"), ("w", "a", "b", "tentative"), ("w", None, "a", "novel"), ("w", "a", None, "tentative"), ("w", None, None, "pending")]
    out = learning.evaluation(spark.createDataFrame(rows, "week string, assigned string, truth string, status string"), "truth", ["week"]).first()
    assert (out.n, out.acceptance, out.precision, out.false_acceptance, out.pending) == (5, 0.6, 0.5, 0.5, 0.2)
    measured = spark.createDataFrame([("w", 0.6, None)], "week string, acceptance double, precision double")
    assert {r.gate: r.passed for r in learning.gates(measured, {"acceptance": (">=", 0.5), "precision": (">=", 0.5)}).collect()} == {"acceptance": True, "precision": False}


def test_discovery_finds_planted_motifs(spark):
    rng = np.random.default_rng(6)
    rows = [(f"k{i}", "s", float(x), float(y)) for i, (x, y) in enumerate(np.vstack([rng.normal(0, 0.2, (60, 2)), rng.normal(6, 0.2, (60, 2)), [[3, 3], [20, 20]]]))]
    df = spark.createDataFrame(rows, "key string, stratum string, x double, y double")
    found = learning.discover(df, ["x", "y"], "stratum", "key", least=20, samples=5)
    labels = {r.key: r.cluster for r in found.collect()}
    assert len({labels[f"k{i}"] for i in range(60)} - {-1}) == 1 and len({labels[f"k{i}"] for i in range(60, 120)} - {-1}) == 1 and labels["k121"] == -1
    model = learning.cluster_model(df, found, ["x", "y"], "stratum", "key").collect()
    assert len(model) == 2 and all(r.radius < 1.0 and r.motif_id.startswith("motif_") for r in model)
    # A stratum of more rows than are clustered: the bound holds, and what is clustered is the same each time.
    assert learning.discover(df, ["x", "y"], "stratum", "key", least=20, samples=5, most=50).count() == 50


def test_eligibility_names_the_first_reason(spark):
    day = date(2025, 1, 6)
    rows = [("a", "CLOSED_RECOVERED", day, day, 4), ("b", "CLOSED_RECOVERED", None, day, 4), ("c", "CLOSED_DATA_CENSORED", day, day, 4), ("d", "MERGED_INTO", day, day, 4), ("e", "ACTIVE", day, day, 4), ("f", "CLOSED_RECOVERED", day, date(2026, 1, 1), 4), ("g", "CLOSED_RECOVERED", day, day, 1)]
    out = learning.eligibility(spark.createDataFrame(rows, "incident_id string, state string, confirmed_week date, last_week date, weeks int"), "2025-06-01")
    assert {r.incident_id: r.eligibility for r in out.collect()} == {"a": "eligible", "b": "never_confirmed", "c": "censored", "d": "merged", "e": "live", "f": "after_cutoff", "g": "too_short"}


# -- episodes --------------------------------------------------------------------------------------


def replayed(spark, pressure, answers=(), policy=episodes.EpisodePolicy(quiet_days=3)):
    """pressure: (day, hazard, rank or None, days late); answers: (source day, kind, days late)."""
    start = date(2025, 1, 1)

    def at(k):
        return start + timedelta(days=k)

    rows = [("f", "i", at(d), at(d + late), h, rank is not None, rank, f"r{d}{h}") for d, h, rank, late in pressure]
    p = spark.createDataFrame(rows, "field_id string, crop_instance_id string, observation_date date, knowledge_time date, hazard_family string, pressure_observed boolean, pressure_rank int, record_id string")
    said = [("f", "i", at(d), at(d + late), kind, True, f"a{d}{kind}") for d, kind, late in answers]
    a = spark.createDataFrame(said, "field_id string, crop_instance_id string, spectral_source_date date, knowledge_time date, response_class string, new_response_evidence boolean, acquisition_id string")
    out = episodes.replay(episodes.gathered_days(p, a), policy).orderBy("decision_date", "hazard_family").collect()
    return [((r.decision_date - start).days, r.hazard_family, r.episode_state) for r in out]


def heat(*ranks):
    return [(d, "heat", rank, 0) for d, rank in enumerate(ranks)]


def test_episodes_open_and_close(spark):
    assert replayed(spark, heat(2, 0, 2)) == [(2, "heat", "WATCH")]
    assert replayed(spark, heat(3, 3, 0, 0, 0)) == [(1, "heat", "ACTIVE"), (2, "heat", "QUIET_PENDING"), (3, "heat", "QUIET_PENDING"), (4, "heat", "CLOSED_PRESSURE_QUIET_UNCONFIRMED")]
    assert replayed(spark, heat(4, 2, 3))[1:] == [(1, "heat", "SEVERE"), (2, "heat", "SEVERE")]
    assert replayed(spark, heat(3, 3, None, 0))[1:] == [(2, "heat", "ACTIVE"), (3, "heat", "QUIET_PENDING")]


def test_episode_responses(spark):
    declined = replayed(spark, heat(3, 3, 0, 0, 0, 0), [(1, "medium_decline", 0), (5, "recovery", 0)])
    assert declined[-2:] == [(4, "heat", "RECOVERING"), (5, "heat", "CLOSED_RECOVERED")]
    # A medium decline alone opens nothing; a recovery needs exactly one unresolved episode.
    assert replayed(spark, heat(0, 0), [(1, "medium_decline", 0)]) == [(1, None, "AMBIGUOUS_DECLINE")]
    both = [(0, "heat", 3, 0), (0, "drought", 3, 0)]
    assert (0, None, "AMBIGUOUS_DECLINE") in replayed(spark, both, [(0, "severe_decline", 0)])
    assert replayed(spark, heat(3, 3), [(1, "recovery", 0)])[-1][1:] in {("heat", "ACTIVE"), (None, "AMBIGUOUS_RECOVERY")}


def test_late_rows_act_when_they_are_known(spark):
    late = [(0, "heat", 3, 0), (1, "heat", 3, 4), (2, "heat", 0, 0)]
    got = replayed(spark, late)
    assert all(day >= 5 for day, _, _ in got)  # the second rank is known on day 5
    early = replayed(spark, [(0, "heat", 3, 0), (1, "heat", 3, 0), (2, "heat", 0, 0)])
    assert early[0][0] == 1


def test_crop_must_be_known(spark):
    day = date(2025, 1, 5)
    days = spark.createDataFrame([("f", "i", day)], "field_id string, crop_instance_id string, decision_date date")
    kind = "field_id string, crop_instance_id string, observation_date date, knowledge_time date, crop_name string"
    crops = spark.createDataFrame([("f", "i", date(2025, 1, 1), date(2025, 1, 1), "old"), ("f", "i", date(2025, 1, 3), date(2025, 1, 4), "new"), ("f", "i", date(2025, 1, 4), date(2025, 1, 9), "late")], kind)
    assert episodes.crop_as_of(days, crops, ["crop_name"]).first().crop_name == "new"
    with pytest.raises(Exception, match="no crop known"):
        episodes.crop_as_of(days, crops.where("crop_name = 'late'"), ["crop_name"]).collect()

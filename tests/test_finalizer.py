"""The finalizer's ownership rules, footprints' boundaries, and checks, on small cases."""

from datetime import date, timedelta

import pytest

from echoloom.operators import checks, finalizer, incident_view
from echoloom.operators.tracking import LifecyclePolicy
from echoloom.sources import assembly

WEEK, MEMBER, EDGE, LATE = range(4)


def note(n, base, kind, key=None, other=None, relation=None, role=None, state=None, down=False, up=False, adequate=True, boundary=False, last=False):
    return ("g", base, date(2025, 1, 6) + timedelta(7 * n), kind, key, other, relation, role, state, down, up, adequate, boundary, last)


def run(notes):
    machine = finalizer.GroupMonitor(LifecyclePolicy())
    out = [r for row in sorted(notes, key=lambda r: (r[2], r[3], r[1], r[4] or "")) for r in machine.day(row)] + machine.end()
    return {(r[0], (r[3] - date(2025, 1, 6)).days // 7): dict(zip(["base", "story", "segment", "week", "state", "members", "core", "unresolved", "recovered", "down", "up", "keys", "merged"], r)) for r in out}


def core(n, base, key, **more):
    return note(n, base, MEMBER, key, role="pressure_core", state="ACTIVE", **more)


def weeks(base, count, **more):
    return [note(n, base, WEEK, last=n == count - 1, **more) for n in range(count)]


def test_a_story_owns_its_impact_until_it_heals():
    out = run(weeks("a", 6) + [core(0, "a", "k", down=True), core(1, "a", "k"), note(4, "a", LATE, "k", up=True)])
    assert [out["a", n]["state"] for n in range(5)] == ["CANDIDATE", "CONFIRMED", "PRESSURE_QUIET", "RECOVERING", "CLOSED_RECOVERED"]
    assert [out["a", n]["unresolved"] for n in range(5)] == [1, 1, 1, 1, 0] and ("a", 5) not in out


def test_decline_and_recovery_in_one_week_stay_unresolved():
    out = run(weeks("a", 3) + [core(0, "a", "k", down=True), core(1, "a", "k", down=True, up=True)])
    assert out["a", 1]["unresolved"] == 1 and out["a", 1]["up"] == 0


def test_only_covered_core_or_impact_starts_a_segment():
    watch = [note(0, "a", MEMBER, "k", role="watch_frontier", state="WATCH")]
    assert run(weeks("a", 2) + watch) == {}
    assert run(weeks("a", 2, adequate=False) + [core(0, "a", "k")]) == {}
    out = run(weeks("a", 9) + [core(0, "a", "k"), core(7, "a", "k")])
    assert out["a", 0]["story"] == "a" and out["a", 7]["story"] != "a" and out["a", 7]["segment"] == 1
    assert out["a", 2]["state"] == "CLOSED_CANDIDATE_EXPIRED" and ("a", 3) not in out


def test_merges_carry_what_is_unresolved_and_splits_follow_the_key():
    both = weeks("a", 4) + weeks("b", 4) + [core(0, "a", "k", down=True), core(0, "b", "j"), core(1, "a", "k"), core(1, "b", "j")]
    out = run(both + [note(2, "a", EDGE, other="b", relation="merge"), core(2, "b", "j")])
    assert out["a", 2]["state"] == "MERGED_INTO" and out["a", 2]["merged"] == "b" and out["b", 2]["keys"] == "k" and ("a", 3) not in out
    out = run(both + [note(2, "a", EDGE, other="b", relation="split"), core(2, "b", "k"), core(2, "a", "x")])
    assert out["a", 2]["keys"] == "" and out["b", 2]["keys"] == "k"
    out = run(both + [note(2, "a", EDGE, other="b", relation="split"), core(2, "b", "j"), core(2, "a", "k")])
    assert out["a", 2]["keys"] == "k" and out["b", 2]["keys"] == ""
    with pytest.raises(ValueError, match="splits and merges"):
        run(both + weeks("c", 4) + [core(0, "c", "z"), note(2, "a", EDGE, other="b", relation="merge"), note(2, "a", EDGE, other="c", relation="split")])


def test_claims_move_ownership_and_must_be_sole():
    start = weeks("a", 4) + weeks("b", 4) + [core(0, "a", "k", down=True), core(0, "b", "j")]
    out = run(start + [core(1, "a", "x"), core(1, "b", "k", down=True)])
    assert out["a", 1]["keys"] == "" and out["b", 1]["keys"] == "k"
    with pytest.raises(ValueError, match="two stories claim"):
        run(start + [core(1, "a", "k", down=True), core(1, "b", "k", down=True)])
    with pytest.raises(ValueError, match="merges away"):
        run(start + [core(1, "a", "k", down=True), note(1, "a", EDGE, other="b", relation="merge")])
    # Late evidence goes to the one who seeded the episode last; nobody's is dropped.
    out = run(start + [core(1, "b", "q"), core(1, "a", "p"), note(2, "a", LATE, "q", down=True), note(2, "a", LATE, "none", down=True)])
    assert out["b", 2]["keys"] == "q" and "none" not in out["a", 2]["keys"]


def test_long_gaps_censor_at_the_end():
    rows = [note(0, "a", WEEK), note(1, "a", WEEK), *[note(n, "a", WEEK, adequate=False, last=n == 5) for n in range(2, 6)]]
    out = run(rows + [core(0, "a", "k"), core(1, "a", "k")])
    assert [out["a", n]["state"] for n in (1, 4, 5)] == ["CONFIRMED", "CONFIRMED", "CLOSED_DATA_CENSORED"]


def test_boundaries_of_footprints():
    def area(ring):
        return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2

    square = incident_view.rings([(0, 0), (1, 0), (0, 1), (1, 1)], 5.0)
    assert square == [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]]
    hollow = incident_view.rings([(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)], 1.0)
    assert sorted(area(r) for r in hollow) == [-1.0, 9.0]
    touching = incident_view.rings([(0, 0), (1, 1)], 1.0)
    assert len(touching) == 2 and sum(map(area, touching)) == 2.0


def test_checks_find_what_is_broken_and_refuse(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, " ")], "k int, v string")
    counted = checks.suite({"repeats": checks.duplicates(rows, ["k"]), "blanks": rows.where(checks.blank(["v"])), "fine": rows.where("k > 9")})
    assert {r.check: r.violations for r in counted.collect()} == {"repeats": 1, "blanks": 1, "fine": 0}
    with pytest.raises(ValueError, match="blanks: 1; repeats: 1"):
        checks.demand(counted)
    checks.demand(counted.where("violations = 0"))
    claims = spark.createDataFrame([("the crop is DEAD",), ("deadline met",), ("total loss of leaves",)], "t string")
    assert checks.death_claims(claims, ["t"]).count() == 2


def test_parts_come_together_and_apart(spark, tmp_path):
    df = spark.createDataFrame([(i % 7, i, f"v{i}") for i in range(40)], "k int, n int, v string")
    assembly.write_partitioned(df, str(tmp_path / "p"), "k", 4, ["n"])
    again = spark.read.parquet(str(tmp_path / "p"))
    assert again.count() == 40 and again.groupBy("k").agg({"part": "min"}).join(again.groupBy("k").agg({"part": "max"}), "k").where("`min(part)` <> `max(part)`").count() == 0
    df.where("n < 20").drop("v").write.parquet(str(tmp_path / "a"))
    df.where("n >= 20").write.parquet(str(tmp_path / "b"))
    both = assembly.read_parts(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert both.count() == 40 and both.where("v is null").count() == 20
    with pytest.raises(ValueError, match="no column for x"):
        assembly.renamed(df, {"x": ["y"]}, ["x"])


def test_requests_are_checked():
    from echoloom.operators import serving

    assert serving.checked_box("1,2,3,4") == serving.Box(1.0, 2.0, 3.0, 4.0) and serving.checked_ids([" a", "b", "a"]) == ["a", "b"]
    for text in ("1,2,3", "3,2,1,4", "1,2,nan,4", "1,2,3,400", "x"):
        with pytest.raises(ValueError):
            serving.checked_box(text)
    for ids in ([], [" "], [str(i) for i in range(2001)]):
        with pytest.raises(ValueError):
            serving.checked_ids(ids)
    for limit in (0, True, 20001, 1.5):
        with pytest.raises(ValueError):
            serving.checked_limit(limit)

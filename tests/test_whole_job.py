"""Queries that must cover every row of their tables, against brute force in Python."""

import hashlib
import json
from collections import Counter
from datetime import date, timedelta

from echoloom.operators import cells
from echoloom.plans import monitoring, relational


def orders_of(spark, small):
    return spark.read.parquet(f"{small}/orders.parquet").collect()


def test_scalar_functions_give_every_order_its_row(spark, small):
    got = relational.scalar_functions(spark, small).collect()
    want = {}
    for o in orders_of(spark, small):
        day = o.o_orderdate.date()
        stable = hashlib.sha256("\x1f".join((str(o.o_orderkey), o.o_orderstatus, str(day))).encode()).hexdigest()[:24]
        record = hashlib.md5(str(o.o_orderkey).encode()).hexdigest()
        want[o.o_orderkey] = (f"order_{stable}", record, day - timedelta(day.weekday()), day.isocalendar().week, (date(1999, 1, 1) - day).days)
    assert len(got) == len(want)
    assert {r.o_orderkey: (r.stable, r.record, r.monday, r.iso_week, r.age) for r in got} == want


def test_asof_order_looks_up_every_order(spark, small):
    orders = [(o.o_custkey, o.o_orderdate.date(), o.o_orderkey) for o in orders_of(spark, small)]
    want = []
    for cust, day, key in orders:
        at = day + timedelta(30)
        want.append((cust, at, key, *max((d, k) for c, d, k in orders if c == cust and d <= at)))
    got = relational.asof_order(spark, small).select("cust", "at", "probe_key", "day", "last_key").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def significant(spark, small):
    """The significant cells of each week and hazard."""
    found = {}
    for r in monitoring.significant_cells(spark, small).where("is_significant").collect():
        found.setdefault((r.timeline_bucket, r.hazard_family), set()).add((r.cell_x, r.cell_y))
    assert found
    return found


def components_of(places):
    """8-neighbour components by merging sets until none touch."""
    groups = [{p} for p in places]
    for a in sorted(places):
        near = [g for g in groups if any(max(abs(a[0] - x), abs(a[1] - y)) <= 1 for x, y in g)]
        groups = [g for g in groups if g not in near] + [set().union(*near)]
    return groups


def test_components_are_of_significant_cells(spark, small):
    want = sorted((week, hazard, sorted(f"g:{x}:{y}" for x, y in group)) for (week, hazard), places in significant(spark, small).items() for group in components_of(places))
    got = sorted((r.timeline_bucket, r.hazard_family, sorted(json.loads(r.cell_ids_json))) for r in monitoring.weekly_components(spark, small).collect())
    assert got == want


def test_frontier_is_beside_significant_cells(spark, small):
    found = significant(spark, small)
    context, lanes = monitoring._parts(spark, small)
    at = {(r.timeline_bucket, r.crop_instance_id): (r.cell_x, r.cell_y) for r in cells.on_grid(context, monitoring.GRID).collect()}
    want = Counter()
    for r in lanes.where("canonical").collect():
        place = at.get((r.timeline_bucket, r.crop_instance_id))
        if place and any(max(abs(place[0] - x), abs(place[1] - y)) <= 1 for x, y in found.get((r.timeline_bucket, r.hazard_family), ())):
            want[r.timeline_bucket, r.hazard_family, *place, r.field_id, r.event_state] += 1
    got = monitoring.frontier_rows(spark, small).select("timeline_bucket", "hazard_family", "cell_x", "cell_y", "field_id", "event_state").collect()
    assert want and Counter(map(tuple, got)) == want

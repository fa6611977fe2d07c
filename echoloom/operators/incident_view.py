"""What a viewer shows of incidents: footprints, frames, checkpoints, reconciliation, spines, masked previews."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORE = ("ACTIVE", "SEVERE")


def rings(cells: list[tuple[int, int]], size: float) -> list[list[tuple[float, float]]]:
    """The boundary of a set of grid cells, as closed rings of corners; outer ones run left-handed, holes the other way.

    An edge that two cells share cancels; the others are walked, turning left where two rings touch.
    """
    edges: dict[tuple, list] = {}
    have = set(cells)
    for x, y in sorted(have):
        for (a, b), beside in ((((x, y), (x + 1, y)), (x, y - 1)), (((x + 1, y), (x + 1, y + 1)), (x + 1, y)), (((x + 1, y + 1), (x, y + 1)), (x, y + 1)), (((x, y + 1), (x, y)), (x - 1, y))):
            if beside not in have:
                edges.setdefault(a, []).append(b)
    out = []
    while edges:
        start = min(edges)
        ring, at, way = [start], start, None
        while True:
            onward = edges[at]
            if way is not None and len(onward) > 1:
                onward.sort(key=lambda p: way[1] * (p[0] - at[0]) - way[0] * (p[1] - at[1]))  # a left turn first: rings that touch stay two
            to = onward.pop(0)
            if not onward:
                del edges[at]
            way, at = (to[0] - at[0], to[1] - at[1]), to
            if at == start:
                break
            ring.append(at)
        corners = [p for i, p in enumerate(ring) if (ring[i - 1][0] - p[0]) * (ring[(i + 1) % len(ring)][1] - p[1]) != (ring[i - 1][1] - p[1]) * (ring[(i + 1) % len(ring)][0] - p[0])]
        out.append([(x * size, y * size) for x, y in [*corners, corners[0]]])
    return out


def footprints(members: DataFrame, size_km: float) -> DataFrame:
    """(incident_id, timeline_bucket, role, cells, area_km2, coincident, boundary) from members with their cell.

    `role` is core, watch or combined.  Incidents of one week and role with the same cells are coincident.
    The boundary is GeoJSON in grid kilometres, made of the (few) cells of one footprint at a time.
    """
    role = F.when(F.col("event_state").isin(*CORE), "core").otherwise("watch")
    cell = F.struct("cell_x", "cell_y")
    both = members.select("incident_id", "timeline_bucket", F.explode(F.array(role, F.lit("combined"))).alias("role"), cell.alias("cell"))
    prints = both.groupBy("incident_id", "timeline_bucket", "role").agg(F.sort_array(F.collect_set("cell")).alias("cells"))
    key = F.to_json("cells")
    same = Window.partitionBy("timeline_bucket", "role", "_key")
    prints = prints.withColumn("_key", key).withColumn("coincident", F.count("*").over(same) > 1)
    prints = prints.select("incident_id", "timeline_bucket", "role", "cells", (F.size("cells") * size_km * size_km).alias("area_km2"), "coincident")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = [json.dumps({"type": "MultiLineString", "coordinates": rings([(c["cell_x"], c["cell_y"]) for c in cells], size_km)}) for cells in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shapes, pa.string())], names=[*batch.schema.names, "boundary"])

    return prints.mapInArrow(run, StructType([*prints.schema.fields, StructField("boundary", StringType())]))


def frame_fields(members: DataFrame, weekly: DataFrame, context: DataFrame) -> DataFrame:
    """Members with their incident's week and their own field week; a field without context stays."""
    seen = context.select("timeline_bucket", "crop_instance_id", "stage_bucket", "evaluable")
    return members.join(weekly, ["incident_id", "timeline_bucket"]).join(seen, ["timeline_bucket", "crop_instance_id"], "left").withColumn("evaluable", F.coalesce("evaluable", F.lit(False)))


def story_days(members: DataFrame, days: DataFrame) -> DataFrame:
    """Each member's days within its weeks: an equality on the days' Monday."""
    dated = days.withColumn("timeline_bucket", F.date_trunc("week", "observation_date").cast("date"))
    return members.select("incident_id", "timeline_bucket", "crop_instance_id").distinct().join(dated, ["timeline_bucket", "crop_instance_id"])


def late_pressure(pressure: DataFrame) -> DataFrame:
    """Pressure that became known after its day, and how late."""
    return pressure.withColumn("days_late", F.date_diff("knowledge_time", "observation_date")).where("days_late > 0")


def acquisition_marks(acquisitions: DataFrame) -> DataFrame:
    """What to draw for an acquisition: an update, a look without change, or an attempt and why it failed."""
    mark = F.when(F.col("status") != "usable", "attempt").when(F.col("response_class").isin("medium_decline", "severe_decline", "recovery"), "update").otherwise("look")
    return acquisitions.withColumns({"mark": mark, "why": F.when(F.col("status") != "usable", F.regexp_replace("status", "^rejected_", ""))})


def checkpoints(weekly: DataFrame, members: DataFrame, pressure: DataFrame, acquisitions: DataFrame) -> DataFrame:
    """Each incident week with how far its evidence is known and whether it is complete.

    A week's bound is the latest knowledge of any row of its members in it, and no earlier than its
    Sunday; it is complete if every member has pressure in the week.
    """
    week = F.date_trunc("week", F.col("observation_date")).cast("date")
    lanes = pressure.groupBy("crop_instance_id", week.alias("timeline_bucket")).agg(F.max(F.to_date("knowledge_time")).alias("lane_known"), F.bool_or("pressure_observed").alias("seen"))
    looks = acquisitions.groupBy("crop_instance_id", F.date_trunc("week", F.col("spectral_source_date")).cast("date").alias("timeline_bucket")).agg(F.max(F.to_date("knowledge_time")).alias("look_known"), F.count_if("new_response_evidence").alias("responses"))
    own = members.join(lanes, ["crop_instance_id", "timeline_bucket"], "left").join(looks, ["crop_instance_id", "timeline_bucket"], "left")
    bound = own.groupBy("incident_id", "timeline_bucket").agg(
        F.max("lane_known").alias("lane_known"), F.max("look_known").alias("look_known"), F.bool_and(F.coalesce("seen", F.lit(False))).alias("complete"), F.sum(F.coalesce("responses", F.lit(0))).alias("responses"), F.countDistinct("field_id").alias("member_fields"))
    out = weekly.join(bound, ["incident_id", "timeline_bucket"], "left")
    return out.withColumn("known_through", F.greatest(F.date_add("timeline_bucket", 6), "lane_known", "look_known"))


def reconciliation(weekly: DataFrame, members: DataFrame) -> DataFrame:
    """Each incident week's counters against its members, the claims that nothing supports, and the reasons together."""
    def some(condition: Column) -> Column:
        return F.countDistinct(F.when(condition, F.col("field_id")))

    state = F.col("event_state")
    found = members.groupBy("incident_id", "timeline_bucket").agg(F.countDistinct("field_id").alias("m_affected"), some(state == "ACTIVE").alias("m_active"), some(state == "SEVERE").alias("m_severe"), some(F.col("fresh")).alias("m_fresh"))
    rows = weekly.join(found, ["incident_id", "timeline_bucket"], "left").fillna(0, ["m_affected", "m_active", "m_severe", "m_fresh"])
    reasons = [F.when(F.col(c) != F.col(f"m_{c}"), f"{c}_mismatch") for c in ("affected", "active", "severe")]
    reasons += [F.when((F.col("claim") == "severe_impact") & (F.col("m_severe") == 0), "severity_unsupported"), F.when((F.col("claim") == "fresh_impact") & (F.col("m_fresh") == 0), "impact_unsupported")]
    support = F.when((F.col("m_active") + F.col("m_severe")) > 0, "pressure").when(F.col("m_affected") > 0, "watch_only").otherwise("quiet")
    rows = rows.withColumn("reasons", F.concat_ws("+", *reasons))
    return rows.withColumns({"support": support, "contradicted": F.col("reasons") != ""})


def spine(weekly: DataFrame, rows: DataFrame) -> DataFrame:
    """Every day from an incident's first week to its last, with its week's counters and the day's own; days without evidence stay.

    `covered` says whether the week has rows of the incident at all.
    """
    span = weekly.groupBy("incident_id").agg(F.min("timeline_bucket").alias("a"), F.date_add(F.max("timeline_bucket"), 6).alias("b"))
    days = span.select("incident_id", F.explode(F.sequence("a", "b")).alias("day")).withColumn("timeline_bucket", F.date_trunc("week", "day").cast("date"))
    own = rows.groupBy("incident_id", F.col("observation_date").alias("day")).agg(F.countDistinct("crop_instance_id").alias("day_members"), F.count_if("pressure_observed").alias("day_observed"))
    out = days.join(weekly.select("incident_id", "timeline_bucket", "affected"), ["incident_id", "timeline_bucket"], "left").join(own, ["incident_id", "day"], "left")
    return out.withColumn("covered", F.col("affected").isNotNull()).fillna(0, ["affected", "day_members", "day_observed"])


def preview(labels: DataFrame, anchors: DataFrame, day: str) -> DataFrame:
    """Labels as a viewer may see them on a day: none before the anchor, none for calibration rows."""
    at = F.lit(day).cast("date")
    out = labels.join(anchors.select("event_id", "anchor_date", "outcome"), "event_id", "left")
    mask = F.when(F.col("split") == "calibration", "held_back").when(F.coalesce(F.col("outcome") != "eligible", F.lit(True)), "not_eligible").when(F.col("anchor_date") > at, "before_anchor")
    return out.withColumns({"mask": mask, "shown_label": F.when(mask.isNull(), F.col("label"))})


def export(members: DataFrame, weekly: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their week's counters and their field's label: what a motif viewer loads, one row a member week."""
    return members.join(weekly, ["incident_id", "timeline_bucket"]).join(labels, "crop_instance_id", "left").withColumn("label", F.coalesce("label", F.lit("unlabelled")))


def drilldown(weekly: DataFrame, members: DataFrame, days: DataFrame) -> DataFrame:
    """An incident's weeks with its members' pressure and responses in them, and its place in the incident's life."""
    evidence = story_days(members, days).groupBy("incident_id", "timeline_bucket").agg(
        F.count_if("pressure_observed").alias("observed_days"), F.max("risk_rank").alias("peak_rank"), F.count_if(F.col("response_class").isin("medium_decline", "severe_decline")).alias("declines"), F.count_if(F.col("response_class") == "recovery").alias("recoveries"))
    order = Window.partitionBy("incident_id").orderBy("timeline_bucket")
    out = weekly.join(evidence, ["incident_id", "timeline_bucket"], "left").fillna(0, ["observed_days", "peak_rank", "declines", "recoveries"])
    return out.withColumns({"week_number": F.row_number().over(order), "gap_weeks": F.coalesce(F.date_diff("timeline_bucket", F.lag("timeline_bucket").over(order)) / 7 - 1, F.lit(0.0)).cast("int")})


def stage_rates(weekly: DataFrame, members: DataFrame, context: DataFrame) -> DataFrame:
    """(incident_id, timeline_bucket, stage_bucket, affected, evaluable, rate) over an incident's own cells.

    The denominator counts every evaluable instance in a cell of the incident that week, by stage; a cell
    without any is counted as missing.
    """
    cells = members.select("incident_id", "timeline_bucket", "cell_x", "cell_y").distinct()
    here = cells.join(context, ["timeline_bucket", "cell_x", "cell_y"], "left")
    below = here.groupBy("incident_id", "timeline_bucket", "stage_bucket").agg(F.countDistinct(F.when(F.col("evaluable"), F.col("crop_instance_id"))).alias("evaluable_instances"))
    above = members.join(context.select("timeline_bucket", "crop_instance_id", "stage_bucket"), ["timeline_bucket", "crop_instance_id"]).groupBy("incident_id", "timeline_bucket", "stage_bucket").agg(F.countDistinct("crop_instance_id").alias("affected_instances"))
    missing = here.groupBy("incident_id", "timeline_bucket", "cell_x", "cell_y").agg(F.max(F.col("evaluable").cast("int")).alias("any")).groupBy("incident_id", "timeline_bucket").agg(F.count_if(F.coalesce("any", F.lit(0)) == 0).alias("missing_cells"))
    out = below.join(above, ["incident_id", "timeline_bucket", "stage_bucket"], "left").fillna(0, ["affected_instances"]).join(missing, ["incident_id", "timeline_bucket"])
    return out.withColumn("rate", F.coalesce(F.try_divide("affected_instances", "evaluable_instances"), F.lit(0.0)))


def with_totals(weekly: DataFrame, rates: DataFrame) -> DataFrame:
    """Weeks with the totals of their stage rates, and whether their coverage is adequate: no missing cell and some instance."""
    totals = rates.groupBy("incident_id", "timeline_bucket").agg(F.sum("evaluable_instances").alias("evaluable_total"), F.sum("affected_instances").alias("affected_total"), F.max("missing_cells").alias("missing_cells"))
    out = weekly.join(totals, ["incident_id", "timeline_bucket"], "left").fillna(0, ["evaluable_total", "affected_total"])
    return out.withColumn("adequate", F.coalesce((F.col("missing_cells") == 0) & (F.col("evaluable_total") >= 1), F.lit(False)))

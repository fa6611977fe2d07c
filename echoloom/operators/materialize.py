"""Viewer artifacts: grids, stage summaries, labels, counters and knowledge bounds, as windows and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.operators import temporal


def modal(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key, of equals the first by name."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    return temporal.latest(counts, keys, [F.desc("__n"), F.asc(value)]).drop("__n")


def degree_grid(size: float = 0.05, lon: float = 28.0, lat: float = -4.0) -> dict:
    return {"grid_x": F.floor((F.col("centroid_lon") - lon) / size), "grid_y": F.floor((F.col("centroid_lat") - lat) / size)}


def field_grid(days: DataFrame, centroids: DataFrame) -> DataFrame:
    """A day's cells: fields, how many are observed and pressed, the peak, the modal crop and stage."""
    rows = days.join(centroids, "field_id").withColumns(degree_grid())
    keys = ["observation_date", "grid_x", "grid_y"]
    best = temporal.latest(rows, [*keys, "field_id"], [F.desc("risk_rank"), F.asc("crop_instance_id")])
    out = best.groupBy(*keys).agg(
        F.count("*").alias("field_count"), F.count_if("pressure_observed").alias("observed_count"), F.count_if(F.col("risk_rank") >= 2).alias("pressed_count"), F.max("risk_rank").alias("peak_rank")
    )
    return out.join(modal(best, keys, "crop_name"), keys).join(modal(best, keys, "stage_family"), keys)


def pressure_grid(pressure: DataFrame, centroids: DataFrame) -> DataFrame:
    """As field_grid, for each hazard, over the pressure ledger."""
    rows = pressure.join(centroids, "field_id").withColumns(degree_grid())
    return rows.groupBy("observation_date", "hazard_family", "grid_x", "grid_y").agg(
        F.countDistinct("field_id").alias("field_count"), F.countDistinct(F.when(F.col("pressure_active"), F.col("field_id"))).alias("active_count"),
        F.count_if(~F.col("pressure_observed")).alias("unobserved_count"), F.max("pressure_rank").alias("peak_rank"),
    )


def stage_summary(cells: DataFrame, context: DataFrame, lanes: DataFrame) -> DataFrame:
    """Numerators and denominators by crop and stage over each component's cells, and cells without any field."""
    keys = ["timeline_bucket", "hazard_family", "component_id"]
    where = ["timeline_bucket", "cell_x", "cell_y"]
    joined = cells.join(context, where, "left").join(lanes.select("timeline_bucket", "hazard_family", "crop_instance_id", "event_state"), ["timeline_bucket", "hazard_family", "crop_instance_id"], "left")
    pressed = F.col("event_state").isin("ACTIVE", "SEVERE")
    return joined.groupBy(*keys, "crop_name", "stage_bucket").agg(
        F.countDistinct("crop_instance_id").alias("monitored"), F.countDistinct(F.when(F.col("evaluable"), F.col("crop_instance_id"))).alias("evaluable"),
        F.countDistinct(F.when(pressed, F.col("crop_instance_id"))).alias("affected"), F.count_if(F.col("field_id").isNull()).alias("missing_cells"),
    ).withColumn("rate", F.round(F.try_divide("affected", "evaluable"), 9))


def cluster_labels(rows: DataFrame, key: str) -> DataFrame:
    """Medians and the modal band of a cluster's members."""
    out = rows.groupBy(key).agg(
        F.count("*").alias("member_days"), F.countDistinct("field_id").alias("fields"), F.round(F.median("ndvi"), 9).alias("median_ndvi"), F.round(F.percentile("psri", F.lit(0.9)), 9).alias("p90_psri"), F.max("risk_rank").alias("peak_rank")
    )
    return out.join(modal(rows, [key], "risk_band"), key)


def counter_mismatches(weekly: DataFrame, members: DataFrame, keys: list[str], counters: dict[str, str]) -> DataFrame:
    """Weeks whose stated counters differ from the distinct members counted anew."""
    counted = members.groupBy(*keys).agg(*[F.countDistinct(F.when(F.expr(condition), F.col("field_id"))).alias(f"{name}_counted") for name, condition in counters.items()])
    joined = weekly.join(counted, keys, "full")
    wrong = F.lit(False)
    for name in counters:
        wrong = wrong | ~F.coalesce(F.col(name), F.lit(0)).eqNullSafe(F.coalesce(F.col(f"{name}_counted"), F.lit(0)))
    return joined.where(wrong)


def knowledge_bounds(weeks: DataFrame, ledgers: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """When a week's row could be known at the earliest: the latest of what it rests on, aggregated once for each ledger."""
    out = weeks
    for name, ledger in ledgers.items():
        out = out.join(ledger.groupBy(*keys).agg(F.max("knowledge_time").alias(f"{name}_known")), keys, "left")
    week_end = F.date_add("timeline_bucket", 6)
    return out.withColumn("knowledge_time", F.greatest(week_end, *[F.coalesce(F.col(f"{name}_known"), week_end) for name in ledgers]))

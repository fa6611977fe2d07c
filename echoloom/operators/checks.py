"""Release checks: each is the rows that should not be; a suite counts them side by side, and may refuse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echoloom.operators.temporal import duplicates

#: Words that no text of a release may claim.
DEATH_CLAIMS = r"(?i)\b(dead|death|died|dying|killed|total loss|crop loss)\b"


def suite(offences: Mapping[str, DataFrame]) -> DataFrame:
    """(check, violations) of all checks; one row each, none of them collected."""
    out = None
    for name, rows in offences.items():
        one = rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
        out = one if out is None else out.union(one)
    return out


def demand(counted: DataFrame) -> None:
    """Refuses a release with any violation, naming the checks."""
    broken = [f"{r['check']}: {r['violations']}" for r in counted.where("violations > 0").collect()]  # a row a check
    if broken:
        raise ValueError("; ".join(sorted(broken)))


def blank(columns: Sequence[str]) -> Column:
    """Any of the columns null or without a character."""
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    return out


def orphans(rows: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(parents.select(*keys).distinct(), list(keys), "left_anti")


def evidence_checks(crops: DataFrame, pressure: DataFrame, acquisitions: DataFrame, release: str) -> dict[str, DataFrame]:
    """Keys once and filled; nothing known after the release or before it happened; references earlier and usable; quality kept."""
    day = F.lit(release).cast("date")
    usable = acquisitions.where("status = 'usable'").select("field_id", "crop_instance_id", F.col("spectral_source_date").alias("reference_source_date"))
    with_reference = acquisitions.where("reference_source_date is not null")
    return {
        "crop_keys_repeat": duplicates(crops, ["field_id", "crop_instance_id", "observation_date"]), "pressure_keys_repeat": duplicates(pressure, ["field_id", "crop_instance_id", "observation_date", "hazard_family"]),
        "acquisition_ids_repeat": duplicates(acquisitions, ["acquisition_id"]), "blank_keys": crops.where(blank(["field_id", "crop_instance_id", "record_id"])).select("field_id"),
        "pressure_known_after_release": pressure.where(F.to_date("knowledge_time") > day), "acquisitions_known_after_release": acquisitions.where(F.to_date("knowledge_time") > day),
        "acquisitions_known_before_source": acquisitions.where(F.to_date("knowledge_time") < F.col("spectral_source_date")), "crops_known_before_day": crops.where(F.to_date("knowledge_time") < F.col("observation_date")),
        "rank_without_observation": pressure.where("pressure_rank is not null and not pressure_observed"), "observed_without_rank": pressure.where("pressure_observed and pressure_rank is null"),
        "reference_not_earlier": with_reference.where("reference_source_date >= spectral_source_date"), "reference_not_usable": orphans(with_reference, usable, ["field_id", "crop_instance_id", "reference_source_date"]),
        "evidence_of_rejected": acquisitions.where("new_response_evidence and status <> 'usable'"), "response_of_rejected": acquisitions.where("status <> 'usable' and response_class <> 'not_evaluable'"),
        "missing_reason_kept": crops.where(F.col("crop_context_observed") == F.col("missing_reason").isNotNull()),
    }


def coverage_checks(context: DataFrame, least_centroids: float = 0.95, least_stages: float = 0.8, least_by_crop: float = 0.7, from_weeks: int = 100) -> dict[str, DataFrame]:
    """Shares of field weeks that have a place and a known stage, over all and for each crop of enough weeks."""
    placed = F.avg(F.col("centroid_lon").between(-180, 180).cast("int") * F.col("centroid_lat").between(-90, 90).cast("int"))
    known = F.avg(F.coalesce(F.col("stage_bucket") != "unknown", F.lit(False)).cast("int"))
    whole = context.agg(F.coalesce(placed, F.lit(0.0)).alias("placed"), F.coalesce(known, F.lit(0.0)).alias("known"))
    crops = context.groupBy("crop_name").agg(known.alias("known"), F.count("*").alias("n"))
    return {"centroid_coverage": whole.where(F.col("placed") < least_centroids), "stage_coverage": whole.where(F.col("known") < least_stages), "stage_coverage_of_crop": crops.where((F.col("n") >= from_weeks) & (F.col("known") < least_by_crop))}


def unsupported_hazards(lanes: DataFrame, baseline: DataFrame, through: str) -> DataFrame:
    """Hazards of canonical lanes after the baseline's end that it does not have."""
    later = lanes.where(F.col("canonical") & (F.date_add("timeline_bucket", 6) > F.lit(through).cast("date"))).select("hazard_family")
    return later.subtract(baseline.select("hazard_family"))


def tracking_checks(components: DataFrame, members: DataFrame, assigned: DataFrame, incidents: DataFrame) -> dict[str, DataFrame]:
    """Every reference is closed: members and assignments have components, incidents exposures; nothing stands twice."""
    return {
        "components_repeat": duplicates(components, ["component_id"]), "members_without_component": orphans(members, components, ["component_id"]), "assignments_without_component": orphans(assigned, components, ["component_id"]),
        "components_without_assignment": orphans(components, assigned, ["component_id"]), "exposures_twice_a_week": duplicates(assigned, ["exposure_id", "timeline_bucket"]), "field_twice_a_week": duplicates(members, ["timeline_bucket", "hazard_family", "field_id"]),
        "incidents_without_exposure": orphans(incidents, assigned, ["exposure_id"]), "incidents_repeat": duplicates(incidents, ["incident_id"]), "incident_weeks_reversed": incidents.where("last_week < first_week"),
    }


def death_claims(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose texts claim more than monitoring can know."""
    return rows.where(F.concat_ws(" ", *columns).rlike(DEATH_CLAIMS))


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of a row as JSON of its sorted columns; nulls are written, so that they differ from blanks."""
    return F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


def rewritten_weeks(old: DataFrame, new: DataFrame, keys: Sequence[str], state: str) -> DataFrame:
    """What a new release did to the weeks of an old one: (keys, status).

    Only the last week's closing for want of data may be opened again; a row that is new within the old
    weeks was slipped into history.
    """
    columns = [c for c in old.columns if c not in keys]
    a = old.select(*keys, row_digest(columns).alias("_old"), F.col(state).alias("_was"))
    b = new.select(*keys, row_digest(columns).alias("_new"), F.col(state).alias("_is"))
    last = old.agg(F.max("timeline_bucket").alias("_last"))
    both = a.join(b, list(keys), "full").crossJoin(F.broadcast(last))  # one row
    reopened = (F.col("_was") == "CLOSED_DATA_CENSORED") & (F.col("timeline_bucket") == F.col("_last")) & ~F.col("_is").startswith("CLOSED_")
    status = F.when(F.col("_new").isNull(), "removed").when(F.col("_old").isNull(), F.when(F.col("timeline_bucket") <= F.col("_last"), "slipped_in")).when(F.col("_new") != F.col("_old"), F.when(reopened, "reopened").otherwise("rewritten"))
    return both.withColumn("status", status).where("status is not null").select(*keys, "status")


def reconciled(candidates: DataFrame, published: DataFrame) -> DataFrame:
    """Acquisitions before and after ownership, by where they come from; `balanced` says that none is lost.

    Both have field_id, spectral_source_date and origin (derived, external or both).
    """
    keys = ["field_id", "spectral_source_date"]
    counted = candidates.groupBy("origin").agg(F.count("*").alias("candidates"))
    out = candidates.join(published.select(*keys).distinct(), keys, "left_anti").groupBy("origin").agg(F.count("*").alias("excluded"))
    kept = published.groupBy("origin").agg(F.count("*").alias("published"))
    rows = counted.join(kept, "origin", "full").join(out, "origin", "full").fillna(0, ["candidates", "published", "excluded"])
    return rows.withColumn("balanced", F.col("candidates") == F.col("published") + F.col("excluded"))


def diagnosed(claims: DataFrame, rules: Sequence[tuple[str, Column]], otherwise: str = "unclassified") -> DataFrame:
    """Claims with the first diagnosis whose condition holds, and how many have it."""
    ladder = F.lit(otherwise)
    for name, condition in reversed(rules):
        ladder = F.when(condition, F.lit(name)).otherwise(ladder)
    return claims.withColumn("diagnosis", ladder).withColumn("same", F.count("*").over(Window.partitionBy("diagnosis")))

"""Requests of a map reader as operators: checked boxes and ids, facets, frames, centres, trails, checkpoints."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echoloom.operators.temporal import latest

EARTH_KM = 6371.0088
#: How many geometries, and rows, a request may ask for.
MOST_GEOMETRIES, MOST_ROWS = 2000, 20000


class Box(NamedTuple):
    west: float
    south: float
    east: float
    north: float


def checked_box(text: str) -> Box:
    """"west,south,east,north" in degrees; anything else is refused."""
    try:
        box = Box(*(float(x) for x in text.split(",")))
    except (TypeError, ValueError):
        raise ValueError(f"a box is four numbers: {text!r}") from None
    if not all(map(math.isfinite, box)) or not (-180 <= box.west <= box.east <= 180 and -90 <= box.south <= box.north <= 90):
        raise ValueError(f"not a box on the globe: {text!r}")
    return box


def checked_ids(ids: Iterable[str], most: int = MOST_GEOMETRIES) -> list[str]:
    """Different, non-blank ids in the order asked for."""
    out = list(dict.fromkeys(str(i).strip() for i in ids))
    if not out or "" in out or len(out) > most:
        raise ValueError(f"ask for 1 to {most} ids")
    return out


def checked_limit(limit: int, most: int = MOST_ROWS) -> int:
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= most:
        raise ValueError(f"a limit is 1 to {most}")
    return limit


def checked_day(text: str) -> date:
    return date.fromisoformat(text)


def overlaps(box: Box) -> Column:
    """Rows (min_lon, min_lat, max_lon, max_lat) that touch the box: four ranges, pushed to the scan."""
    return (F.col("max_lon") >= box.west) & (F.col("min_lon") <= box.east) & (F.col("max_lat") >= box.south) & (F.col("min_lat") <= box.north)


def with_facets(rows: DataFrame, wanted: Mapping[str, object], allowed: Sequence[str]) -> DataFrame:
    """Rows equal in all wanted facets, which must be among the allowed columns."""
    for name, value in wanted.items():
        if name not in allowed:
            raise ValueError(f"not a facet: {name}")
        rows = rows.where(F.col(name) == F.lit(value))
    return rows


def asked_for(rows: DataFrame, ids: Iterable[str], column: str) -> DataFrame:
    """The rows of a checked list of ids, each with its place in the list; ids without a row are left out."""
    listed = checked_ids(ids)
    spark = rows.sparkSession
    asked = spark.range(1).select(F.posexplode(F.array(*[F.lit(i) for i in listed])).alias("place", column))
    return rows.join(F.broadcast(asked), column)  # at most MOST_GEOMETRIES rows


def frame(rows: DataFrame, geometry: DataFrame, box: Box, order: Sequence[Column], facets: Mapping[str, object], allowed: Sequence[str]) -> DataFrame:
    """One canonical row for each week and field in the box, with the week's total over all that fit the facets.

    `geometry` is joined by field, after its box has been cut at the scan.
    """
    best = latest(with_facets(rows, facets, allowed), ["timeline_bucket", "field_id"], order)
    totals = best.groupBy("timeline_bucket").agg(F.count("*").alias("total_fields"))
    return best.join(geometry.where(overlaps(box)), "field_id").join(totals, "timeline_bucket")


def facet_counts(rows: DataFrame, facets: Sequence[str]) -> DataFrame:
    """(facet, value, n) of several columns in one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in facets])
    return rows.select(F.explode(cells).alias("x")).groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


def shares(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n, share): the distribution of a category within each group."""
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))


def share_json(distribution: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The distribution of each group as JSON, by category name, with six places."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(value).alias("key"), F.format_string("%.6f", F.col("share")).alias("value"))))
    return distribution.groupBy(*keys).agg(F.to_json(F.map_from_entries(entries)).alias("distribution"))


def normalized_entropy(distribution: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entropy of the shares divided by that of as many equal ones; a sole category has none."""
    p = F.col("share")
    total = -F.sum(F.when(p > 0, p * F.log(p)).otherwise(0.0))
    return distribution.groupBy(*keys).agg(F.when(F.count("*") > 1, total / F.log(F.count("*").cast("double"))).otherwise(0.0).alias("entropy"), F.count("*").alias("categories"))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    inner = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(inner, F.lit(1.0))))


def spherical_centres(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, center_lon, center_lat, p50_km, p90_km, n): the mean direction of points, and how far they lie from it."""
    lon, lat = F.radians("lon"), F.radians("lat")
    mean = points.groupBy(*keys).agg(F.avg(F.cos(lat) * F.cos(lon)).alias("x"), F.avg(F.cos(lat) * F.sin(lon)).alias("y"), F.avg(F.sin(lat)).alias("z"), F.count("*").alias("n"))
    centre = mean.select(*keys, "n", F.degrees(F.atan2("y", "x")).alias("center_lon"), F.degrees(F.atan2("z", F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")))).alias("center_lat"))
    far = points.join(centre, list(keys)).withColumn("km", haversine_km(F.col("center_lon"), F.col("center_lat"), F.col("lon"), F.col("lat")))
    spread = far.groupBy(*keys).agg(F.percentile("km", F.lit(0.5)).alias("p50_km"), F.percentile("km", F.lit(0.9)).alias("p90_km"))
    return centre.join(spread, list(keys))


def page(rows: DataFrame, order: Sequence[Column], limit: int, back: Sequence[Column]) -> DataFrame:
    """The first `limit` rows in `order`, returned in the order `back`, and whether there are more.

    One row more than asked for is taken, which is all that the flag costs.
    """
    some = rows.orderBy(*order).limit(checked_limit(limit) + 1).withColumn("n", F.row_number().over(Window.orderBy(*order)))  # limit + 1 rows
    more = F.max("n").over(Window.partitionBy()) > limit
    return some.withColumn("truncated", more).where(F.col("n") <= limit).drop("n").orderBy(*back)


def latest_at(rows: DataFrame, column: str, at: str) -> DataFrame:
    """The rows of the last value of `column` up to `at`."""
    last = rows.where(F.col(column) <= F.lit(at).cast("date")).agg(F.max(column).alias("_last"))
    return rows.join(F.broadcast(last), F.col(column) == F.col("_last")).drop("_last")  # one row


def dense_index(rows: DataFrame, bucket: str) -> DataFrame:
    """Each bucket's place among the different buckets, from nought; numbered on the (few) different ones."""
    index = rows.select(bucket).distinct().withColumn("bucket_index", F.row_number().over(Window.orderBy(bucket)) - 1)
    return rows.join(F.broadcast(index), bucket)  # a row a bucket


def trail(footprints: DataFrame, lookback_weeks: int) -> DataFrame:
    """For each story week its fields, and those of the weeks before it: when they were last in, and whether they persist.

    `footprints` has story_id, timeline_bucket, field_id.  The weeks back are an equality on the week
    that a footprint reaches.
    """
    own = footprints.select("story_id", "timeline_bucket", "field_id").distinct()
    weeks = own.select("story_id", "timeline_bucket").distinct()
    reach = own.withColumn("back", F.explode(F.sequence(F.lit(0), F.lit(lookback_weeks)))).select("story_id", F.date_add("timeline_bucket", F.col("back") * 7).alias("timeline_bucket"), "field_id", F.col("timeline_bucket").alias("seen"))
    held = reach.join(weeks, ["story_id", "timeline_bucket"]).groupBy("story_id", "timeline_bucket", "field_id").agg(
        F.max("seen").alias("last_seen"), F.max(F.when(F.col("seen") < F.col("timeline_bucket"), F.col("seen"))).alias("seen_before")
    )
    here = F.col("last_seen") == F.col("timeline_bucket")
    return held.select("story_id", "timeline_bucket", "field_id", "seen_before", F.when(here & F.col("seen_before").isNotNull(), "persists").when(here, "entered").otherwise("left").alias("kind"))


def trail_stats(trailed: DataFrame) -> DataFrame:
    return trailed.groupBy("story_id", "timeline_bucket").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("persists", "entered", "left")])


def latest_checkpoints(checkpoints: DataFrame, days: DataFrame, within: int = 56, closed_for: int = 28) -> DataFrame:
    """For each day the last checkpoint of every story in the `within` days up to it; closed ones stay `closed_for`.

    `checkpoints` has story_id, observation_date, closed and more; `days` has day.  A checkpoint names the
    days that it reaches, which makes an equality, and only up to the story's next one.
    """
    order = Window.partitionBy("story_id").orderBy("observation_date")
    stays = F.when(F.col("closed"), F.lit(closed_for)).otherwise(F.lit(within))
    last = F.least(F.date_add("observation_date", stays), F.coalesce(F.date_sub(F.lead("observation_date").over(order), 1), F.lit("9999-12-31").cast("date")))
    reach = checkpoints.withColumn("until", last).withColumn("day", F.explode(F.sequence("observation_date", "until"))).drop("until")
    return reach.join(days, "day")


def matched_weeks(claims: DataFrame, evidence: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Claims with the evidence of their week: by source week, or known that week of a source week before.

    The two ways are two equalities whose results are joined on end; they cannot both hold.
    """
    now = claims.join(evidence.withColumn("week", F.col("source_week")), [*keys, "week"]).withColumn("how", F.lit("source"))
    late = claims.join(evidence.where("source_week < known_week").withColumn("week", F.col("known_week")), [*keys, "week"]).withColumn("how", F.lit("known_late"))
    return now.unionByName(late)


def null_safe_anti(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` whose key is not in `right`; a null equals a null."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys]).distinct()
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        on = same if on is None else on & same
    return left.join(other, on, "left_anti")


def cosine(a: str, b: str) -> Column:
    """Of two arrays of one length; null where either is zero, null, or holds what is not finite."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    size = F.sqrt(dot(F.col(a), F.col(a))) * F.sqrt(dot(F.col(b), F.col(b)))
    out = F.try_divide(dot(F.col(a), F.col(b)), size)
    return F.when(is_finite(out), out)


def is_finite(value: Column) -> Column:
    """False for null, NaN and infinities."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))


def why_empty(rows: DataFrame, geometry: DataFrame, box: Box, facets: Mapping[str, object], allowed: Sequence[str]) -> DataFrame:
    """For each week why a frame would be empty: no rows, none that fit the facets, none in the box."""
    marked = rows.join(geometry.select("field_id", overlaps(box).alias("inside")), "field_id", "left")
    fits = F.lit(True)
    for name, value in facets.items():
        if name not in allowed:
            raise ValueError(f"not a facet: {name}")
        fits = fits & (F.col(name) == F.lit(value))
    counts = marked.groupBy("timeline_bucket").agg(F.count_if(fits).alias("fitting"), F.count_if(fits & F.coalesce("inside", F.lit(False))).alias("inside"), F.bool_or(F.col("inside").isNull()).alias("unplaced"))
    return counts.withColumn("diagnosis", F.when(F.col("fitting") == 0, "filtered_out").when(F.col("inside") == 0, "outside_box").otherwise("has_rows"))

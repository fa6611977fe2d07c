"""The reader's requests over the driver's tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echoloom.functions import normalize as nz
from echoloom.operators import serving
from echoloom.operators.temporal import latest

BOX = serving.checked_box("29.1,-2.0,29.9,-1.95")
FACETS = ("hazard", "parity")
LOOKBACK = 2
#: How grave a kind of event is: the canonical row of a field is that of the least number.
GRAVITY = {"error": 0, "purchase": 1, "click": 2, "view": 3, "signup": 4}


def _t(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rows(spark, sf_dir) -> DataFrame:
    gravity = F.element_at(F.create_map(*[F.lit(x) for pair in GRAVITY.items() for x in pair]), F.col("event_type"))
    day = F.to_date("ts")
    return _t(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("field_id"), "ts", day.alias("day"), nz.week_of(day).alias("timeline_bucket"), F.col("event_type").alias("hazard"), gravity.alias("gravity"),
        (F.col("event_id") % 2).alias("parity"), "value",
    )


def _geometry(spark, sf_dir) -> DataFrame:
    u = F.col("field_id")
    rows = _t(spark, sf_dir, "events").select(F.col("user_id").alias("field_id")).distinct()
    rows = rows.withColumns({"lon": F.lit(29.0) + (u % 40).cast("double") * 0.03, "lat": F.lit(-2.0) + F.floor(u / 40).cast("double") * 0.02})
    return rows.withColumns({"min_lon": F.col("lon") - 0.01, "max_lon": F.col("lon") + 0.01, "min_lat": F.col("lat") - 0.01, "max_lat": F.col("lat") + 0.01})


def map_frame(spark, sf_dir):
    """Every week's canonical field rows in a box, with geometry, and totals over the whole set."""
    order = [F.asc("gravity"), F.desc("ts"), F.desc("event_id")]
    out = serving.frame(_rows(spark, sf_dir), _geometry(spark, sf_dir), BOX, order, {"parity": 0}, FACETS)
    return out.select("timeline_bucket", "field_id", "event_id", "hazard", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "total_fields")


def frame_state(spark, sf_dir):
    """The same rows without geometry and box."""
    rows = serving.with_facets(_rows(spark, sf_dir), {"hazard": "error", "parity": 1}, FACETS)
    return latest(rows, ["timeline_bucket", "field_id"], [F.desc("ts"), F.desc("event_id")]).select("timeline_bucket", "field_id", "event_id")


def geometry_lookup(spark, sf_dir):
    rows = _geometry(spark, sf_dir).withColumn("field_id", F.col("field_id").cast("string"))
    return serving.asked_for(rows, ["7", "3", "3", "11", "none such"], "field_id").select("field_id", "place", F.round("min_lon", 6).alias("min_lon"), F.round("max_lat", 6).alias("max_lat"))


def label_search(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").where(F.col("p_name").ilike("%e%")).withColumn("size_class", F.floor(F.col("p_size") / 10))
    return serving.facet_counts(rows, ["p_brand", "p_type", "size_class"])


def weekly_activity(spark, sf_dir):
    """Stories by week: from states with any grave event, and from footprints in weeks that have no state."""
    rows = _rows(spark, sf_dir)
    grave = rows.where("gravity <= 1").select("field_id").distinct()
    states = rows.join(grave, "field_id", "left_semi").where("gravity <= 2").groupBy("timeline_bucket", "hazard").agg(F.countDistinct("field_id").alias("fields"), F.count("*").alias("n"))
    prints = rows.groupBy("timeline_bucket", "hazard").agg(F.countDistinct("field_id").alias("fields"), F.count("*").alias("n"))
    only = serving.null_safe_anti(prints, states, ["timeline_bucket", "hazard"])
    return states.withColumn("source", F.lit("state")).unionByName(only.withColumn("source", F.lit("footprint")))


def weekly_centres(spark, sf_dir):
    rows = _rows(spark, sf_dir).select("timeline_bucket", "hazard", "field_id").distinct().join(_geometry(spark, sf_dir).select("field_id", "lon", "lat"), "field_id")
    out = serving.spherical_centres(rows, ["timeline_bucket", "hazard"])
    return out.withColumns({c: F.round(c, 6) for c in ("center_lon", "center_lat", "p50_km", "p90_km")})


def _footprints(spark, sf_dir):
    return _rows(spark, sf_dir).where("gravity <= 1").select(F.col("hazard").alias("story_id"), "timeline_bucket", "field_id")


def story_trail(spark, sf_dir):
    return serving.trail(_footprints(spark, sf_dir), LOOKBACK)


def trail_stats(spark, sf_dir):
    return serving.trail_stats(serving.trail(_footprints(spark, sf_dir), LOOKBACK))


def cluster_events(spark, sf_dir):
    """Each cluster's label row with its events."""
    rows = _rows(spark, sf_dir).withColumn("cluster", F.concat_ws("/", "hazard", F.col("parity").cast("string")))
    label = rows.groupBy("cluster").agg(F.count("*").alias("support"), F.round(F.median("value"), 6).alias("median_value"))
    return rows.select("cluster", "event_id", "field_id", "day").join(label, "cluster")


def _checkpoints(spark, sf_dir):
    """A story of each field: a row a day, closed by a sign-up."""
    rows = latest(_rows(spark, sf_dir), ["field_id", "day"], [F.asc("gravity"), F.desc("event_id")])
    return rows.select(F.concat(F.lit("story-"), F.col("field_id").cast("string")).alias("story_id"), F.col("day").alias("observation_date"), F.col("hazard").alias("state"), (F.col("hazard") == "signup").alias("closed"))


def checkpoint_frames(spark, sf_dir):
    days = _rows(spark, sf_dir).select(F.col("timeline_bucket").alias("day")).distinct()
    return serving.latest_checkpoints(_checkpoints(spark, sf_dir), days, 10, 4).select("day", "story_id", "observation_date", "state")


def field_day_hazards(spark, sf_dir):
    """Each field's hazards of a day together, with its canonical one, in a box."""
    rows = _rows(spark, sf_dir).join(_geometry(spark, sf_dir).where(serving.overlaps(BOX)).select("field_id"), "field_id", "left_semi")
    return rows.groupBy("field_id", "day").agg(
        F.array_join(F.array_sort(F.collect_set("hazard")), "+").alias("hazards"), F.min_by("hazard", F.struct("gravity", F.lit(0) - F.col("event_id"))).alias("canonical"), F.count("*").alias("n")
    )


def distribution_json(spark, sf_dir):
    keys = ["timeline_bucket"]
    return serving.share_json(serving.shares(_rows(spark, sf_dir), keys, "hazard"), keys, "hazard")


def hazard_entropy(spark, sf_dir):
    keys = ["field_id"]
    return serving.normalized_entropy(serving.shares(_rows(spark, sf_dir), keys, "hazard"), keys).withColumn("entropy", F.round("entropy", 9))


def any_value_of_group(spark, sf_dir):
    """A value that is the same in the whole group."""
    l, o = _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders")
    rows = l.join(o, l.l_orderkey == o.o_orderkey)
    return rows.groupBy("l_orderkey").agg(F.any_value("o_orderstatus").alias("status"), F.any_value("o_custkey", ignoreNulls=True).alias("customer"), F.count("*").alias("n"))


def bucket_index(spark, sf_dir):
    return serving.dense_index(_rows(spark, sf_dir), "timeline_bucket").select("event_id", F.col("bucket_index").cast("long").alias("bucket_index"))


def shifted_rows(spark, sf_dir):
    """The next day of a field's row, whether it is the last, and runs of one hazard by a running sum."""
    order = Window.partitionBy("field_id").orderBy("ts", "event_id")
    rows = _rows(spark, sf_dir).withColumns({
        "next_day": F.lead("day").over(order), "is_last": F.row_number().over(Window.partitionBy("field_id").orderBy(F.desc("ts"), F.desc("event_id"))) == 1,
        "new": F.coalesce(F.col("hazard") != F.lag("hazard").over(order), F.lit(True)).cast("int"),
    })
    return rows.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).select("event_id", "next_day", "is_last", "run")


def truncated_page(spark, sf_dir):
    """The newest hundred orders, oldest first, and whether there are more."""
    out = serving.page(_t(spark, sf_dir, "orders"), [F.desc("o_orderdate"), F.desc("o_orderkey")], 100, [F.asc("o_orderdate"), F.asc("o_orderkey")])
    return out.select("o_orderkey", "truncated")


def latest_bucket(spark, sf_dir):
    return serving.latest_at(_rows(spark, sf_dir), "timeline_bucket", "2024-01-20").select("event_id", "timeline_bucket")


def dropped_columns(spark, sf_dir):
    return _t(spark, sf_dir, "supplier").drop("s_acctbal", "s_name")


def open_orders(spark, sf_dir):
    """Rows in an open state, of several."""
    return _t(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("O", "P")).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def null_safe_anti(spark, sf_dir):
    """Customers' segments and balance signs that no customer of another nation has; nulls are values."""
    c = _t(spark, sf_dir, "customer").withColumn("k", F.when(F.col("c_custkey") % 3 != 0, F.floor(F.col("c_acctbal") / 500)))
    return serving.null_safe_anti(c.where("c_nationkey < 12"), c.where("c_nationkey >= 20"), ["c_mktsegment", "k"]).select("c_custkey")


def matched_weeks(spark, sf_dir):
    """Claims of a week with the evidence of that week, or with what became known in it of a week before."""
    rows = _rows(spark, sf_dir)
    claims = rows.where("hazard = 'error'").select("field_id", F.col("timeline_bucket").alias("week"), F.col("event_id").alias("claim"))
    evidence = rows.where("hazard = 'purchase'").select("field_id", F.col("timeline_bucket").alias("source_week"), nz.week_of(F.date_add("day", (F.col("event_id") % 9).cast("int"))).alias("known_week"), F.col("event_id").alias("evidence"))
    return serving.matched_weeks(claims, evidence, ["field_id"]).select("claim", "evidence", "how")


def vector_cosines(spark, sf_dir):
    """The cosine of each vector with the one of the next id."""
    v = _t(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    other = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    return v.join(other, "vec_id").select("vec_id", F.round(serving.cosine("a", "b"), 6).alias("cosine"))


def finite_values(spark, sf_dir):
    value = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).when(F.col("event_id") % 13 == 0, F.lit(float("inf"))).when(F.col("event_id") % 17 != 0, F.col("value"))
    rows = _t(spark, sf_dir, "events").withColumn("x", value)
    return rows.groupBy("event_type").agg(F.count_if(serving.is_finite(F.col("x"))).alias("finite"), F.round(F.sum(F.when(serving.is_finite(F.col("x")), F.col("x"))), 4).alias("total"), F.count_if(F.col("x").isNull()).alias("missing"))


def bearings(spark, sf_dir):
    """Direction and distance of each field from the origin of the grid."""
    g = _geometry(spark, sf_dir)
    return g.select("field_id", F.round(F.degrees(F.atan2(F.col("lat") + 2.0, F.col("lon") - 29.0)), 6).alias("degrees"), F.round(serving.haversine_km(F.lit(29.0), F.lit(-2.0), F.col("lon"), F.col("lat")), 6).alias("km"))


def data_bounds(spark, sf_dir):
    """What a reader may ask for: the box and days that there are, and how much."""
    rows, g = _rows(spark, sf_dir), _geometry(spark, sf_dir)
    box = g.agg(F.round(F.min("min_lon"), 6).alias("west"), F.round(F.min("min_lat"), 6).alias("south"), F.round(F.max("max_lon"), 6).alias("east"), F.round(F.max("max_lat"), 6).alias("north"), F.count("*").alias("fields"))
    days = rows.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.countDistinct("timeline_bucket").alias("weeks"))
    return box.crossJoin(F.broadcast(days))  # one row each


def empty_frames(spark, sf_dir):
    box = serving.checked_box("29.0,-2.0,29.02,-1.99")
    return serving.why_empty(_rows(spark, sf_dir), _geometry(spark, sf_dir), box, {"hazard": "signup"}, FACETS)


_NAMES = [
    "map_frame", "frame_state", "geometry_lookup", "label_search", "weekly_activity", "weekly_centres", "story_trail", "trail_stats", "cluster_events", "checkpoint_frames", "field_day_hazards",
    "distribution_json", "hazard_entropy", "any_value_of_group", "bucket_index", "shifted_rows", "truncated_page", "latest_bucket", "dropped_columns", "open_orders", "null_safe_anti", "matched_weeks",
    "vector_cosines", "finite_values", "bearings", "data_bounds", "empty_frames",
]
QUERIES = {name: globals()[name] for name in _NAMES}

_GRAVE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in GRAVITY.items()) + " END"
ROWS = f"""r AS (SELECT event_id, user_id AS field_id, ts, ts::DATE AS day, date_trunc('week', ts)::DATE AS timeline_bucket, event_type AS hazard, {_GRAVE} AS gravity, event_id % 2 AS parity, value FROM events)"""
GEOMETRY = """p AS (SELECT DISTINCT user_id AS field_id, 29.0::DOUBLE + (user_id % 40)::DOUBLE * 0.03::DOUBLE AS lon, -2.0::DOUBLE + (user_id // 40)::DOUBLE * 0.02::DOUBLE AS lat FROM events),
g AS (SELECT *, lon - 0.01::DOUBLE AS min_lon, lon + 0.01::DOUBLE AS max_lon, lat - 0.01::DOUBLE AS min_lat, lat + 0.01::DOUBLE AS max_lat FROM p)"""
INSIDE = f"NOT (max_lon < {BOX.west}::DOUBLE OR min_lon > {BOX.east}::DOUBLE OR max_lat < {BOX.south}::DOUBLE OR min_lat > {BOX.north}::DOUBLE)"
TRAIL = f"""f AS (SELECT DISTINCT hazard AS story_id, timeline_bucket, field_id FROM r WHERE gravity <= 1), w AS (SELECT DISTINCT story_id, timeline_bucket FROM f),
t AS (SELECT w.story_id, w.timeline_bucket, f.field_id, max(f.timeline_bucket) AS last_seen, max(CASE WHEN f.timeline_bucket < w.timeline_bucket THEN f.timeline_bucket END) AS seen_before
  FROM w JOIN f ON f.story_id = w.story_id AND w.timeline_bucket - f.timeline_bucket BETWEEN 0 AND {7 * LOOKBACK} GROUP BY 1, 2, 3),
k AS (SELECT story_id, timeline_bucket, field_id, seen_before, CASE WHEN last_seen < timeline_bucket THEN 'left' WHEN seen_before IS NULL THEN 'entered' ELSE 'persists' END AS kind FROM t)"""


def _km(lon1, lat1, lon2, lat2):
    return f"2 * {serving.EARTH_KM}::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"


ORACLES = {
    "map_frame": f"""WITH {ROWS}, {GEOMETRY}, b AS (SELECT * FROM r WHERE parity = 0 QUALIFY row_number() OVER (PARTITION BY timeline_bucket, field_id ORDER BY gravity, ts DESC, event_id DESC) = 1),
      c AS (SELECT *, count(*) OVER (PARTITION BY timeline_bucket) AS total_fields FROM b)
      SELECT timeline_bucket, field_id, event_id, hazard, round(lon, 6) AS lon, round(lat, 6) AS lat, total_fields FROM c JOIN g USING (field_id) WHERE {INSIDE}""",
    "frame_state": f"WITH {ROWS} SELECT timeline_bucket, field_id, event_id FROM r WHERE parity = 1 AND hazard = 'error' QUALIFY row_number() OVER (PARTITION BY timeline_bucket, field_id ORDER BY ts DESC, event_id DESC) = 1",
    "geometry_lookup": f"""WITH {GEOMETRY}, a(place, field_id) AS (VALUES (0, '7'), (1, '3'), (2, '11'), (3, 'none such')) SELECT a.field_id, a.place, round(min_lon, 6) AS min_lon, round(max_lat, 6) AS max_lat FROM a JOIN g ON g.field_id::VARCHAR = a.field_id""",
    "label_search": """WITH s AS (SELECT *, (p_size // 10)::VARCHAR AS size_class FROM part WHERE p_name ILIKE '%e%') SELECT 'p_brand' AS facet, p_brand AS value, count(*) AS n FROM s GROUP BY 2
      UNION ALL SELECT 'p_type', p_type, count(*) FROM s GROUP BY 2 UNION ALL SELECT 'size_class', size_class, count(*) FROM s GROUP BY 2""",
    "weekly_activity": f"""WITH {ROWS}, s AS (SELECT timeline_bucket, hazard, count(DISTINCT field_id) AS fields, count(*) AS n FROM r WHERE gravity <= 2 AND EXISTS (SELECT 1 FROM r x WHERE x.field_id = r.field_id AND x.gravity <= 1) GROUP BY 1, 2),
      f AS (SELECT timeline_bucket, hazard, count(DISTINCT field_id) AS fields, count(*) AS n FROM r GROUP BY 1, 2)
      SELECT *, 'state' AS source FROM s UNION ALL SELECT *, 'footprint' FROM f WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.timeline_bucket = f.timeline_bucket AND s.hazard = f.hazard)""",
    "weekly_centres": f"""WITH {ROWS}, {GEOMETRY}, q AS (SELECT DISTINCT timeline_bucket, hazard, field_id, lon, lat FROM r JOIN g USING (field_id)),
      m AS (SELECT timeline_bucket, hazard, avg(cos(radians(lat)) * cos(radians(lon))) AS x, avg(cos(radians(lat)) * sin(radians(lon))) AS y, avg(sin(radians(lat))) AS z, count(*) AS n FROM q GROUP BY 1, 2),
      c AS (SELECT *, degrees(atan2(y, x)) AS clon, degrees(atan2(z, sqrt(x * x + y * y))) AS clat FROM m), d AS (SELECT timeline_bucket, hazard, {_km('clon', 'clat', 'lon', 'lat')} AS km FROM q JOIN c USING (timeline_bucket, hazard)),
      s AS (SELECT timeline_bucket, hazard, quantile_cont(km, 0.5) AS a, quantile_cont(km, 0.9) AS b FROM d GROUP BY 1, 2)
      SELECT timeline_bucket, hazard, n, round(clon, 6) AS center_lon, round(clat, 6) AS center_lat, round(a, 6) AS p50_km, round(b, 6) AS p90_km FROM c JOIN s USING (timeline_bucket, hazard)""",
    "story_trail": f"WITH {ROWS}, {TRAIL} SELECT * FROM k",
    "trail_stats": f"""WITH {ROWS}, {TRAIL} SELECT story_id, timeline_bucket, count(*) FILTER (WHERE kind = 'persists') AS persists, count(*) FILTER (WHERE kind = 'entered') AS entered, count(*) FILTER (WHERE kind = 'left') AS "left" FROM k GROUP BY 1, 2""",
    "cluster_events": f"""WITH {ROWS}, c AS (SELECT *, hazard || '/' || parity::VARCHAR AS cluster FROM r), l AS (SELECT cluster, count(*) AS support, round(median(value), 6) AS median_value FROM c GROUP BY 1)
      SELECT cluster, event_id, field_id, day, support, median_value FROM c JOIN l USING (cluster)""",
    "checkpoint_frames": f"""WITH {ROWS}, c AS (SELECT 'story-' || field_id AS story_id, day AS observation_date, hazard AS state FROM r QUALIFY row_number() OVER (PARTITION BY field_id, day ORDER BY gravity, event_id DESC) = 1),
      d AS (SELECT DISTINCT timeline_bucket AS day FROM r), l AS (SELECT day, c.*, row_number() OVER (PARTITION BY day, story_id ORDER BY observation_date DESC) AS n FROM d JOIN c ON c.observation_date <= d.day)
      SELECT day, story_id, observation_date, state FROM l WHERE n = 1 AND day - observation_date <= CASE WHEN state = 'signup' THEN 4 ELSE 10 END""",
    "field_day_hazards": f"""WITH {ROWS}, {GEOMETRY} SELECT field_id, day, string_agg(DISTINCT hazard, '+' ORDER BY hazard) AS hazards, arg_min(hazard, (gravity, -event_id)) AS canonical, count(*) AS n
      FROM r WHERE field_id IN (SELECT field_id FROM g WHERE {INSIDE}) GROUP BY 1, 2""",
    "distribution_json": f"""WITH {ROWS}, s AS (SELECT timeline_bucket, hazard, count(*) / sum(count(*)) OVER (PARTITION BY timeline_bucket) AS share FROM r GROUP BY 1, 2)
      SELECT timeline_bucket, '{{' || string_agg('"' || hazard || '":"' || printf('%.6f', share) || '"', ',' ORDER BY hazard) || '}}' AS distribution FROM s GROUP BY 1""",
    "hazard_entropy": f"""WITH {ROWS}, s AS (SELECT field_id, hazard, count(*) / sum(count(*)) OVER (PARTITION BY field_id) AS p FROM r GROUP BY 1, 2)
      SELECT field_id, round(CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) ELSE 0.0 END, 9) AS entropy, count(*) AS categories FROM s GROUP BY 1""",
    "any_value_of_group": "SELECT l_orderkey, any_value(o_orderstatus) AS status, any_value(o_custkey) AS customer, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
    "bucket_index": f"WITH {ROWS} SELECT event_id, dense_rank() OVER (ORDER BY timeline_bucket) - 1 AS bucket_index FROM r",
    "shifted_rows": f"""WITH {ROWS}, n AS (SELECT *, lead(day) OVER w AS next_day, lead(event_id) OVER w IS NULL AS is_last, (hazard IS DISTINCT FROM lag(hazard) OVER w)::INT AS new FROM r WINDOW w AS (PARTITION BY field_id ORDER BY ts, event_id))
      SELECT event_id, next_day, is_last, (sum(new) OVER (PARTITION BY field_id ORDER BY ts, event_id))::BIGINT AS run FROM n""",
    "truncated_page": "WITH t AS (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100) SELECT o_orderkey, (SELECT count(*) FROM orders) > 100 AS truncated FROM t",
    "latest_bucket": f"WITH {ROWS} SELECT event_id, timeline_bucket FROM r WHERE timeline_bucket = (SELECT max(timeline_bucket) FROM r WHERE timeline_bucket <= DATE '2024-01-20')",
    "dropped_columns": "SELECT * EXCLUDE (s_acctbal, s_name) FROM supplier",
    "open_orders": "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY 1",
    "null_safe_anti": """WITH c AS (SELECT *, CASE WHEN c_custkey % 3 <> 0 THEN floor(c_acctbal / 500) END AS k FROM customer)
      SELECT c_custkey FROM c WHERE c_nationkey < 12 AND NOT EXISTS (SELECT 1 FROM c d WHERE d.c_nationkey >= 20 AND d.c_mktsegment IS NOT DISTINCT FROM c.c_mktsegment AND d.k IS NOT DISTINCT FROM c.k)""",
    "matched_weeks": f"""WITH {ROWS}, e AS (SELECT field_id, timeline_bucket AS source_week, date_trunc('week', day + (event_id % 9)::INT)::DATE AS known_week, event_id AS evidence FROM r WHERE hazard = 'purchase')
      SELECT c.event_id AS claim, evidence, CASE WHEN source_week = timeline_bucket THEN 'source' ELSE 'known_late' END AS how FROM r c JOIN e ON c.hazard = 'error' AND c.field_id = e.field_id
      AND (source_week = timeline_bucket OR (known_week = timeline_bucket AND source_week < timeline_bucket))""",
    "vector_cosines": "SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "finite_values": """WITH x AS (SELECT event_type, CASE WHEN event_id % 11 = 0 THEN 'nan'::DOUBLE WHEN event_id % 13 = 0 THEN 'inf'::DOUBLE WHEN event_id % 17 <> 0 THEN value END AS x FROM events)
      SELECT event_type, count(*) FILTER (WHERE isfinite(x)) AS finite, round(sum(x) FILTER (WHERE isfinite(x)), 4) AS total, count(*) FILTER (WHERE x IS NULL) AS missing FROM x GROUP BY 1""",
    "bearings": f"WITH {GEOMETRY} SELECT field_id, round(degrees(atan2(lat + 2.0::DOUBLE, lon - 29.0::DOUBLE)), 6) AS degrees, round({_km('29.0::DOUBLE', '-2.0::DOUBLE', 'lon', 'lat')}, 6) AS km FROM g",
    "data_bounds": f"""WITH {ROWS}, {GEOMETRY} SELECT * FROM (SELECT round(min(min_lon), 6) AS west, round(min(min_lat), 6) AS south, round(max(max_lon), 6) AS east, round(max(max_lat), 6) AS north, count(*) AS fields FROM g),
      (SELECT min(day) AS first_day, max(day) AS last_day, count(DISTINCT timeline_bucket) AS weeks FROM r)""",
    "empty_frames": f"""WITH {ROWS}, {GEOMETRY}, m AS (SELECT r.*, NOT (max_lon < 29.0::DOUBLE OR min_lon > 29.02::DOUBLE OR max_lat < -2.0::DOUBLE OR min_lat > -1.99::DOUBLE) AS inside FROM r LEFT JOIN g USING (field_id)),
      c AS (SELECT timeline_bucket, count(*) FILTER (WHERE hazard = 'signup') AS fitting, count(*) FILTER (WHERE hazard = 'signup' AND inside) AS inside, bool_or(inside IS NULL) AS unplaced FROM m GROUP BY 1)
      SELECT *, CASE WHEN fitting = 0 THEN 'filtered_out' WHEN inside = 0 THEN 'outside_box' ELSE 'has_rows' END AS diagnosis FROM c""",
}

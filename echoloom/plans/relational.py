"""The relational operators that the monitored programme borrows, each as one query over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from echoloom.functions import normalize as nz
from echoloom.operators import temporal


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def typed_projection(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    text = F.col("props").cast("string")
    return e.select("event_id", F.expr("try_cast(substr(event_type, 1, 1) as int)").alias("bad_cast"), F.coalesce(F.nullif(F.trim("event_type"), F.lit("view")), F.lit("seen")).alias("kind"), F.length(text).alias("props_size"))


def pushed_filters(spark, sf_dir):
    """A date range, a facet and a bounding box, all of which reach the Parquet scan."""
    l = _t(spark, sf_dir, "lineitem")
    box = (F.col("l_discount") >= 0.05) & (F.col("l_discount") <= 0.07) & (F.col("l_quantity") < 24)
    range_ = (F.col("l_shipdate") >= F.lit("1994-01-01").cast("timestamp_ntz")) & (F.col("l_shipdate") < F.lit("1995-01-01").cast("timestamp_ntz"))
    return l.where(range_ & box).agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 2).alias("revenue"))


def semi_anti(spark, sf_dir):
    c, o = _t(spark, sf_dir, "customer"), _t(spark, sf_dir, "orders")
    big = o.where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    none = o.select(F.col("o_custkey").alias("c_custkey"))
    a = c.join(big, "c_custkey", "left_semi").select("c_custkey", F.lit("big").alias("kind"))
    return a.unionByName(c.join(none, "c_custkey", "left_anti").select("c_custkey", F.lit("idle").alias("kind")))


def search_like(spark, sf_dir):
    return _t(spark, sf_dir, "part").where(F.col("p_name").ilike("%e%")).select("p_brand", "p_type").distinct().orderBy("p_brand", "p_type").limit(50)


def star_join(spark, sf_dir):
    l, o, c, n, r = (_t(spark, sf_dir, x) for x in ("lineitem", "orders", "customer", "nation", "region"))
    rows = l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return rows.groupBy("r_name", "n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.countDistinct("o_orderkey").alias("orders"))


def pricing_summary(spark, sf_dir):
    l = _t(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return l.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(net), 2).alias("sum_net"), F.round(F.sum(net * (1 + F.col("l_tax"))), 2).alias("sum_charge"),
        F.round(F.avg("l_discount"), 9).alias("avg_discount"), F.count("*").alias("n"),
    )


def full_outer(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("suppliers"))
    c = _t(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"))
    return s.join(c, "nation", "full").select("nation", F.coalesce("suppliers", F.lit(0)).alias("suppliers"), F.coalesce("customers", F.lit(0)).alias("customers"))


def small_dimension_grid(spark, sf_dir):
    """Every region with every priority, orders or none: a cross join of two dimensions of a few rows."""
    o, c, n, r = (_t(spark, sf_dir, x) for x in ("orders", "customer", "nation", "region"))
    grid = r.select("r_name").crossJoin(F.broadcast(o.select("o_orderpriority").distinct()))
    counts = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).groupBy("r_name", "o_orderpriority").agg(F.count("*").alias("n"))
    return grid.join(counts, ["r_name", "o_orderpriority"], "left").fillna(0, ["n"])


def asof_order(spark, sf_dir):
    """The last order of a customer at or before thirty days after each of its orders."""
    o = _t(spark, sf_dir, "orders")
    probe = o.select(F.col("o_custkey").alias("cust"), F.date_add(F.col("o_orderdate").cast("date"), 30).alias("at"), F.col("o_orderkey").alias("probe_key"))
    facts = o.groupBy(F.col("o_custkey").alias("cust"), F.col("o_orderdate").cast("date").alias("day")).agg(F.max("o_orderkey").alias("last_key"))
    return temporal.asof_join(probe, facts, ["cust"], "at", "day", ["day", "last_key"])


def latest_known(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").where("o_orderdate < timestamp_ntz'1997-01-01 00:00:00'")
    return temporal.latest(o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


def week_interval(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("user_id", "event_id", F.to_date("ts").alias("day"))
    weeks = e.groupBy("user_id", nz.week_of(F.col("day")).alias("week")).agg(F.count("*").alias("week_events"))
    return temporal.week_interval_join(e, weeks, ["user_id"], "day", "week").select("event_id", "week", "week_events")


def checked_join(spark, sf_dir):
    return temporal.unique_join(_t(spark, sf_dir, "customer"), _t(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), ["c_nationkey"]).select("c_custkey", "n_name")


def duplicate_keys(spark, sf_dir):
    return temporal.duplicates(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_suppkey"]).withColumnRenamed("count", "n")


def conditional_counts(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(
        F.countDistinct(F.when(F.col("event_type") == "error", F.to_date("ts"))).alias("error_days"), F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.bool_or(F.col("event_type") == "signup").alias("signed"), F.bool_and(F.col("value") >= 0).alias("nonnegative"), F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event"),
        F.min_by("event_id", F.struct("ts", "event_id")).alias("first_event"),
    )


def quantiles(spark, sf_dir):
    return _t(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.round(F.median("p_retailprice"), 6).alias("median_price"), F.round(F.percentile("p_retailprice", F.lit(0.9)), 6).alias("p90_price"), F.round(F.regr_slope("p_retailprice", F.col("p_size").cast("double")), 6).alias("slope"))


def listed(spark, sf_dir):
    return _t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("segments"))


def modal_value(spark, sf_dir):
    counts = _t(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return temporal.latest(counts, ["user_id"], [F.desc("n"), F.asc("event_type")]).select("user_id", F.col("event_type").alias("modal_type"), "n")


def running_windows(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    all_before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = F.last(F.when(F.col("event_type") == "purchase", F.col("event_id")), ignorenulls=True).over(all_before)
    return _t(spark, sf_dir, "events").select(
        "event_id", F.lag("event_type").over(w).alias("before"), F.first("event_id").over(all_before).alias("first_id"), kept.alias("last_purchase"),
        F.count("*").over(all_before).alias("nth"), F.size(F.collect_set("event_type").over(Window.partitionBy("user_id"))).alias("types"), F.round(F.sum("value").over(all_before), 4).alias("running_value"),
    )


def longest_islands(spark, sf_dir):
    """The longest run of days on end with events, for each user."""
    days = _t(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    island = F.date_sub("day", F.row_number().over(Window.partitionBy("user_id").orderBy("day")))
    runs = days.withColumn("island", island).groupBy("user_id", "island").agg(F.count("*").alias("run"))
    return runs.groupBy("user_id").agg(F.max("run").alias("longest_run"), F.count("*").alias("islands"))


def sessions(spark, sf_dir):
    """Gap sessions of three days."""
    e = _t(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    new = F.coalesce(F.date_diff("day", F.lag("day").over(w)) > 3, F.lit(True)).cast("int")
    nth = F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = e.withColumn("new", new).withColumn("session", nth)
    return rows.groupBy("user_id", "session").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("n"))


def top_rows(spark, sf_dir):
    """The newest, one more than asked for, so that a reader can tell that there are more."""
    return _t(spark, sf_dir, "orders").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(101).select("o_orderkey", "o_totalprice")


def set_operations(spark, sf_dir):
    s, c = _t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")), _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    only = c.subtract(s).withColumn("kind", F.lit("customers_only"))
    return s.union(c).distinct().withColumn("kind", F.lit("either")).unionByName(only)


def calendar_spine(spark, sf_dir):
    """Every day from the first to the last, events or none."""
    e = _t(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    spine = e.agg(F.min("day").alias("a"), F.max("day").alias("b")).select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))
    return spine.join(e, "day", "left").fillna(0, ["n"])


def scalar_functions(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    return o.select(
        "o_orderkey", nz.token(F.col("o_orderpriority")).alias("priority_token"), nz.stable_id("order", F.col("o_orderkey"), F.col("o_orderstatus"), day).alias("stable"),
        F.md5(F.col("o_orderkey").cast("string")).alias("record"), nz.week_of(day).alias("monday"), F.weekofyear(day).alias("iso_week"), F.date_diff(F.lit("1999-01-01").cast("date"), day).alias("age"),
        F.round(2 * 6371.0088 * F.asin(F.sqrt(F.pow(F.sin(F.radians(F.col("o_custkey") % 90) / 2), 2))), 6).alias("haversine_km"),
    )


def timeline(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.groupBy(nz.week_of(F.to_date("ts")).alias("timeline_bucket")).agg(F.countDistinct("user_id").alias("users"), F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("errors"), F.count("*").alias("events"))


def frame(spark, sf_dir):
    """One week's canonical row for each user (the gravest, then newest), with whole-set totals."""
    rank = F.element_at(F.create_map(*[F.lit(x) for p in (("error", 0), ("purchase", 1), ("click", 2), ("view", 3), ("signup", 4)) for x in p]), F.col("event_type"))
    rows = _t(spark, sf_dir, "events").where("ts >= timestamp_ntz'2024-01-08 00:00:00' and ts < timestamp_ntz'2024-01-15 00:00:00'").withColumn("rank", rank)
    best = temporal.latest(rows, ["user_id"], [F.asc("rank"), F.desc("ts"), F.desc("event_id")])
    total = F.broadcast(best.agg(F.count("*").alias("total")))  # one row
    return best.select("user_id", "event_id", "event_type").crossJoin(total)


def facets(spark, sf_dir):
    l = _t(spark, sf_dir, "lineitem")
    return l.groupingSets([["l_returnflag"], ["l_linestatus"], []], "l_returnflag", "l_linestatus").agg(F.count("*").alias("n")).select("l_returnflag", "l_linestatus", "n")


def field_events(spark, sf_dir):
    """The five newest events of each user: a bounded drill-down."""
    rows = _t(spark, sf_dir, "events")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id")))
    return rows.withColumn("n", n).where("n <= 5").select("user_id", "n", "event_id", "event_type")


def palette(spark, sf_dir):
    return _t(spark, sf_dir, "part").groupBy("p_type").agg(F.count("*").alias("n"), F.max("p_size").alias("size")).orderBy(F.desc("n"), "p_type").limit(10)


def activity(spark, sf_dir):
    """Events by day for users that ever bought, with those that never failed left out."""
    e = _t(spark, sf_dir, "events")
    bought, failed = (e.where(F.col("event_type") == k).select("user_id").distinct() for k in ("purchase", "error"))
    rows = e.join(bought, "user_id", "left_semi").join(failed, "user_id", "left_semi")
    return rows.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))


def evolution(spark, sf_dir):
    """Of each week's users, how many were there the week before: persistence and Jaccard."""
    weeks = _t(spark, sf_dir, "events").where("event_type in ('error', 'purchase')").select(nz.week_of(F.to_date("ts")).alias("week"), "user_id").distinct()
    size = weeks.groupBy("week").agg(F.count("*").alias("n"))
    back = weeks.select(F.date_add("week", 7).alias("week"), "user_id")
    kept = weeks.join(back, ["week", "user_id"]).groupBy("week").agg(F.count("*").alias("persisting"))
    before = size.select(F.date_add("week", 7).alias("week"), F.col("n").alias("n_before"))
    out = size.join(kept, "week", "left").join(before, "week", "left").fillna(0, ["persisting", "n_before"])
    return out.withColumn("jaccard", F.round(F.col("persisting") / (F.col("n") + F.col("n_before") - F.col("persisting")), 9))


_NAMES = [
    "typed_projection", "pushed_filters", "semi_anti", "search_like", "star_join", "pricing_summary", "full_outer", "small_dimension_grid", "asof_order", "latest_known", "week_interval", "checked_join",
    "duplicate_keys", "conditional_counts", "quantiles", "listed", "modal_value", "running_windows", "longest_islands", "sessions", "top_rows", "set_operations", "calendar_spine", "scalar_functions",
    "timeline", "frame", "facets", "field_events", "palette", "activity", "evolution",
]
QUERIES = {name: globals()[name] for name in _NAMES}

ORACLES = {
    "typed_projection": "SELECT event_id, try_cast(substr(event_type, 1, 1) AS INT) AS bad_cast, coalesce(nullif(trim(event_type), 'view'), 'seen') AS kind, length(props)::INT AS props_size FROM events",
    "pushed_filters": "SELECT count(*) AS n, round(sum(l_extendedprice * l_discount), 2) AS revenue FROM lineitem WHERE l_shipdate >= TIMESTAMP '1994-01-01' AND l_shipdate < TIMESTAMP '1995-01-01' AND l_discount BETWEEN 0.05::DOUBLE AND 0.07::DOUBLE AND l_quantity < 24",
    "semi_anti": """SELECT c_custkey, 'big' AS kind FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)
      UNION ALL SELECT c_custkey, 'idle' FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
    "search_like": "SELECT DISTINCT p_brand, p_type FROM part WHERE p_name ILIKE '%e%' ORDER BY 1, 2 LIMIT 50",
    "star_join": """SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(DISTINCT o_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    "pricing_summary": """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_net,
      round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge, round(avg(l_discount), 9) AS avg_discount, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""",
    "full_outer": """SELECT coalesce(a.k, b.k) AS nation, coalesce(a.n, 0) AS suppliers, coalesce(b.n, 0) AS customers FROM (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) a
      FULL JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) b ON a.k = b.k""",
    "small_dimension_grid": """SELECT r.r_name, p.o_orderpriority, count(x.o_orderkey) AS n FROM region r CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p LEFT JOIN (
      SELECT n_regionkey, o_orderpriority, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) x ON x.n_regionkey = r.r_regionkey AND x.o_orderpriority = p.o_orderpriority GROUP BY 1, 2""",
    "asof_order": """WITH f AS (SELECT o_custkey AS cust, o_orderdate::DATE AS day, max(o_orderkey) AS last_key FROM orders GROUP BY 1, 2),
      p AS (SELECT o_custkey AS cust, o_orderdate::DATE + 30 AS "at", o_orderkey AS probe_key FROM orders) SELECT p.cust, p."at", p.probe_key, f.day, f.last_key FROM p ASOF LEFT JOIN f ON p.cust = f.cust AND p."at" >= f.day""",
    "latest_known": "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "week_interval": "SELECT event_id, date_trunc('week', ts)::DATE AS week, count(*) OVER (PARTITION BY user_id, date_trunc('week', ts)) AS week_events FROM events",
    "checked_join": "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "duplicate_keys": "SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "conditional_counts": """SELECT user_id, count(DISTINCT CASE WHEN event_type = 'error' THEN ts::DATE END) AS error_days, count(*) FILTER (WHERE event_type = 'purchase') AS purchases, bool_or(event_type = 'signup') AS signed,
      bool_and(value >= 0) AS nonnegative, arg_max(event_id, (ts, event_id)) AS last_event, arg_min(event_id, (ts, event_id)) AS first_event FROM events GROUP BY 1""",
    "quantiles": "SELECT p_brand, round(median(p_retailprice), 6) AS median_price, round(quantile_cont(p_retailprice, 0.9), 6) AS p90_price, round(regr_slope(p_retailprice, p_size), 6) AS slope FROM part GROUP BY 1",
    "listed": "SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments FROM customer GROUP BY 1",
    "modal_value": "SELECT user_id, event_type AS modal_type, count(*) AS n FROM events GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) = 1",
    "running_windows": """SELECT event_id, lag(event_type) OVER w AS before, first_value(event_id) OVER w AS first_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER w AS last_purchase,
      count(*) OVER w AS nth, len(list_distinct(list(event_type) OVER (PARTITION BY user_id)))::INT AS types, round(sum(value) OVER w, 4) AS running_value
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "longest_islands": """WITH d AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events), i AS (SELECT user_id, day - row_number() OVER (PARTITION BY user_id ORDER BY day)::INT AS island FROM d)
      SELECT user_id, max(run) AS longest_run, count(*) AS islands FROM (SELECT user_id, island, count(*) AS run FROM i GROUP BY 1, 2) GROUP BY 1""",
    "sessions": """WITH n AS (SELECT *, coalesce((ts::DATE - lag(ts::DATE) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 3, true)::INT AS new FROM events),
      s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM n) SELECT user_id, session::BIGINT AS session, min(ts::DATE) AS first_day, max(ts::DATE) AS last_day, count(*) AS n FROM s GROUP BY 1, 2""",
    "top_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 101",
    "set_operations": """SELECT nation, 'either' AS kind FROM (SELECT s_nationkey AS nation FROM supplier UNION SELECT c_nationkey FROM customer)
      UNION ALL SELECT nation, 'customers_only' FROM (SELECT c_nationkey AS nation FROM customer EXCEPT SELECT s_nationkey FROM supplier)""",
    "calendar_spine": """SELECT d::DATE AS day, count(event_id) AS n FROM (SELECT unnest(generate_series((SELECT min(ts)::DATE FROM events), (SELECT max(ts)::DATE FROM events), INTERVAL 1 DAY)) AS d) LEFT JOIN events ON ts::DATE = d::DATE GROUP BY 1""",
    "scalar_functions": """SELECT o_orderkey, trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g'), '_') AS priority_token,
      'order_' || substr(sha256(o_orderkey::VARCHAR || chr(31) || o_orderstatus || chr(31) || o_orderdate::DATE::VARCHAR), 1, 24) AS stable, md5(o_orderkey::VARCHAR) AS record, date_trunc('week', o_orderdate)::DATE AS monday,
      week(o_orderdate)::INT AS iso_week, (DATE '1999-01-01' - o_orderdate::DATE)::INT AS age, round(2 * 6371.0088::DOUBLE * asin(sqrt(pow(sin(radians(o_custkey % 90) / 2), 2))), 6) AS haversine_km FROM orders""",
    "timeline": "SELECT date_trunc('week', ts)::DATE AS timeline_bucket, count(DISTINCT user_id) AS users, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS errors, count(*) AS events FROM events GROUP BY 1",
    "frame": """SELECT user_id, event_id, event_type, count(*) OVER () AS total FROM (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 4 END, ts DESC, event_id DESC) = 1)""",
    "facets": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())",
    "field_events": "SELECT user_id, n::INT AS n, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 5",
    "palette": "SELECT p_type, count(*) AS n, max(p_size) AS size FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "activity": """SELECT ts::DATE AS day, event_type, count(*) AS n FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase') AND user_id IN (SELECT user_id FROM events WHERE event_type = 'error') GROUP BY 1, 2""",
    "evolution": """WITH w AS (SELECT DISTINCT date_trunc('week', ts)::DATE AS week, user_id FROM events WHERE event_type IN ('error', 'purchase')), s AS (SELECT week, count(*) AS n FROM w GROUP BY 1),
      k AS (SELECT a.week, count(*) AS p FROM w a JOIN w b ON a.user_id = b.user_id AND a.week = b.week + 7 GROUP BY 1)
      SELECT s.week, s.n, coalesce(p, 0) AS persisting, coalesce(b.n, 0) AS n_before, round(coalesce(p, 0) / (s.n + coalesce(b.n, 0) - coalesce(p, 0)), 9) AS jaccard FROM s LEFT JOIN k USING (week) LEFT JOIN s b ON s.week = b.week + 7""",
}

"""The engine's operators over the driver's tables, each with the SQL it is held against.

Token: events.user_id; pair: (user_id, event_type); observation: an event with its
value; lifecycle: orders of a customer; requests: lineitem; edges: (order, supplier).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import MICROS, change, fixed_bucket, micros, ratio, rounded, seconds_between, stratum, tri_state
from tidemark.operators import asof, graph, stats, windows
from tidemark.plans import policies, research

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
H = 3600


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


@query("""
WITH p AS (SELECT event_id, user_id, ts - INTERVAL 6 HOUR AS t FROM events)
SELECT p.event_id, p.user_id, e.event_id AS asof_event_id, e.value AS asof_value
FROM p ASOF LEFT JOIN events e ON p.user_id = e.user_id AND p.t >= e.ts
""")
def q01_asof_latest_event(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return asof.asof_join(e.select("event_id", "user_id", "ts"), e, ["user_id"], "ts", "ts", ["event_id", "value"], tie="event_id", lookback=6 * H).drop("ts")


@query("""
WITH f AS (SELECT user_id, event_id, ts AS decided, ts + to_minutes(floor(value)::INT * 10) AS effective FROM events WHERE event_type = 'view'),
p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT p.event_id, p.user_id, (max({'e': f.effective, 'd': f.decided, 'i': f.event_id})).i AS asof_fact_id
FROM p LEFT JOIN f ON f.user_id = p.user_id AND f.decided <= p.ts AND f.effective <= p.ts
GROUP BY ALL
""")
def q02_asof_two_keys(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    facts = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("fact_id"), F.col("ts").alias("decided"),
        (F.col("ts") + F.make_dt_interval(mins=F.floor("value").cast("int") * 10)).alias("effective"))
    probes = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return asof.asof_largest(probes, facts, ["user_id"], "ts", ["decided", "effective"], ["effective", "decided", "fact_id"], ["fact_id"]).drop("ts")


def _lookback_sql(h: int, name: str) -> str:
    return f"""b{name} AS (
  SELECT p.event_id, CASE WHEN epoch_us(p.ts) - {h * MICROS} - epoch_us(e.ts) <= {h // 2 * MICROS} THEN e.value END AS v,
    CASE WHEN epoch_us(p.ts) - {h * MICROS} - epoch_us(e.ts) <= {h // 2 * MICROS} THEN (epoch_us(p.ts) - epoch_us(e.ts)) / 1000000.0 END AS s
  FROM (SELECT *, ts - to_seconds({h}) AS t FROM events) p ASOF LEFT JOIN events e ON p.user_id = e.user_id AND p.t >= e.ts)"""


@query(f"""
WITH {_lookback_sql(6 * H, "6h")}, {_lookback_sql(24 * H, "24h")}, {_lookback_sql(72 * H, "72h")}
SELECT p.user_id, p.event_id, round(CASE WHEN b6h.v > 0 THEN p.value / b6h.v - 1 END, 6) AS return_6h, round(CASE WHEN b24h.v > 0 THEN p.value / b24h.v - 1 END, 6) AS return_24h,
  round(CASE WHEN b72h.v > 0 THEN p.value / b72h.v - 1 END, 6) AS return_72h, b6h.s::DOUBLE AS actual_seconds_6h, b24h.s::DOUBLE AS actual_seconds_24h, b72h.s::DOUBLE AS actual_seconds_72h
FROM events p JOIN b6h USING (event_id) JOIN b24h USING (event_id) JOIN b72h USING (event_id)
""")
def q03_lookback_returns(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return research.lookback_features(e.select("user_id", "event_id", "ts"), e, "user_id", "event_id", "ts", "ts", "value")


@query("""
WITH p AS (SELECT event_id, user_id, ts, ts + INTERVAL 24 HOUR AS t FROM events)
SELECT p.event_id, p.user_id, CASE WHEN epoch_us(e.ts) - epoch_us(p.t) <= 43200000000 THEN e.event_id END AS next_event_id,
  CASE WHEN epoch_us(e.ts) - epoch_us(p.t) <= 43200000000 THEN e.value END AS next_value
FROM p ASOF LEFT JOIN events e ON p.user_id = e.user_id AND p.t <= e.ts
""")
def q04_forward_endpoint(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return asof.asof_join(e.select("event_id", "user_id", "ts"), e, ["user_id"], "ts", "ts", ["event_id", "value"], tie="event_id", lookback=24 * H,
        tolerance=12 * H, forward=True, prefix="next_").drop("ts")


DAY_PATH = research.Horizon(24 * H, 12 * H, gap=18 * H)
_PATH = """
WITH j AS (
  SELECT p.event_id AS entry, p.value AS v0, e.value AS v1, epoch_us(e.ts) - epoch_us(p.ts) AS us, (epoch_us(e.ts) - epoch_us(p.ts)) / 1000000.0 AS after
  FROM events p JOIN events e ON e.user_id = p.user_id AND e.ts > p.ts AND e.ts <= p.ts + INTERVAL 36 HOUR),
g AS (SELECT *, (us - coalesce(lag(us) OVER (PARTITION BY entry ORDER BY us), 0)) / 1000000.0 AS gap FROM j),
a AS (
  SELECT entry, count(*) AS n, max(gap)::DOUBLE AS gap, max(after) >= 86400 AND max(gap) <= 64800 AS complete, max(v1) AS high, min(v1) AS low,
    (min(after) FILTER (WHERE v1 >= v0 * 1.5))::DOUBLE AS up50, (min(after) FILTER (WHERE v1 >= v0 * 2.0))::DOUBLE AS up2x, (min(after)
      FILTER (WHERE v1 <= v0 * 0.5))::DOUBLE AS down50
  FROM g GROUP BY entry),
l AS (SELECT p.event_id, p.value, coalesce(a.n, 0) AS n, a.gap, coalesce(a.complete, false) AS complete, a.high, a.low, a.up50, a.up2x, a.down50
  FROM events p LEFT JOIN a ON a.entry = p.event_id)
"""


def _day_labels(spark, sf_dir) -> DataFrame:
    e = Tables(spark, sf_dir).events
    return research.path_labels(e, e, "user_id", "event_id", "ts", "value", "ts", "value", DAY_PATH, {"up50": 1.5, "up2x": 2.0}, {"down50": 0.5})


@query(_PATH + """
SELECT event_id, n AS path_count, gap AS longest_gap, complete AS path_complete, round(CASE WHEN complete THEN high / value - 1 END, 6) AS best_return,
  round(CASE WHEN complete THEN low / value - 1 END, 6) AS worst_return FROM l
""")
def q05_path_extrema(spark, sf_dir):
    r = _day_labels(spark, sf_dir)
    return r.select("event_id", "path_count", "longest_gap", "path_complete", rounded("best_return", 6).alias("best_return"),
        rounded("worst_return", 6).alias("worst_return"))


_TRI = "CASE WHEN {0} IS NOT NULL THEN 'TRUE' WHEN complete THEN 'FALSE' ELSE 'UNKNOWN' END AS crossed_{0}"


@query(_PATH + f"SELECT event_id, {_TRI.format('up50')}, {_TRI.format('up2x')}, {_TRI.format('down50')} FROM l")
def q06_crossings_tristate(spark, sf_dir):
    return _day_labels(spark, sf_dir).select("event_id", "crossed_up50", "crossed_up2x", "crossed_down50")


@query(_PATH + """
SELECT event_id, up50 AS seconds_to_up50, down50 AS seconds_to_down50,
  CASE WHEN up50 IS NOT NULL AND (down50 IS NULL OR up50 < down50) THEN 'TRUE' WHEN down50 IS NOT NULL OR complete THEN 'FALSE'
    ELSE 'UNKNOWN' END AS up50_before_down50 FROM l
""")
def q07_ordered_labels(spark, sf_dir):
    r = _day_labels(spark, sf_dir)
    return r.select("event_id", "seconds_to_up50", "seconds_to_down50",
        research.ordered_label("seconds_to_up50", "seconds_to_down50", F.col("path_complete")).alias("up50_before_down50"))


@query("""
WITH j AS (
  SELECT p.event_id, p.value AS now, e.ts, e.value AS v FROM events p JOIN events e ON e.user_id = p.user_id AND e.ts <= p.ts
    AND e.ts > p.ts - INTERVAL 48 HOUR),
r AS (SELECT *, ln(v / lag(v) OVER (PARTITION BY event_id ORDER BY ts)) AS r FROM j),
a AS (
  SELECT event_id, count(*) AS n, stddev_pop(r) AS sd, count(r) AS nr, any_value(now) / max(v) - 1 AS dd, any_value(now) / min(v) - 1 AS rec,
    abs(sum(sign(r))) AS sg,
    count(*) FILTER (WHERE r <> 0) AS nz, avg(abs(r)) AS ab, sqrt(avg(r * r)) AS rms FROM r GROUP BY event_id)
SELECT event_id, n AS path_count, round(CASE WHEN nr >= 2 THEN sd END, 5) AS realized_volatility, round(dd, 6) AS drawdown, round(rec, 6) AS recovery,
  round(CASE WHEN nz > 0 THEN sg / nz END, 6) AS monotonicity, round(CASE WHEN nr > 0 AND rms > 0 THEN ab / rms END, 5) AS smoothness FROM a
""")
def q08_rolling_path_features(spark, sf_dir):
    r = research.rolling_path(Tables(spark, sf_dir).events, "user_id", "ts", "value", 48 * H)
    return r.select("event_id", "path_count",
        *[rounded(c, d).alias(c) for c, d in (("realized_volatility", 5), ("drawdown", 6), ("recovery", 6), ("monotonicity", 6), ("smoothness", 5))])


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE ts <= TIMESTAMP '2024-01-20'),
t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts DESC, event_type DESC) AS j FROM l WHERE k = 1)
SELECT user_id, event_type AS selected_pair, event_id, value FROM t WHERE j = 1
""")
def q09_pair_selection(spark, sf_dir):
    known = Tables(spark, sf_dir).events.filter(F.col("ts") <= F.lit("2024-01-20").cast("timestamp_ntz")).select("user_id", "event_type", "ts",
        "event_id", "value")
    per_pair = windows.latest_per(known, ["user_id", "event_type"], "ts", "event_id")
    return windows.latest_per(per_pair, ["user_id"], "value", "ts", "event_type").select("user_id", F.col("event_type").alias("selected_pair"),
        "event_id", "value")


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each purchase: current state, lookbacks, path and boost-like facts, none from behind the decision."""
    e = Tables(spark, sf_dir).events
    probes = e.filter("event_type = 'purchase'").select("user_id", "event_id", "ts", "value")
    base = research.lookback_features(probes.select("user_id", "event_id", "ts"), e, "user_id", "event_id", "ts", "ts", "value")
    path = research.rolling_path(e, "user_id", "ts", "value", 48 * H).filter("event_type = 'purchase'").select("event_id", "path_count",
        F.round("drawdown", 6).alias("drawdown"))
    signup = asof.asof_join(probes.select("user_id", "event_id", "ts"), e.filter("event_type = 'signup'"), ["user_id"], "ts", "ts", ["ts"],
        tie="event_id", prefix="signup_")
    signup = signup.select("event_id", F.col("signup_ts").isNotNull().alias("signup_known"),
        seconds_between("signup_ts", "ts").alias("signup_freshness_seconds"))
    return base.join(path, "event_id").join(signup, "event_id").select("user_id", "event_id", "return_6h", "return_24h", "return_72h", "path_count",
        "drawdown", "signup_known", "signup_freshness_seconds")


@query(f"""
WITH {_lookback_sql(6 * H, "6h")}, {_lookback_sql(24 * H, "24h")}, {_lookback_sql(72 * H, "72h")},
w AS (
  SELECT event_id, count(*) OVER k AS path_count, value / max(value) OVER k - 1 AS dd FROM events
  WINDOW k AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 172799999999 PRECEDING AND CURRENT ROW)),
s AS (SELECT p.event_id, e.ts AS at FROM events p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') e ON p.user_id = e.user_id AND p.ts >= e.ts)
SELECT p.user_id, p.event_id, round(CASE WHEN b6h.v > 0 THEN p.value / b6h.v - 1 END, 6) AS return_6h, round(CASE WHEN b24h.v > 0 THEN p.value / b24h.v - 1 END, 6) AS return_24h,
  round(CASE WHEN b72h.v > 0 THEN p.value / b72h.v - 1 END, 6) AS return_72h, path_count, round(dd, 6) AS drawdown, s.at IS NOT NULL AS signup_known,
  ((epoch_us(p.ts) - epoch_us(s.at)) / 1000000.0)::DOUBLE AS signup_freshness_seconds
FROM events p JOIN b6h USING (event_id) JOIN b24h USING (event_id) JOIN b72h USING (event_id) JOIN w USING (event_id) JOIN s USING (event_id) WHERE p.event_type = 'purchase'
""")
def q10_feature_row(spark, sf_dir):
    return feature_rows(spark, sf_dir)


SPLITS = (
    research.SplitWindow("train", "1995-01-01", "1998-01-01", "1998-01-01"), research.SplitWindow("validation", "1998-02-01", "1999-06-01", "1999-06-01"),
    research.SplitWindow("test", "1999-07-01", "2001-09-01", "2001-09-01"),
)


@query("""
WITH a AS (SELECT *, min(o_orderdate) OVER (PARTITION BY o_custkey) AS admitted FROM orders),
w(name, s, e) AS (VALUES ('train', TIMESTAMP '1995-01-01', TIMESTAMP '1998-01-01'), ('validation', TIMESTAMP '1998-02-01', TIMESTAMP '1999-06-01'),
  ('test', TIMESTAMP '1999-07-01', TIMESTAMP '2001-09-01'))
SELECT o_orderkey, name AS split FROM a LEFT JOIN w ON admitted >= s AND admitted < e AND o_orderdate >= s AND o_orderdate < e
  AND o_orderdate + INTERVAL 30 DAY <= e
""")
def q11_chronological_split(spark, sf_dir):
    research.check_windows(SPLITS, 30 * 24 * H, 31 * 24 * H)
    o = Tables(spark, sf_dir).orders
    admitted = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("admitted"))
    return o.join(admitted, "o_custkey").select("o_orderkey",
        research.assign_split(F.col("admitted"), F.col("o_orderdate"), SPLITS, 30 * 24 * H).alias("split"))


@query("""
WITH a AS (SELECT user_id, min(ts) AS admitted FROM events WHERE event_type = 'signup' GROUP BY 1),
u AS (
  SELECT user_id, admitted + to_seconds(unnest([3600, 86400, 259200, 604800])) AS t, 'fixed_age' AS r FROM a
  UNION ALL SELECT user_id, ts, 'observation' FROM events JOIN a USING (user_id) WHERE ts >= admitted
  UNION ALL SELECT user_id, ts, 'lifecycle' FROM events JOIN a USING (user_id) WHERE ts >= admitted AND event_type = 'purchase')
SELECT user_id, t AS decision_at, array_to_string(list_sort(list_distinct(list(r))), '+') AS reasons FROM u GROUP BY 1, 2
""")
def q12_candidate_timestamps(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    admitted = e.filter("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("admitted_at"))
    return research.candidate_times(e, admitted, "user_id", "ts", [3600, 86400, 259200, 604800], e.filter("event_type = 'purchase'"))


@query("SELECT event_id, (('0x' || substr(sha256(event_id::VARCHAR), 1, 16))::UBIGINT % 16)::INT AS stratum FROM events")
def q13_stratum(spark, sf_dir):
    return Tables(spark, sf_dir).events.select("event_id", stratum("event_id", 16).alias("stratum"))


@query("""
WITH h AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-11 23:00:00', INTERVAL 1 HOUR)) AS hour)
SELECT hour, count(event_id) AS events, count(DISTINCT user_id) AS users, count(*) FILTER (WHERE event_type = 'error') AS errors, round(sum(value), 4) AS total
FROM h LEFT JOIN events ON date_trunc('hour', ts) = hour GROUP BY hour
""")
def q14_hourly_counts_spine(spark, sf_dir):
    spine = spark.range(1).select(F.explode(F.expr("sequence(timestamp_ntz'2024-01-10 00:00:00', timestamp_ntz'2024-01-11 23:00:00', interval 1 hour)")).alias("hour"))
    e = Tables(spark, sf_dir).events.filter("ts >= timestamp_ntz'2024-01-10 00:00:00' AND ts < timestamp_ntz'2024-01-12 00:00:00'")
    counts = e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.count("event_id").alias("events"), F.countDistinct("user_id").alias("users"), F.count_if(F.col("event_type") == "error").alias("errors"),
        F.round(F.sum("value"), 4).alias("total")
    )
    return F.broadcast(spine).join(counts, "hour", "left").fillna(0, ["events", "users", "errors"])


@query("""
SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'view') AS views, count(DISTINCT CASE WHEN value > 250 THEN event_type END) AS rich_types,
  min(ts) FILTER (WHERE event_type = 'error') AS first_error, max(value) FILTER (WHERE event_type = 'purchase') AS largest FROM events GROUP BY 1
""")
def q15_filtered_counts(spark, sf_dir):
    is_ = lambda t: F.col("event_type") == t
    return Tables(spark, sf_dir).events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_("view")).alias("views"),
        F.countDistinct(F.when(F.col("value") > 250, F.col("event_type"))).alias("rich_types"),
        F.min(F.when(is_("error"), F.col("ts"))).alias("first_error"), F.max(F.when(is_("purchase"), F.col("value"))).alias("largest"),
    )


@query("""
SELECT o_orderpriority, round(avg(d), 4) AS mean_days, round(quantile_cont(d, 0.5), 4) AS p50, round(quantile_cont(d, 0.95), 4) AS p95,
  round(quantile_cont(d, 0.99), 4) AS p99,
  round(quantile_cont(d, 0.5) FILTER (WHERE l_returnflag = 'R'), 4) AS p50_returned
FROM (SELECT o_orderpriority, l_returnflag, ((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0)::DOUBLE AS d FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1
""")
def q16_latency_percentiles(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = t.lineitem.select("l_orderkey", "l_shipdate", "l_returnflag").join(t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority"),
        F.col("l_orderkey") == F.col("o_orderkey"))
    d = d.select("o_orderpriority", "l_returnflag", (seconds_between("o_orderdate", "l_shipdate") / 86400).alias("d"))
    counts = stats.value_counts(d, ["o_orderpriority", "l_returnflag"], "d")
    whole = counts.groupBy("o_orderpriority", "_v").agg(F.sum("_n").alias("_n"))
    mean = whole.groupBy("o_orderpriority").agg(F.round(F.sum(F.col("_v") * F.col("_n")) / F.sum("_n"), 4).alias("mean_days"))
    ps = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    every = stats.quantiles(whole, ["o_orderpriority"], {a: ("interpolated", p) for a, p in ps.items()})
    returned = stats.quantiles(counts.filter("l_returnflag = 'R'").drop("l_returnflag"), ["o_orderpriority"], {"p50_returned": ("interpolated", 0.5)})
    joined = mean.join(every, "o_orderpriority").join(returned, "o_orderpriority", "left")
    return joined.select("o_orderpriority", "mean_days", *[F.round(c, 4).alias(c) for c in (*ps, "p50_returned")])


@query("""
WITH x AS (SELECT event_type, nullif(event_type, 'error') AS a, CASE WHEN value >= 100 THEN value END AS b FROM events)
SELECT event_type, round(sum(CASE WHEN a IS NULL THEN 1 ELSE 0 END) / count(*), 6) AS null_rate_a, round(sum(CASE WHEN b IS NULL THEN 1
  ELSE 0 END) / count(*), 6) AS null_rate_b FROM x GROUP BY 1
""")
def q17_null_rates(spark, sf_dir):
    x = Tables(spark, sf_dir).events.select("event_type", F.nullif("event_type", F.lit("error")).alias("a"),
        F.when(F.col("value") >= 100, F.col("value")).alias("b"))
    return x.groupBy("event_type").agg(stats.null_rate("a").alias("null_rate_a"), stats.null_rate("b").alias("null_rate_b"))


_GAPS = "SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1000000.0 AS gap FROM events"


def _gaps(spark, sf_dir) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return Tables(spark, sf_dir).events.withColumn("gap", seconds_between(F.lag("ts").over(w), "ts"))


@query(f"SELECT date_trunc('day', ts) AS day, count(gap) AS gaps, round(avg(gap), 3) AS mean_gap, round(quantile_cont(gap, 0.95), 3) AS p95_gap FROM ({_GAPS}) GROUP BY 1")
def q18_lag_cadence(spark, sf_dir):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    gaps = _gaps(spark, sf_dir).select(day, "gap")
    counts = stats.value_counts(gaps, ["day"], "gap")
    whole = gaps.groupBy("day").agg(F.count("gap").alias("gaps"), F.round(F.avg("gap"), 3).alias("mean_gap"))
    return whole.join(stats.quantiles(counts, ["day"], {"p95_gap": ("interpolated", 0.95)}), "day", "left").withColumn("p95_gap", F.round("p95_gap", 3))


@query("""
WITH r AS (SELECT o_orderstatus, (epoch_us(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate,
  o_orderkey)) - epoch_us(o_orderdate)) / 86400000000.0 AS days FROM orders)
SELECT o_orderstatus, count(days) AS spells, round(avg(days), 4) AS mean_days, round(quantile_cont(days, 0.5), 4) AS p50_days FROM r GROUP BY 1
""")
def q19_lead_residence(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    r = Tables(spark, sf_dir).orders.withColumn("days", seconds_between("o_orderdate", F.lead("o_orderdate").over(w)) / 86400)
    return r.groupBy("o_orderstatus").agg(F.count("days").alias("spells"), F.round(F.avg("days"), 4).alias("mean_days"),
        F.round(stats.interpolated("days", 0.5), 4).alias("p50_days"))


@query(f"SELECT user_id, event_id, gap::DOUBLE AS gap FROM ({_GAPS}) WHERE gap IS NOT NULL ORDER BY gap DESC, event_id LIMIT 10")
def q20_top_gaps(spark, sf_dir):
    return _gaps(spark, sf_dir).filter("gap IS NOT NULL").select("user_id", "event_id", "gap").orderBy(F.col("gap").desc(), "event_id").limit(10)


@query("SELECT user_id, arg_min(value, {'t': ts, 'i': event_id}) AS first_value, max(value) AS peak_value, arg_max(event_id, {'v': value, 'i': -event_id}) AS peak_event FROM events GROUP BY 1")
def q21_first_and_peak(spark, sf_dir):
    return Tables(spark, sf_dir).events.groupBy("user_id").agg(
        F.min_by("value", F.struct("ts", "event_id")).alias("first_value"), F.max("value").alias("peak_value"),
        F.max_by("event_id", F.struct(F.col("value"), -F.col("event_id"))).alias("peak_event")
    )


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q22_duplicate_keys(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.groupBy("l_orderkey", "l_partkey").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("""
SELECT 'orders_without_lines' AS rule, count(*) AS violations FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL
UNION ALL SELECT 'lines_without_part', count(*) FROM lineitem LEFT JOIN part ON p_partkey = l_partkey WHERE p_partkey IS NULL
UNION ALL SELECT 'customers_without_orders', count(*) FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE o_custkey IS NULL
""")
def q23_ref_integrity_anti(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rules = {
        "orders_without_lines": t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"),
        "lines_without_part": t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left_anti"),
        "customers_without_orders": t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti"),
    }
    out = None
    for name, broken in rules.items():
        row = broken.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("violations"))
        out = row if out is None else out.unionByName(row)
    return out


@query("""
SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 48)
  OR EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_discount >= 0.1)
""")
def q24_exists_or(spark, sf_dir):
    t = Tables(spark, sf_dir)
    keys = t.lineitem.filter("(l_returnflag = 'R' AND l_quantity > 48) OR l_discount >= 0.1").select(F.col("l_partkey").alias("p_partkey"))
    return t.part.select("p_partkey").join(keys, "p_partkey", "left_semi")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2000-01-01')")
def q25_not_exists(spark, sf_dir):
    t = Tables(spark, sf_dir)
    late = t.orders.filter("o_orderdate >= timestamp_ntz'2000-01-01 00:00:00'")
    return t.customer.select("c_custkey").join(late, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("""
SELECT n_name, count(DISTINCT c_custkey) AS customers, count(DISTINCT o_orderkey) AS orders, count(DISTINCT CASE
  WHEN o_orderstatus = 'F' THEN o_orderkey END) AS finished, count(DISTINCT s_suppkey) AS suppliers
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1
""")
def q26_fanout_distinct(spark, sf_dir):
    """Each fact is counted by nation before the join, so no fan-out is ever built."""
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_nationkey")
    by_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"))
    customers = c.join(by_customer, c.c_custkey == by_customer.o_custkey, "left").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"),
        F.sum("orders").alias("orders"), F.sum("finished").alias("finished"))
    suppliers = t.supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("suppliers"))
    joined = t.nation.join(customers, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(suppliers,
        F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return joined.select("n_name", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("customers", "orders", "finished", "suppliers")])


@query("SELECT event_type, max(n) AS peak, round(avg(n), 6) AS mean FROM (SELECT event_type, date_trunc('minute', ts) AS m, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def q27_peak_per_minute(spark, sf_dir):
    by_minute = Tables(spark, sf_dir).events.groupBy("event_type", F.date_trunc("minute", "ts").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    return by_minute.groupBy("event_type").agg(F.max("n").alias("peak"), F.round(F.avg("n"), 6).alias("mean"))


@query("""
WITH g AS (
  SELECT user_id, date_trunc('day', ts) AS day, min(ts) FILTER (WHERE event_type = 'error') AS lost, max(ts)
    FILTER (WHERE event_type <> 'error') AS back FROM events GROUP BY 1, 2),
c AS (SELECT user_id, greatest(lost, TIMESTAMP '2024-01-05') AS a, least(coalesce(back, TIMESTAMP '2024-01-25'), TIMESTAMP '2024-01-25') AS b
  FROM g WHERE lost IS NOT NULL)
SELECT user_id, count(*) AS gaps, sum(CASE WHEN b > a THEN (epoch_us(b) - epoch_us(a)) / 1000000.0 ELSE 0 END)::DOUBLE AS gap_seconds FROM c GROUP BY 1
""")
def q28_connectivity_gap(spark, sf_dir):
    g = Tables(spark, sf_dir).events.groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(
        F.min(F.when(F.col("event_type") == "error", F.col("ts"))).alias("lost"), F.max(F.when(F.col("event_type") != "error", F.col("ts"))).alias("back")
    )
    low, high = F.expr("timestamp_ntz'2024-01-05 00:00:00'"), F.expr("timestamp_ntz'2024-01-25 00:00:00'")
    c = g.filter("lost IS NOT NULL").select("user_id", F.greatest("lost", low).alias("a"), F.least(F.coalesce("back", high), high).alias("b"))
    return c.groupBy("user_id").agg(F.count(F.lit(1)).alias("gaps"),
        F.sum(F.when(F.col("b") > F.col("a"), seconds_between("a", "b")).otherwise(0.0)).alias("gap_seconds"))


_SPANS = "SELECT user_id, epoch_us(ts) // 1000000 AS s, epoch_us(ts) // 1000000 + (value * 400)::BIGINT AS e FROM events"


def _spans(spark, sf_dir) -> DataFrame:
    s = F.floor(micros("ts") / MICROS)
    return Tables(spark, sf_dir).events.select("user_id", s.alias("s"), (s + F.round(F.col("value") * 400).cast("long")).alias("e"))


@query(f"""
WITH x AS ({_SPANS}), f AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS n FROM x WHERE e > s),
i AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM f), u AS (SELECT user_id, k, min(s) AS a, max(e) AS b FROM i GROUP BY 1, 2)
SELECT user_id, count(*) AS islands, sum(b - a)::BIGINT AS covered FROM u GROUP BY 1
""")
def q29_interval_union(spark, sf_dir):
    u = windows.interval_union(_spans(spark, sf_dir), ["user_id"], "s", "e")
    return u.groupBy("user_id").agg(F.count(F.lit(1)).alias("islands"), F.sum(F.col("island_end") - F.col("island_start")).alias("covered"))


@query(f"""
WITH x AS ({_SPANS}), d AS (SELECT user_id, s AS t, 1 AS d FROM x UNION ALL SELECT user_id, e, -1 FROM x)
SELECT user_id, max(n)::BIGINT AS peak FROM (SELECT user_id, sum(d) OVER (PARTITION BY user_id ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS n FROM d) GROUP BY 1
""")
def q30_peak_concurrency(spark, sf_dir):
    return windows.peak_concurrency(_spans(spark, sf_dir), ["user_id"], "s", "e")


@query("""
SELECT l_suppkey, arg_min(l_extendedprice, k) AS first_price, arg_max(l_extendedprice, k) AS last_price, round(arg_max(l_extendedprice,
  k) - arg_min(l_extendedprice, k), 4) AS growth
FROM (SELECT *, {'d': l_shipdate, 'o': l_orderkey, 'l': l_linenumber} AS k FROM lineitem) GROUP BY 1
""")
def q31_first_last_growth(spark, sf_dir):
    k = F.struct("l_shipdate", "l_orderkey", "l_linenumber")
    g = Tables(spark, sf_dir).lineitem.groupBy("l_suppkey").agg(F.min_by("l_extendedprice", k).alias("first_price"),
        F.max_by("l_extendedprice", k).alias("last_price"))
    return g.withColumn("growth", F.round(F.col("last_price") - F.col("first_price"), 4))


@query("""
WITH h AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY q DESC, l_suppkey) AS k, q / sum(q) OVER (PARTITION BY l_partkey) AS s FROM h)
SELECT l_partkey, count(*) AS owners, round(sum(100 * s) FILTER (WHERE k <= 1), 6) AS top1_pct, round(sum(100 * s) FILTER (WHERE k <= 5),
  6) AS top5_pct, round(sum(s * s), 6) AS hhi FROM r GROUP BY 1
""")
def q32_holder_concentration(spark, sf_dir):
    c = stats.concentration(Tables(spark, sf_dir).lineitem, ["l_partkey"], "l_suppkey", "l_quantity", (1, 5))
    return c.select("l_partkey", "owners", *[F.round(x, 6).alias(x) for x in ("top1_pct", "top5_pct", "hhi")])


@query("""
WITH w AS (SELECT l_suppkey, o_custkey, count(*) AS n, sum(l_extendedprice) AS v FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY v) AS k, count(*) OVER (PARTITION BY l_suppkey) AS c FROM w)
SELECT l_suppkey, max(c) AS traders, round(sum(v), 2) AS volume, round(max(v) FILTER (WHERE k = ceil(0.5 * c)), 4) AS p50, round(max(v)
  FILTER (WHERE k = ceil(0.9 * c)), 4) AS p90,
  round(count(*) FILTER (WHERE n > 1) / count(*), 6) AS repeat_ratio FROM r GROUP BY 1
""")
def q33_trader_metrics(spark, sf_dir):
    t = Tables(spark, sf_dir)
    w = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_suppkey", "o_custkey").agg(F.count(F.lit(1)).alias("n"),
        F.sum("l_extendedprice").alias("v"))
    whole = w.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("traders"), F.round(F.sum("v"), 2).alias("volume"),
        F.round(ratio(F.count_if(F.col("n") > 1), F.count(F.lit(1))), 6).alias("repeat_ratio"))
    ranks = stats.nearest_rank(w, ["l_suppkey"], "v", {"p50": 0.5, "p90": 0.9})
    return whole.join(ranks, "l_suppkey").select("l_suppkey", "traders", "volume", F.round("p50", 4).alias("p50"), F.round("p90", 4).alias("p90"),
        "repeat_ratio")


@query("SELECT user_id, list_sort(list(value))[1 + floor((count(*) - 1) * 0.5)::INT] AS p50, list_sort(list(value))[1 + floor((count(*) - 1) * 0.99)::INT] AS p99 FROM events GROUP BY 1")
def q34_lower_index_percentile(spark, sf_dir):
    return stats.lower_index(Tables(spark, sf_dir).events, ["user_id"], "value", {"p50": 0.5, "p99": 0.99})


@query("""
SELECT user_id, event_id, event_type FROM (SELECT *, lag(md5(event_type)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
  WHERE p IS NULL OR p <> md5(event_type)
""")
def q35_cdc_dedupe(spark, sf_dir):
    return windows.changed_only(Tables(spark, sf_dir).events, ["user_id"], F.sha2("event_type", 256), "ts", "event_id").select("user_id", "event_id",
        "event_type")


@query("""
WITH l AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events), t(threshold) AS (VALUES (1.0::DOUBLE), (10.0),
  (100.0), (400.0))
SELECT user_id, event_id, threshold, CASE WHEN p < threshold AND threshold <= value THEN 'up' ELSE 'down' END AS direction FROM l, t
WHERE (p < threshold AND threshold <= value) OR (p >= threshold AND threshold > value)
""")
def q36_threshold_crossings(spark, sf_dir):
    return windows.threshold_crossings(Tables(spark, sf_dir).events, ["user_id"], "value", ["ts", "event_id"], (1, 10, 100, 400)).select("user_id",
        "event_id", "threshold", "direction")


@query("""
WITH b AS (SELECT epoch_us(ts) // 21600000000 * 21600 AS bucket, *, row_number() OVER (PARTITION BY epoch_us(ts) // 21600000000, user_id
  ORDER BY ts DESC, event_id DESC) AS k FROM events),
m AS (SELECT bucket, count(*) AS tracked, round(sum(value), 4) AS total, median(value) AS mid FROM b WHERE k = 1 GROUP BY 1),
r AS (SELECT *, mid / lag(mid) OVER (ORDER BY bucket) - 1 AS r FROM m)
SELECT bucket, tracked, total, round(mid, 6) AS mid, round(r, 6) AS change,
  round(sqrt(avg(r * r) OVER (ORDER BY bucket RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)), 6) AS rms FROM r
""")
def q37_market_context_bucket(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select(fixed_bucket("ts", 6 * H).alias("bucket"), "user_id", "ts", "event_id", "value")
    m = windows.latest_per(e, ["bucket", "user_id"], "ts", "event_id").groupBy("bucket").agg(F.count(F.lit(1)).alias("tracked"),
        F.round(F.sum("value"), 4).alias("total"), F.median("value").alias("mid"))
    line = Window.orderBy("bucket")  # one row for each closed bucket, a few a day
    r = m.withColumn("r", change("mid", F.lag("mid").over(line)))
    rms = F.sqrt(F.avg(F.col("r") * F.col("r")).over(line.rangeBetween(-86400, 0)))
    return r.select("bucket", "tracked", "total", F.round("mid", 6).alias("mid"), F.round("r", 6).alias("change"), F.round(rms, 6).alias("rms"))


@query("SELECT o_orderkey, coalesce(o_totalprice >= 100000 AND o_orderstatus <> 'P' AND nullif(o_totalprice, 0) / 2 >= 1000, false) AS eligible FROM orders")
def q38_market_eligibility(spark, sf_dir):
    rule = (F.col("o_totalprice") >= 100000) & (F.col("o_orderstatus") != "P") & (F.try_divide(F.nullif("o_totalprice", F.lit(0.0)), F.lit(2.0)) >= 1000)
    return Tables(spark, sf_dir).orders.select("o_orderkey", F.coalesce(rule, F.lit(False)).alias("eligible"))


@query("""
WITH a AS (SELECT event_id, (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY user_id))) / 1000000.0 AS age FROM events)
SELECT event_id, CASE WHEN age >= 604800 THEN 'RETIRED' WHEN age >= 86400 THEN 'LONG_TAIL_WEEK' WHEN age >= 21600 THEN 'LONG_TAIL_DAY'
  WHEN age >= 3600 THEN 'COOLED' WHEN age >= 600 THEN 'MATURE'
  WHEN age >= 120 THEN 'EARLY' ELSE 'INITIAL' END AS coverage_class, CASE WHEN age >= 604800 THEN NULL WHEN age >= 86400 THEN 43200
    WHEN age >= 21600 THEN 7200 WHEN age >= 3600 THEN 1800
  WHEN age >= 600 THEN 300 WHEN age >= 120 THEN 30 ELSE 15 END AS interval_seconds FROM a
""")
def q39_coverage_class(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    age = seconds_between(F.min("ts").over(Window.partitionBy("user_id")), "ts")
    aged = e.select("event_id", age.alias("age"))
    return aged.select("event_id", policies.coverage_class(F.col("age")).alias("coverage_class"),
        policies.coverage_interval(F.col("age")).alias("interval_seconds"))


@query("""
WITH RECURSIVE o AS (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, value AS m5, value * 2 AS h1, value * 5 AS liq FROM events),
s AS (
  SELECT user_id, 0 AS k, 'NEW' AS state, 0 AS changes FROM (SELECT DISTINCT user_id FROM events)
  UNION ALL SELECT user_id, k, n, changes + (n <> state)::INT FROM (
    SELECT s.user_id, o.k, s.state, s.changes, CASE WHEN state = 'NEW' AND m5 >= 100 THEN 'ACTIVE' WHEN state = 'NEW'
      AND liq >= 1000 THEN 'WATCH' WHEN state = 'ACTIVE' AND m5 <= 25 THEN 'FADING'
      WHEN state = 'WATCH' AND m5 <= 10 THEN 'FADING' WHEN state = 'FADING' AND h1 <= 10 AND liq <= 100 THEN 'DORMANT' WHEN state = 'DORMANT'
        AND m5 >= 100 AND liq >= 500 THEN 'RESURRECTED' ELSE state END AS n
    FROM s JOIN o ON o.user_id = s.user_id AND o.k = s.k + 1))
SELECT user_id, arg_max(state, k) AS state, max(changes)::BIGINT AS changes FROM s GROUP BY 1
""")
def q40_lifecycle_replay(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumns({"h1": F.col("value") * 2, "liq": F.col("value") * 5})
    return policies.replay_lifecycle(e, ["user_id"], ["ts", "event_id"], {"volume_m5": "value", "volume_h1": "h1", "liquidity": "liq"})


@query("""
WITH q AS (SELECT user_id, epoch_us(ts) / 1000000.0 AS t FROM events WHERE value >= 100),
f AS (SELECT *, CASE WHEN t >= lag(t) OVER (PARTITION BY user_id ORDER BY t) + 86400 OR lag(t) OVER (PARTITION BY user_id
  ORDER BY t) IS NULL THEN 1 ELSE 0 END AS n FROM q),
i AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM f)
SELECT user_id AS key, min(t)::DOUBLE AS started, (max(t) + 86400)::DOUBLE AS ended, count(*) - 1 AS renewals FROM i GROUP BY user_id, k
""")
def q41_tier_simulation(spark, sf_dir):
    return policies.simulate_tiers(Tables(spark, sf_dir).events, "user_id", micros("ts") / MICROS, "value", policies.TierPolicy(100, 86400))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT 'o' || l_orderkey AS o, 's' || l_suppkey AS s FROM lineitem),
b AS (SELECT o AS x, s AS y FROM e UNION ALL SELECT s, o FROM e),
r(node, component) USING KEY (node) AS (
  SELECT DISTINCT x, x FROM b
  UNION (SELECT u.node, min(v.component) FROM recurring.r AS u JOIN b ON b.x = u.node JOIN r AS v ON v.node = b.y
    WHERE v.component < u.component GROUP BY u.node))
SELECT node, component FROM r
""")
def q42_wallet_clusters(spark, sf_dir):
    """Clusters of orders and suppliers that deliveries link."""
    e = Tables(spark, sf_dir).lineitem
    edges = e.select(F.concat(F.lit("o"), F.col("l_orderkey")).alias("a"), F.concat(F.lit("s"), F.col("l_suppkey")).alias("b"))
    return graph.connected_components(edges, "a", "b")


@query("""
WITH x AS (SELECT event_id, event_type, (props->>'k')::INT AS k, '{"view": 5, "click": 10, "purchase": 60}'::JSON AS snapshot FROM events)
SELECT event_id, k, (snapshot->>event_type)::INT AS interval_seconds FROM x
""")
def q43_json_extract_dynamic(spark, sf_dir):
    x = Tables(spark, sf_dir).events.withColumn("snapshot", F.from_json(F.lit('{"view": 5, "click": 10, "purchase": 60}'), "map<string,int>"))
    return x.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.try_element_at("snapshot", "event_type").alias("interval_seconds"))


@query("""
WITH s AS (SELECT *, coalesce(sign(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)), 0) AS s FROM events),
f AS (SELECT *, CASE WHEN s <> coalesce(lag(s) OVER (PARTITION BY user_id ORDER BY ts, event_id), 9) THEN 1 ELSE 0 END AS n FROM s),
i AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM f)
SELECT event_id, CASE WHEN s = 0 THEN 0 ELSE row_number() OVER (PARTITION BY user_id, k ORDER BY ts, event_id) END::INT AS run_length FROM i
""")
def q44_run_length_sign(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    moved = e.withColumn("_d", F.signum(F.col("value") - F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))))
    return windows.trailing_run(moved, ["user_id"], F.col("_d"), "ts", "event_id").select("event_id", "run_length")


@query(_PATH + """
, m AS (SELECT 'crossed_up50' AS label, CASE WHEN up50 IS NOT NULL THEN 'TRUE' WHEN complete THEN 'FALSE' ELSE 'UNKNOWN' END AS state FROM l
  UNION ALL SELECT 'crossed_down50', CASE WHEN down50 IS NOT NULL THEN 'TRUE' WHEN complete THEN 'FALSE' ELSE 'UNKNOWN' END FROM l)
SELECT label, state, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY label), 6) AS share FROM m GROUP BY 1, 2
""")
def q45_quality_report(spark, sf_dir):
    long = _day_labels(spark, sf_dir).unpivot(["event_id"], ["crossed_up50", "crossed_down50"], "label", "state")
    n = long.groupBy("label", "state").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.round(ratio("n", F.sum("n").over(Window.partitionBy("label"))), 6))


@query("SELECT event_id, user_id, value, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'cold' ELSE 'hot' END AS side FROM events")
def q46_hot_cold_union(spark, sf_dir):
    from tidemark.sources.tables import hot_cold

    e = Tables(spark, sf_dir).events
    cold = e.filter("ts < timestamp_ntz'2024-01-18 00:00:00'")
    hot = e.filter("ts >= timestamp_ntz'2024-01-12 00:00:00'")
    return hot_cold(cold, hot, "ts", "2024-01-15", "event_id").select("event_id", "user_id", "value", "side")


@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def q47_union_distinct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.customer.select(F.col("c_nationkey").alias("nationkey")).union(t.supplier.select("s_nationkey")).distinct()


@query("""
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW),
  4) AS spent_24h FROM events
""")
def q48_rolling_budget(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumn("_us", micros("ts"))
    return windows.rolling_sum(e, ["user_id"], "_us", F.col("value"), 24 * H * MICROS, "spent").select("event_id", F.round("spent", 4).alias("spent_24h"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids, round(sum(value), 4) AS total FROM events GROUP BY 1")
def q49_streaming_dedupe(spark, sf_dir):
    from tidemark.streaming.events import deduplicated_twice

    return deduplicated_twice(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"),
        F.round(F.sum("value"), 4).alias("total"))


@query("SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def q50_stream_tumbling(spark, sf_dir):
    from tidemark.streaming.events import closed

    return closed(spark, sf_dir, "5 minutes", flush=True).select(F.col("bucket_start").cast("timestamp_ntz").alias("bucket_start"), "n",
        F.round("total", 4).alias("total"))


@query("""
WITH h AS (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1996-01-02 23:00:00', INTERVAL 1 HOUR)) AS hour),
s AS (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS till FROM orders)
SELECT hour, count(o_orderkey) AS pending FROM h LEFT JOIN s ON o_orderstatus = 'O' AND o_orderdate < hour + INTERVAL 1 HOUR
  AND (till IS NULL OR till >= hour + INTERVAL 1 HOUR) GROUP BY 1
""")
def q51_pending_by_hour(spark, sf_dir):
    from tidemark.plans.report import pending_by_hour

    o = Tables(spark, sf_dir).orders.select("o_custkey", "o_orderdate", "o_orderstatus", F.col("o_orderkey").alias("id"))
    spine = spark.sql("SELECT explode(sequence(timestamp_ntz'1996-01-01 00:00:00', timestamp_ntz'1996-01-02 23:00:00', INTERVAL 1 HOUR)) AS hour")
    return pending_by_hour(o, spine, "o_custkey", "o_orderdate", "o_orderstatus", "O")


@query("""
SELECT event_id, minute, k::INT AS turn FROM (
  SELECT event_id, date_trunc('minute', ts) AS minute, row_number() OVER (PARTITION BY date_trunc('minute', ts) ORDER BY ts, event_id,
    user_id) AS k FROM events) WHERE k <= 2
""")
def q52_bounded_wakeups(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumn("minute", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    turn = F.row_number().over(Window.partitionBy("minute").orderBy("ts", "event_id", "user_id"))
    return e.select("event_id", "minute", turn.alias("turn")).filter("turn <= 2")


@query("""
WITH d AS (SELECT l_suppkey, date_trunc('month', l_shipdate) AS m, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
c AS (SELECT l_suppkey, m, sum(n) OVER w AS rows, sum(q) OVER w AS size FROM d WINDOW w AS (PARTITION BY l_suppkey ORDER BY m ROWS UNBOUNDED PRECEDING)),
l AS (SELECT *, rows - lag(rows) OVER w AS more, size - lag(size) OVER w AS bytes,
  (epoch_us(m) - epoch_us(lag(m) OVER w)) / 60000000.0 AS minutes FROM c WINDOW w AS (PARTITION BY l_suppkey ORDER BY m))
SELECT l_suppkey, m, round(more / minutes, 9) AS rows_per_minute, round(CASE WHEN more > 0 THEN bytes / more END, 6) AS bytes_per_row FROM l
""")
def q53_storage_deltas(spark, sf_dir):
    from tidemark.plans.report import storage_deltas

    d = Tables(spark, sf_dir).lineitem.groupBy("l_suppkey",
        F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("m")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    w = Window.partitionBy("l_suppkey").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    c = d.select("l_suppkey", "m", F.sum("n").over(w).alias("rows"), F.sum("q").over(w).alias("size"))
    return storage_deltas(c, "l_suppkey", "m", "rows", "size").select("l_suppkey", "m", F.round("rows_per_minute", 9).alias("rows_per_minute"),
        F.round("bytes_per_row", 6).alias("bytes_per_row"))


@query("""
WITH x AS (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS n FROM events)
SELECT event_id, round(n - last_value(n IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING
  AND 1 PRECEDING), 6) AS growth FROM x
""")
def q54_growth_since_last_known(spark, sf_dir):
    x = Tables(spark, sf_dir).events.withColumn("n", F.when(F.col("event_type") != "error", F.col("value")))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    return x.select("event_id", F.round(F.col("n") - F.last("n", ignorenulls=True).over(w), 6).alias("growth"))


@query("""
WITH head AS (SELECT n_regionkey AS chain FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  WHERE o_orderstatus = 'O' ORDER BY o_orderpriority, o_orderdate, o_orderkey LIMIT 1)
SELECT o_orderkey, o_orderpriority FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN head ON chain = n_regionkey
WHERE o_orderstatus = 'O' ORDER BY o_orderpriority, o_orderdate, o_orderkey LIMIT 30
""")
def q55_priority_claim(spark, sf_dir):
    """The due work of one chain only: that of the head of the queue; at most 30 in order."""
    t = Tables(spark, sf_dir)
    due = t.orders.filter("o_orderstatus = 'O'").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t.nation),
        F.col("c_nationkey") == F.col("n_nationkey"))
    order = ["o_orderpriority", "o_orderdate", "o_orderkey"]
    head = due.orderBy(*order).limit(1).select("n_regionkey")
    return due.join(F.broadcast(head), "n_regionkey", "left_semi").orderBy(*order).limit(30).select("o_orderkey", "o_orderpriority")


@query("""
WITH l AS (SELECT c_custkey, max(o_orderdate) AS last_scan FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT c_custkey, last_scan FROM l ORDER BY last_scan ASC NULLS FIRST, c_custkey LIMIT 25
""")
def q56_control_rotation(spark, sf_dir):
    t = Tables(spark, sf_dir)
    scanned = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_scan"))
    return t.customer.join(scanned, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey",
        "last_scan").orderBy(F.col("last_scan").asc_nulls_first(), "c_custkey").limit(25)


@query("""
WITH s AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1), d AS (SELECT *, unnest(generate_series(date_trunc('day', a),
  date_trunc('day', b), INTERVAL 1 DAY)) AS day FROM s)
SELECT user_id, greatest(day, a) AS slice_start, least(day + INTERVAL 1 DAY, b) AS slice_end FROM d WHERE greatest(day, a) < least(day + INTERVAL 1 DAY, b)
""")
def q57_daily_slices(spark, sf_dir):
    """Each key's range, cut at midnights."""
    s = Tables(spark, sf_dir).events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    midnight = lambda c: F.date_trunc("day", c).cast("timestamp_ntz")
    d = s.withColumn("day", F.explode(F.sequence(midnight("a"), midnight("b"), F.expr("INTERVAL 1 DAY"))))
    return d.select("user_id", F.greatest("day", "a").alias("slice_start"),
        F.least(F.col("day") + F.expr("INTERVAL 1 DAY"), "b").alias("slice_end")).filter("slice_start < slice_end")


@query("""
WITH n AS (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_partkey, round(100.0 * max(n) / sum(n), 6) AS common_funder_share FROM n GROUP BY 1
""")
def q58_common_funder(spark, sf_dir):
    from tidemark.plans.security import common_funder_share

    f = Tables(spark, sf_dir).lineitem.select("l_partkey", F.col("l_suppkey").alias("source_wallet"))
    return common_funder_share(f, ["l_partkey"]).select("l_partkey", F.round("common_funder_share", 6).alias("common_funder_share"))


@query("""
WITH x AS (SELECT event_id, user_id, ts, value, lag(value) OVER w AS previous, first_value(ts) OVER w AS first_at FROM events
  WHERE event_type = 'click' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT p.event_id, x.value AS latest, x.previous, ((epoch_us(p.ts) - epoch_us(x.first_at)) / 1000000.0)::DOUBLE AS since_first FROM p ASOF LEFT
  JOIN x ON x.user_id = p.user_id AND x.ts <= p.ts
""")
def q59_latest_previous_first(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    clicks = e.filter("event_type = 'click'").withColumns({"previous": F.lag("value").over(w), "first_at": F.min("ts").over(w)})
    found = asof.asof_join(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), clicks, ["user_id"], "ts", "ts",
        ["value", "previous", "first_at"], tie="event_id", prefix="c_")
    return found.select("event_id", F.col("c_value").alias("latest"), F.col("c_previous").alias("previous"),
        seconds_between("c_first_at", "ts").alias("since_first"))


@query("""
SELECT a.s_suppkey AS wanted, b.c_custkey AS found, CASE WHEN b.c_custkey = a.s_suppkey THEN 'base' ELSE 'quote' END AS side
FROM supplier a JOIN customer b ON b.c_custkey = a.s_suppkey OR b.c_nationkey = a.s_suppkey
""")
def q60_either_side_match(spark, sf_dir):
    """A disjunction of equalities as two equality joins; what both sides match comes once."""
    t = Tables(spark, sf_dir)
    a, b = t.supplier.select(F.col("s_suppkey").alias("wanted")), t.customer.select("c_custkey", "c_nationkey")
    base = a.join(b, F.col("wanted") == F.col("c_custkey")).withColumn("side", F.lit("base"))
    quote = a.join(b, F.col("wanted") == F.col("c_nationkey")).filter("c_custkey <> wanted").withColumn("side", F.lit("quote"))
    return base.unionByName(quote).select("wanted", F.col("c_custkey").alias("found"), "side")


@query("""
WITH a AS (SELECT user_id, min(ts) AS t FROM events GROUP BY 1)
SELECT user_id, o AS offset_seconds, t + to_seconds(o) AS due_at FROM a, (SELECT unnest([0, 3600, 86400, 604800]) AS o)
""")
def q61_revisit_plan(spark, sf_dir):
    a = Tables(spark, sf_dir).events.groupBy("user_id").agg(F.min("ts").alias("t"))
    each = a.select("user_id", "t", F.explode(F.array(*[F.lit(o) for o in (0, 3600, 86400, 604800)])).alias("offset_seconds"))
    return each.select("user_id", "offset_seconds", (F.col("t") + F.make_dt_interval(secs=F.col("offset_seconds").cast("decimal(18,6)"))).alias("due_at"))


@query("""
WITH w AS (SELECT l_suppkey AS t, o_custkey AS w, CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side, l_extendedprice AS v
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
a AS (SELECT t, count(*) AS total_trades, count(*) FILTER (WHERE side = 'BUY') AS buy_trades, count(DISTINCT CASE
  WHEN side = 'BUY' THEN w END) AS unique_buyers, count(DISTINCT w) AS unique_traders,
  round(median(v), 4) AS median_trade_usd FROM w GROUP BY 1),
p AS (SELECT t, w, count(*) AS n, sum(v) AS v, bool_or(side = 'BUY') AS b, bool_or(side = 'SELL') AS s FROM w GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY v DESC, w) AS k FROM p),
z AS (SELECT t, round(100 * sum(v) FILTER (WHERE k <= 10) / sum(v), 6) AS top_10_trader_volume_share, round(coalesce(sum(n) FILTER (WHERE n > 1),
  0) / sum(n), 6) AS repeat_trader_ratio,
  round(count(*) FILTER (WHERE b AND s) / count(*), 6) AS buy_sell_wallet_overlap FROM r GROUP BY 1)
SELECT t AS token_id, total_trades, buy_trades, unique_buyers, unique_traders, median_trade_usd, top_10_trader_volume_share, repeat_trader_ratio,
  buy_sell_wallet_overlap FROM a JOIN z USING (t)
""")
def q62_trader_distribution(spark, sf_dir):
    from tidemark.plans.security import trader_metrics

    t = Tables(spark, sf_dir)
    trades = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").alias("token_id"), F.col("o_custkey").alias("wallet"),
        F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("side"), F.col("l_extendedprice").alias("notional_usd")
    )
    rounded = {c: F.round(c, d) for c, d in (("median_trade_usd", 4), ("top_10_trader_volume_share", 6), ("repeat_trader_ratio", 6),
        ("buy_sell_wallet_overlap", 6))}
    return trader_metrics(trades).withColumns(rounded).select("token_id", "total_trades", "buy_trades", "unique_buyers", "unique_traders", *rounded)


@query("""
WITH h AS (SELECT l_partkey AS p, l_suppkey AS o, sum(l_quantity) AS q, sum(CASE WHEN l_returnflag <> 'A' THEN l_quantity END) AS out, sum(CASE
  WHEN l_linestatus = 'F' THEN l_quantity END) AS c FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY q DESC, 'w' || o) AS k FROM h), s AS (SELECT p_partkey AS p, p_size * 100 AS supply FROM part)
SELECT s.p AS token_id, round(100 * coalesce(sum(q) FILTER (WHERE k <= 1), 0) / supply, 6) AS top_1_pct, round(100 * coalesce(sum(q)
  FILTER (WHERE k <= 10), 0) / supply, 6) AS top_10_pct,
  round(100 * coalesce(max(out), 0) / supply, 6) AS largest_non_pool_holder_pct, round(CASE WHEN sum(c) > 0 THEN 100 * sum(c) / supply END,
    6) AS creator_holder_pct,
  round(100 * coalesce(sum(q), 0) / supply, 6) AS covered_supply_pct, round(CASE WHEN s.p % 2 = 0 THEN coalesce(sum(q * q), 0) / supply / supply END, 12) AS hhi
FROM s LEFT JOIN r ON r.p = s.p GROUP BY s.p, supply
""")
def q63_holder_metrics(spark, sf_dir):
    from tidemark.plans.security import holder_metrics

    t = Tables(spark, sf_dir)
    accounts = t.lineitem.select(
        F.col("l_partkey").alias("token_id"), F.concat(F.lit("w"), F.col("l_suppkey")).alias("owner_wallet"), F.lit("x").alias("token_account"),
        F.col("l_quantity").alias("raw_balance"),
        (F.col("l_returnflag") == "A").alias("is_known_pool"), (F.col("l_linestatus") == "F").alias("is_creator"),
    )
    supplies = t.part.select(F.col("p_partkey").alias("token_id"), (F.col("p_size") * 100).alias("supply"), (F.col("p_partkey") % 2 == 0).alias("complete"))
    m = holder_metrics(accounts, supplies)
    return m.select("token_id", *[F.round(c, 6).alias(c) for c in ("top_1_pct", "top_10_pct", "largest_non_pool_holder_pct", "creator_holder_pct",
        "covered_supply_pct")], F.round("hhi", 12).alias("hhi"))


@query("""
WITH x AS (SELECT *, CASE WHEN l_discount > 0 THEN l_extendedprice END AS liq FROM lineitem),
g AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS pairs, count(*) FILTER (WHERE liq IS NULL) AS unknown, arg_max(l_linenumber, {'l': liq,
  'c': -l_linenumber}) FILTER (WHERE liq IS NOT NULL) AS best, any_value(l_linenumber) AS only_one FROM x GROUP BY 1)
SELECT l_orderkey, CASE WHEN pairs = 1 THEN only_one WHEN unknown > 0 THEN NULL ELSE best END AS selected, CASE WHEN pairs = 1 THEN 'ONLY_PAIR'
  WHEN unknown > 0 THEN 'UNKNOWN_LIQUIDITY' ELSE 'HIGHEST_LIQUIDITY' END AS reason FROM g
""")
def q64_evidence_pair(spark, sf_dir):
    """The pair with most liquidity; with several pairs one unknown liquidity makes the choice unknown; ties go to the smaller id."""
    x = Tables(spark, sf_dir).lineitem.withColumn("liq", F.when(F.col("l_discount") > 0, F.col("l_extendedprice")))
    g = x.groupBy("l_orderkey").agg(
        F.count_distinct("l_linenumber").alias("pairs"), F.count_if(F.col("liq").isNull()).alias("unknown"),
        F.max_by("l_linenumber", F.when(F.col("liq").isNotNull(), F.struct(F.col("liq"), -F.col("l_linenumber")))).alias("best"),
        F.first("l_linenumber").alias("only_one")
    )
    one = F.col("pairs") == 1
    return g.select(
        "l_orderkey", F.when(one, F.col("only_one")).when(F.col("unknown") == 0, F.col("best")).alias("selected"),
        F.when(one, "ONLY_PAIR").when(F.col("unknown") > 0, "UNKNOWN_LIQUIDITY").otherwise("HIGHEST_LIQUIDITY").alias("reason"),
    )


@query("""
WITH a AS (
  SELECT event_id, CASE event_type WHEN 'purchase' THEN 'ACTIVE' WHEN 'click' THEN 'FADING' WHEN 'signup' THEN 'WATCH'
    WHEN 'error' THEN 'DORMANT' ELSE 'NEW' END AS state,
    (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY user_id))) / 1000000.0 AS age,
      (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1000000.0 AS in_state FROM events),
c AS (
  SELECT *, CASE state WHEN 'ACTIVE' THEN 'PROTECTED_ACTIVE' WHEN 'WATCH' THEN 'PROTECTED_WATCH' WHEN 'DORMANT' THEN 'RETIRED_CONTROL'
    WHEN 'FADING' THEN CASE WHEN in_state IS NULL THEN NULL WHEN in_state < 1800 THEN 'FADING_TAIL' WHEN in_state < 21600 THEN 'FADING_COOL'
      ELSE 'RETIRED_CONTROL' END
    ELSE CASE WHEN age >= 604800 THEN 'RETIRED_CONTROL' WHEN age >= 86400 THEN 'LONG_TAIL_WEEK' WHEN age >= 21600 THEN 'LONG_TAIL_DAY'
      WHEN age >= 3600 THEN 'COOLED' WHEN age >= 600 THEN 'MATURE'
      WHEN age >= 120 THEN 'EARLY' ELSE 'INITIAL' END END AS coverage FROM a)
SELECT event_id, coverage, CASE coverage WHEN 'PROTECTED_ACTIVE' THEN 5 WHEN 'PROTECTED_WATCH' THEN 15 WHEN 'FADING_TAIL' THEN 120
  WHEN 'FADING_COOL' THEN 1800 WHEN 'INITIAL' THEN 15 WHEN 'EARLY' THEN 30
    WHEN 'MATURE' THEN 300 WHEN 'COOLED' THEN 1800 WHEN 'LONG_TAIL_DAY' THEN 7200 WHEN 'LONG_TAIL_WEEK' THEN 43200 END AS interval_seconds,
  (CASE coverage WHEN 'FADING_TAIL' THEN 1800 - in_state WHEN 'FADING_COOL' THEN 21600 - in_state WHEN 'INITIAL' THEN 120 - age
    WHEN 'EARLY' THEN 600 - age WHEN 'MATURE' THEN 3600 - age
    WHEN 'COOLED' THEN 21600 - age WHEN 'LONG_TAIL_DAY' THEN 86400 - age WHEN 'LONG_TAIL_WEEK' THEN 604800 - age END)::DOUBLE AS seconds_left FROM c
""")
def q65_coverage_by_state(spark, sf_dir):
    """Class, interval and time left of each observation, from the state it brings about and the time in it."""
    e = Tables(spark, sf_dir).events
    state = F.create_map(*[F.lit(x) for x in ("purchase", "ACTIVE", "click", "FADING", "signup", "WATCH", "error", "DORMANT")])[F.col("event_type")]
    user = Window.partitionBy("user_id")
    aged = e.select(
        "event_id", F.coalesce(state, F.lit("NEW")).alias("state"), seconds_between(F.min("ts").over(user), "ts").alias("age"),
        seconds_between(F.lag("ts").over(user.orderBy("ts", "event_id")), "ts").alias("in_state")
    )
    classed = aged.withColumn("coverage", policies.coverage_for(F.col("state"), F.col("age"), F.col("in_state")))
    left = policies.seconds_to_transition(F.col("coverage"), F.col("age"), F.col("in_state"))
    return classed.select("event_id", "coverage", policies.interval_for(F.col("coverage")).alias("interval_seconds"), left.alias("seconds_left"))


@query("""
WITH r AS (SELECT o_orderdate AS a, l_shipdate AS b, CASE WHEN l_linenumber < 4 THEN 200 WHEN l_linenumber = 4 THEN 429
  WHEN l_linenumber = 5 THEN 404 ELSE 500 END AS status, l_returnflag AS outcome, l_linenumber AS attempts
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
rs AS (SELECT count(*) AS total, count(*) FILTER (WHERE status = 200) AS http_200, count(*) FILTER (WHERE status = 429) AS http_429, count(*)
  FILTER (WHERE status BETWEEN 400 AND 499 AND status <> 429) AS http_other_4xx,
  count(*) FILTER (WHERE status >= 500) AS http_5xx, sum(attempts - 1) AS retries, quantile_cont((epoch_us(b) - epoch_us(a)) / 1000.0,
    0.5) AS p50_latency_ms, quantile_cont((epoch_us(b) - epoch_us(a)) / 1000.0, 0.95) AS p95_latency_ms,
  quantile_cont((epoch_us(b) - epoch_us(a)) / 1000.0, 0.99) AS p99_latency_ms, (SELECT max(n) FROM (SELECT count(*) AS n FROM r
    GROUP BY date_trunc('minute', a))) AS peak_per_minute FROM r),
l AS (SELECT o_custkey AS t, o_orderdate AS at, o_orderstatus AS s, lag(o_orderstatus) OVER w AS p,
  (epoch_us(lead(o_orderdate) OVER w) - epoch_us(o_orderdate)) / 1000000.0 AS stay FROM orders WINDOW w AS (PARTITION BY o_custkey
  ORDER BY o_orderdate, o_orderkey)),
k AS (SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS pairs FROM events GROUP BY 1),
ks AS (SELECT sum(n) AS rows, count(*) AS tokens, quantile_cont(n, 0.5) AS per_token_p50, quantile_cont(n, 0.95) AS per_token_p95, count(*)
  FILTER (WHERE pairs > 1) AS multi_pair_tokens FROM k)
SELECT section, name, measure, round(value, 6) AS value FROM (
  SELECT 'requests' AS section, 'all' AS name, measure, value FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM rs) ON COLUMNS(*) INTO NAME measure VALUE value)
  UNION ALL SELECT 'request_outcomes', outcome, 'requests', count(*)::DOUBLE FROM r GROUP BY outcome
  UNION ALL SELECT 'lifecycle_changes', coalesce(p, '') || '>' || s, 'changes', count(*)::DOUBLE FROM l GROUP BY 2
  UNION ALL SELECT 'lifecycle_residence', s, 'median_seconds', quantile_cont(stay, 0.5)::DOUBLE FROM l WHERE stay IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'observations', 'all', measure, value FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM ks) ON COLUMNS(*) INTO NAME measure VALUE value))
""")
def q66_window_summary(spark, sf_dir):
    """Figures of a window that covers all facts: requests, state changes and stays, observations."""
    from tidemark.plans.validation import summary

    t = Tables(spark, sf_dir)
    n = F.col("l_linenumber")
    along = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    families = {
        "requests": t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
            F.col("o_orderdate").alias("requested_at"), F.col("l_shipdate").alias("received_at"),
            F.when(n < 4, 200).when(n == 4, 429).when(n == 5, 404).otherwise(500).alias("status"), F.col("l_returnflag").alias("outcome"), n.alias("attempts")
        ),
        "lifecycle": t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("token_id"), F.col("o_orderdate").alias("decided_at"),
        F.lag("o_orderstatus").over(along).alias("previous_state"), F.col("o_orderstatus").alias("new_state")),
        "observations": t.events.select(F.col("user_id").alias("token_id"), F.col("event_type").alias("pair_id"), F.col("ts").alias("received_at")),
    }
    return summary(families, "2030-01-01 00:00:00", 24 * 366 * 60).withColumn("value", F.round("value", 6))

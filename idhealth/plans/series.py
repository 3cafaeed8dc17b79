"""Series queries: months of orders, hours of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idhealth.functions.times import micros, month
from idhealth.operators import series as s

from .catalog import query, read
from .traffic import MESSAGES_SQL, messages

HOUR = 3_600_000_000


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(month(F.col("o_orderdate")).alias("month"), F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("custkey"), F.lit(1).cast("long").alias("n"))


_MONTHS = "o AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS priority, o_custkey AS custkey, 1 AS n FROM orders), g AS (SELECT strftime(unnest(generate_series((min(month) || '-01')::DATE, (max(month) || '-01')::DATE, INTERVAL 1 MONTH)), '%Y-%m') AS month FROM o)"


@query("month_vector", f"""WITH {_MONTHS}, c AS (SELECT custkey, month, sum(n)::BIGINT AS v FROM o WHERE custkey % 10 = 1 GROUP BY ALL), k AS (SELECT DISTINCT custkey FROM c)
SELECT custkey, array_to_string(list(coalesce(v, 0) ORDER BY g.month), ',') AS vector FROM k CROSS JOIN (SELECT * FROM g WHERE month BETWEEN (SELECT min(month) FROM c) AND (SELECT max(month) FROM c)) g LEFT JOIN c USING (custkey, month) GROUP BY custkey
""".replace(" WHERE custkey % 10 = 1", ""))
def month_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = s.month_vector(monthly(spark, sf_dir), "custkey", "month", "n")
    return v.select("custkey", F.array_join(F.transform("vector", lambda x: x.cast("string")), ",").alias("vector"))


@query("current_and_average", f"""WITH {_MONTHS}, l AS (SELECT max(month) AS last, count(*) - 1 AS n FROM g)
SELECT custkey, sum(CASE WHEN month = last THEN n ELSE 0 END)::BIGINT AS current, round(sum(CASE WHEN month < last THEN n ELSE 0 END)::DOUBLE / any_value(k), 9) AS average
FROM (SELECT o.custkey, o.month, o.n, l.last, l.n AS k FROM o, l) GROUP BY custkey
""")
def current_and_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.current_and_average(monthly(spark, sf_dir), "custkey", "month", "n").withColumn("average", F.round("average", 9))


@query("publish_json", f"""WITH {_MONTHS}, c AS (SELECT priority, month, sum(n)::BIGINT AS v FROM o GROUP BY ALL), k AS (SELECT DISTINCT priority FROM c)
SELECT '{{"metric":"' || priority || '","values":[' || array_to_string(list(coalesce(v, 0) ORDER BY g.month), ',') || ']}}' AS json FROM k CROSS JOIN g LEFT JOIN c USING (priority, month) GROUP BY priority
""")
def publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = s.month_vector(monthly(spark, sf_dir), "priority", "month", "n")
    return v.select(F.to_json(F.struct(F.col("priority").alias("metric"), F.col("vector").alias("values"))).alias("json"))


@query("latest_per", "SELECT o_custkey AS custkey, strftime(o_orderdate, '%Y-%m') AS month, max((o_orderdate, o_orderkey)).o_orderkey AS o_orderkey FROM orders GROUP BY ALL".replace("max((o_orderdate, o_orderkey)).o_orderkey", "arg_max(o_orderkey, (o_orderdate, o_orderkey))"))
def latest_per(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), month(F.col("o_orderdate")).alias("month"), "o_orderdate", "o_orderkey")
    return s.latest_per(o, ["custkey", "month"], ["o_orderdate", "o_orderkey"]).select("custkey", "month", "o_orderkey")


@query("top_names", f"WITH {_MONTHS}, c AS (SELECT month, priority, count(*) AS v FROM o GROUP BY ALL), h AS (SELECT *, v::DOUBLE / sum(v) OVER (PARTITION BY month) AS share FROM c) SELECT left(month, 4) AS \"group\", priority AS name, round(max(share), 9) AS most, round(sum(share), 6) AS sum FROM h WHERE share > 0.2 GROUP BY ALL")
def top_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from idhealth.operators.counters import shares

    c = monthly(spark, sf_dir).groupBy("month", "priority").agg(F.count("*").alias("v"))
    out = s.top_names(shares(c, ["month"], "v"), F.substring("month", 1, 4), "priority", "share", 0.2)
    return out.select("group", "name", F.round("most", 9).alias("most"), F.round("sum", 6).alias("sum"))


@query("pick_names", "WITH a AS (SELECT p_brand AS name, count(*) AS v FROM part WHERE p_size < 25 GROUP BY 1), b AS (SELECT p_brand AS name, count(*) * 2 AS v FROM part WHERE p_size >= 25 AND p_brand LIKE '%5' GROUP BY 1) SELECT name, v FROM (SELECT * FROM a UNION ALL SELECT * FROM b WHERE name NOT IN (SELECT name FROM a)) ORDER BY v DESC, name LIMIT 3")
def pick_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), "p_size")
    a = p.where("p_size < 25").groupBy("name").agg(F.count("*").alias("v"))
    b = p.where("p_size >= 25 AND name LIKE '%5'").groupBy("name").agg((F.count("*") * 2).alias("v"))
    return s.pick_names(a, b, "name", "v")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour slices of each type of event: queries and NX."""
    m = messages(spark, sf_dir).groupBy("tld", F.floor(F.col("us") / HOUR).alias("slice")).agg(F.count("*").cast("double").alias("queries"), F.sum((F.col("rcode") == 3).cast("double")).alias("nx"))
    return s.slice_grid(m, ["tld"], "slice", ["queries", "nx"])


HOURLY_SQL = MESSAGES_SQL + f""", h AS (SELECT tld, us // {HOUR} AS slice, count(*)::DOUBLE AS queries, sum((rcode = 3)::INT)::DOUBLE AS nx FROM dns GROUP BY ALL),
gr AS (SELECT tld, unnest(range((SELECT min(slice) FROM h), (SELECT max(slice) FROM h) + 1)) AS slice FROM (SELECT DISTINCT tld FROM h)),
f AS (SELECT gr.tld, gr.slice, coalesce(queries, 0) AS queries, coalesce(nx, 0) AS nx FROM gr LEFT JOIN h ON gr.tld = h.tld AND gr.slice = h.slice)
"""


@query("slice_grid", HOURLY_SQL + "SELECT * FROM f")
def slice_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly(spark, sf_dir)


@query("slice_series", MESSAGES_SQL + f""", p AS (SELECT tld, us // {HOUR} AS i, (us - us // {HOUR} * {HOUR}) / {HOUR}.0::DOUBLE AS f FROM dns),
w AS (SELECT tld, i AS slice, CASE WHEN i > 0 THEN 1 - f ELSE 1 END AS w FROM p UNION ALL SELECT tld, i - 1, CASE WHEN i > 0 THEN f ELSE 0 END FROM p)
SELECT tld, slice, round(sum(w) * 2, 6) AS n FROM w WHERE slice >= 0 GROUP BY ALL
""")
def slice_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir).withColumn("n", F.lit(1.0))
    return s.split_slices(m, "us", HOUR // 2, HOUR, ["n"], ["tld"]).withColumn("n", F.round("n", 6))


_SMOOTH = """, b AS (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY tld) AS n, first(queries) OVER (PARTITION BY tld ORDER BY slice) AS a,
       last(queries) OVER (PARTITION BY tld ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS z,
       sum(queries) OVER (PARTITION BY tld ORDER BY slice ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) AS s FROM f WINDOW w AS (PARTITION BY tld ORDER BY slice)),
m AS (SELECT tld, slice, queries, nx, (s + a * greatest(12 - r + 1, 0) + z * greatest(r + 12 - n, 0)) / 25 AS smooth FROM b)
"""


@query("smooth", HOURLY_SQL + _SMOOTH + "SELECT tld, slice, round(smooth, 9) AS smooth FROM m")
def smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.smooth(hourly(spark, sf_dir), ["tld"], "slice", "queries").select("tld", "slice", F.round("smooth", 9).alias("smooth"))


@query("quiet_slice", HOURLY_SQL + ", a AS (SELECT slice, sum(queries) AS q FROM f GROUP BY slice), d AS (SELECT slice % 24 AS slice, avg(q) AS mean FROM a GROUP BY 1) SELECT slice, round(mean, 9) AS mean FROM d ORDER BY d.mean, slice LIMIT 1")
def quiet_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = hourly(spark, sf_dir).groupBy("slice").agg(F.sum("queries").alias("q"))
    return s.quiet_slice(total, "slice", "q", 24).withColumn("mean", F.round("mean", 9))


_ACTIVE = """, t AS (SELECT *, (slice - 6) % 24 < 20 AS inside, (slice - 6) // 24 AS day, queries > avg(queries) OVER (PARTITION BY tld) / 2 AS busy FROM f),
x AS (SELECT *, inside AND bool_or(busy AND inside) OVER (PARTITION BY tld, day) AS active FROM t)
"""


@query("active_mask", HOURLY_SQL + _ACTIVE + "SELECT tld, slice, active FROM x")
def active_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.active_mask(hourly(spark, sf_dir), ["tld"], "slice", "queries", F.lit(6), 20, 24).select("tld", "slice", "active")


def daytime(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = s.active_mask(hourly(spark, sf_dir), ["tld"], "slice", "queries", F.lit(6), 20, 24).where("active")
    return d, s.daytime_stats(d, ["tld"], "queries")


_STATS = """, d AS (SELECT * FROM x WHERE active), q AS (SELECT *, row_number() OVER (PARTITION BY tld ORDER BY queries) - 1 AS r, count(*) OVER (PARTITION BY tld) AS n FROM d),
st AS (SELECT tld, count(*) AS n, avg(queries) AS mean, stddev_pop(queries) AS deviation, max(queries) FILTER (r = n // 4) AS q1, max(queries) FILTER (r = 3 * (n // 4)) AS q3 FROM q GROUP BY tld)
"""


@query("daytime_stats", HOURLY_SQL + _ACTIVE + _STATS + "SELECT tld, n, round(mean, 6) AS mean, round(deviation, 6) AS deviation, q1, q3 FROM st")
def daytime_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = daytime(spark, sf_dir)[1]
    return st.select("tld", "n", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"), "q1", "q3")


@query("outliers", HOURLY_SQL + _ACTIVE + _STATS + "SELECT d.tld, d.slice, d.queries, round(d.queries / st.mean, 6) AS ratio, CASE WHEN d.queries - d.nx >= d.nx THEN 'good' ELSE 'nx' END AS dominant FROM d JOIN st ON d.tld = st.tld WHERE d.queries > greatest(mean + 3 * deviation, 1.0, 2 * mean)")
def outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, st = daytime(spark, sf_dir)
    out = s.outliers(d.withColumn("good", F.col("queries") - F.col("nx")), st, ["tld"], "queries", ["good", "nx"], 1)
    return out.select("tld", "slice", "queries", F.round("ratio", 6).alias("ratio"), "dominant")


@query("evaluation", HOURLY_SQL + _ACTIVE + _STATS + "SELECT x.tld, x.slice, x.queries, CASE WHEN x.active THEN round(st.mean, 6) END AS average, round(greatest(st.mean + 3 * st.deviation, 1.0, 2 * st.mean), 6) AS \"limit\" FROM x LEFT JOIN st ON x.tld = st.tld")
def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = s.active_mask(hourly(spark, sf_dir), ["tld"], "slice", "queries", F.lit(6), 20, 24)
    out = s.evaluation(d, daytime(spark, sf_dir)[1], ["tld"], "slice", "queries", 1)
    return out.select("tld", "slice", "queries", F.round("average", 6).alias("average"), F.round("limit", 6).alias("limit"))


@query("outliers_by_node", HOURLY_SQL + _ACTIVE + _STATS + "SELECT d.tld, count(*) AS outliers, arg_max(d.slice, (d.queries, -d.slice)) AS slice, max(d.queries) AS queries FROM d JOIN st ON d.tld = st.tld WHERE d.queries > greatest(mean + 3 * deviation, 1.0, 2 * mean) GROUP BY d.tld")
def outliers_by_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, st = daytime(spark, sf_dir)
    found = s.outliers(d.withColumn("good", F.col("queries") - F.col("nx")), st, ["tld"], "queries", ["good", "nx"], 1)
    return s.outliers_by_key(found, ["tld"], "queries")


@query("server_groups", MESSAGES_SQL + ", h AS (SELECT client // 8 AS network, hour(ts) AS i, count(*) AS n FROM dns GROUP BY ALL), c AS (SELECT client // 8 AS network, min(client) AS ip, count(DISTINCT client) AS servers FROM dns GROUP BY 1) SELECT network, ip, servers, CASE WHEN network % 2 = 0 THEN network * 10 ELSE 0 END AS users, (SELECT array_to_string(list(coalesce(n, 0) ORDER BY r.i), ',') FROM range(24) r(i) LEFT JOIN h ON h.i = r.i AND h.network = c.network) AS hourly FROM c")
def server_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from idhealth.operators import ipstats

    v = ipstats.vectors(messages(spark, sf_dir), ["client"], {"hourly": (F.hour("ts"), 24)}).withColumnRenamed("client", "ip")
    network = F.expr("ip DIV 8")
    users = v.select(network.alias("network")).distinct().where("network % 2 = 0").withColumn("users", F.col("network") * 10)
    out = ipstats.server_groups(v, network, {"hourly": 24}, users)
    return out.select("network", "ip", "servers", "users", F.array_join(F.transform("hourly", lambda x: x.cast("string")), ",").alias("hourly"))


TYPES = ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW")


@query("trace", MESSAGES_SQL + ", e AS (SELECT client, us // 86400000000 AS day, tld, k FROM dns), gr AS (SELECT client, unnest(range((SELECT min(day) FROM e), (SELECT max(day) FROM e) + 1)) AS day FROM (SELECT DISTINCT client FROM e)) SELECT gr.client, gr.day, " + ", ".join(f"(sum(k) FILTER (tld = '{t}'))::BIGINT AS \"{t}\"" for t in TYPES) + " FROM gr LEFT JOIN e ON gr.client = e.client AND gr.day = e.day GROUP BY ALL")
def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = messages(spark, sf_dir).select("client", F.floor(F.col("us") / 86_400_000_000).alias("day"), "tld", "k")
    return s.trace(e, "client", "day", "tld", TYPES, "k")


@query("hour_day_vectors", MESSAGES_SQL + ", h AS (SELECT client, hour(ts) AS i, count(*) AS n FROM dns GROUP BY ALL), d AS (SELECT client, day(ts) AS i, count(*) AS n FROM dns GROUP BY ALL), c AS (SELECT DISTINCT client FROM dns) SELECT client, (SELECT array_to_string(list(coalesce(n, 0) ORDER BY r.i), ',') FROM range(24) r(i) LEFT JOIN h ON h.i = r.i AND h.client = c.client) AS hourly, (SELECT array_to_string(list(coalesce(n, 0) ORDER BY r.i), ',') FROM range(1, 32) r(i) LEFT JOIN d ON d.i = r.i AND d.client = c.client) AS daily FROM c")
def hour_day_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from idhealth.operators.ipstats import vectors

    v = vectors(messages(spark, sf_dir), ["client"], {"hourly": (F.hour("ts"), 24), "daily": (F.dayofmonth("ts") - 1, 31)})
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return v.select("client", text("hourly"), text("daily"))


@query("merged_vectors", MESSAGES_SQL + ", h AS (SELECT client % 10 AS net, hour(ts) AS i, count(*) AS n FROM dns GROUP BY ALL), c AS (SELECT client % 10 AS net, count(DISTINCT client) AS servers FROM dns GROUP BY 1) SELECT net, servers, (SELECT array_to_string(list(coalesce(n, 0) ORDER BY r.i), ',') FROM range(24) r(i) LEFT JOIN h ON h.i = r.i AND h.net = c.net) AS hourly FROM c")
def merged_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from idhealth.operators.ipstats import merge_vectors, vectors

    v = vectors(messages(spark, sf_dir), ["client"], {"hourly": (F.hour("ts"), 24)}).withColumn("net", F.col("client") % 10)
    m = merge_vectors(v, ["net"], {"hourly": 24}, rows="servers")
    return m.select("net", "servers", F.array_join(F.transform("hourly", lambda x: x.cast("string")), ",").alias("hourly"))


@query("length_table", "SELECT strftime(o_orderdate, '%Y-%m') AS month, " + ", ".join(f"count(*) FILTER (length(o_custkey::VARCHAR) = {i}) AS length_{i}" for i in range(1, 6)) + " FROM orders GROUP BY 1")
def length_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(month(F.col("o_orderdate")).alias("month"), F.concat(F.lit("length_"), F.length(F.col("o_custkey").cast("string")).cast("string")).alias("k"), F.lit(1).cast("long").alias("n"))
    return s.pivot_series(o, "month", "k", [f"length_{i}" for i in range(1, 6)], "n")

"""Traffic queries: DNS messages are bound to the events table (client, ts, tld, rcode, qtype)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idhealth.functions.times import micros, month
from idhealth.operators import counters, usage

from .catalog import query, read

HOUR = 3_600_000_000
#: Upper edges of the delay buckets in hours.
EDGES = (1, 6, 12, 24, 48, 72, 96, 120, 240)

MESSAGES_SQL = """
WITH dns AS (
  SELECT event_id AS msg_id, user_id AS client, epoch_us(ts) AS us, ts, upper(event_type) AS tld,
         CASE WHEN event_id % 5 = 0 THEN 3 ELSE 0 END AS rcode, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value
  FROM events)
"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message per event."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("msg_id"), F.col("user_id").alias("client"), micros(F.col("ts")).alias("us"), "ts", F.upper("event_type").alias("tld"),
        F.when(F.col("event_id") % 5 == 0, 3).otherwise(0).alias("rcode"), F.get_json_object("props", "$.k").cast("long").alias("k"), "value",
    )


def used(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir).withColumn("flags", F.expr("shiftleft(1L, CAST(k % 8 AS INT))"))
    return usage.usage(m.withColumn("nx", (F.col("rcode") == 3).cast("int")), ["client", "tld"], "us", ["us", "msg_id"], "flags", "nx")


USAGE_SQL = MESSAGES_SQL + """
, g AS (SELECT *, us - lag(us) OVER (PARTITION BY client, tld ORDER BY us, msg_id) AS gap FROM dns),
u AS (SELECT client, tld, count(*) AS count, min(us) AS first_us, max(us) AS last_us,
             coalesce(min(CASE WHEN gap > 0 THEN gap END), min(gap)) AS min_gap, bit_or((1::BIGINT << (k % 8)::INT)) AS flags,
             arg_min(CASE WHEN rcode = 3 THEN 1 ELSE 0 END, (us, msg_id)) AS is_nx
      FROM g GROUP BY client, tld)
"""


@query("query_usage", USAGE_SQL + "SELECT * FROM u")
def query_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return used(spark, sf_dir)


_CASES = " ".join(f"WHEN gap < {e * HOUR} THEN {i}" for i, e in enumerate(EDGES[:-1]))


@query("cache_efficiency", USAGE_SQL + f"""
, c AS (SELECT client, min(min_gap) AS gap, sum(count)::BIGINT AS load FROM u GROUP BY client),
b AS (SELECT (CASE {_CASES} ELSE {len(EDGES) - 1} END)::INT AS bucket, count(*) AS clients, sum(load)::BIGINT AS load FROM c GROUP BY 1)
SELECT d.i::INT AS bucket, coalesce(clients, 0) AS clients, coalesce(load, 0) AS load,
       (SELECT count(*) FROM u WHERE is_nx = 0) AS pairs, (SELECT (sum(count) - count(*))::BIGINT FROM u WHERE is_nx = 0) AS repeats
FROM range({len(EDGES)}) d(i) LEFT JOIN b ON b.bucket = d.i
""")
def cache_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = used(spark, sf_dir)
    ratio = usage.repeat_ratio(u).where("is_nx = 0").select("pairs", "repeats")
    return usage.delay_buckets(u, "client", [e * HOUR for e in EDGES]).crossJoin(F.broadcast(ratio))  # one row


@query("repeat_ratio", USAGE_SQL + "SELECT is_nx, count(*) AS pairs, (sum(count) - count(*))::BIGINT AS repeats, (sum(count) - count(*))::DOUBLE / sum(count) AS repeat_share FROM u GROUP BY is_nx")
def repeat_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.repeat_ratio(used(spark, sf_dir))


@query("average_delay", USAGE_SQL + "SELECT client, CASE WHEN sum(count - 1) > 0 THEN floor(sum(last_us - first_us)::DOUBLE / sum(count - 1)) ELSE 600000000 END::BIGINT AS mean_us FROM u GROUP BY client")
def average_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.average_delay(used(spark, sf_dir), "client")


@query("client_usage", MESSAGES_SQL + """
, c AS (SELECT client, bool_or(k % 2 = 1) AS dnssec, bool_or(k > 50) AS edns, bool_or(rcode = 3) AS nx FROM dns GROUP BY client)
SELECT feature, count(*) AS clients, sum(used::INT)::BIGINT AS users FROM (
  SELECT 'dnssec' AS feature, dnssec AS used FROM c UNION ALL SELECT 'edns', edns FROM c UNION ALL SELECT 'nx', nx FROM c) GROUP BY feature
""")
def client_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.client_usage(messages(spark, sf_dir), "client", {"dnssec": F.col("k") % 2 == 1, "edns": F.col("k") > 50, "nx": F.col("rcode") == 3})


@query("option_once", MESSAGES_SQL + "SELECT k, count(DISTINCT client) AS clients FROM dns WHERE k IS NOT NULL GROUP BY k")
def option_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.once_per_client(messages(spark, sf_dir), "client", "k")


@query("cap_per_key", MESSAGES_SQL + "SELECT msg_id, client FROM (SELECT *, row_number() OVER (PARTITION BY client ORDER BY us, msg_id) AS r FROM dns) WHERE r <= 32")
def cap_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.cap_per_key(messages(spark, sf_dir), "client", ["us", "msg_id"], 32)[0].select("msg_id", "client")


@query("cap_tally", MESSAGES_SQL + "SELECT client, count(*) - 32 AS dropped FROM dns GROUP BY client HAVING count(*) > 32")
def cap_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.cap_per_key(messages(spark, sf_dir), "client", ["us", "msg_id"], 32)[1]


@query("filter_addresses", MESSAGES_SQL + "SELECT msg_id, client FROM dns WHERE NOT (client % 7 = 0 AND client % 14 <> 0)")
def filter_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir)
    clients = m.select("client").distinct()
    return usage.filter_addresses(m, "client", clients.where("client % 14 = 0"), clients.where("client % 7 = 0")).select("msg_id", "client")


@query("interarrival", MESSAGES_SQL + "SELECT msg_id, us - lag(us) OVER (PARTITION BY client, tld ORDER BY us, msg_id) AS gap FROM dns")
def interarrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.gaps(messages(spark, sf_dir), ["client", "tld"], ["us", "msg_id"], "us").select("msg_id", "gap")


_COUNTS = """
SELECT registry, key, count(*) AS count FROM (
  SELECT 'RETURNFLAG' AS registry, l_returnflag AS key FROM lineitem UNION ALL SELECT 'LINESTATUS', l_linestatus FROM lineitem
  UNION ALL SELECT 'LINENUMBER', l_linenumber::VARCHAR FROM lineitem UNION ALL SELECT 'PART', l_partkey::VARCHAR FROM lineitem) GROUP BY ALL
"""


@query("registry_counts", _COUNTS)
def registry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = {"RETURNFLAG": "l_returnflag", "LINESTATUS": "l_linestatus", "LINENUMBER": "l_linenumber", "PART": "l_partkey"}
    return counters.registry_counts(read(spark, sf_dir, "lineitem"), {k: F.col(v) for k, v in c.items()})


_SHARDS = """
WITH s AS (SELECT strftime(l_shipdate, '%Y-%m') AS shard, 'PART' AS registry, l_partkey::VARCHAR AS key, count(*) AS count FROM lineitem GROUP BY ALL
           UNION ALL SELECT strftime(l_shipdate, '%Y-%m'), 'FLAG', l_returnflag, count(*) FROM lineitem GROUP BY ALL),
"""


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly summaries: parts and return flags."""
    li = read(spark, sf_dir, "lineitem").withColumn("shard", month(F.col("l_shipdate")))
    part = li.groupBy("shard", F.lit("PART").alias("registry"), F.col("l_partkey").cast("string").alias("key")).agg(F.count("*").alias("count"))
    flag = li.groupBy("shard", F.lit("FLAG").alias("registry"), F.col("l_returnflag").alias("key")).agg(F.count("*").alias("count"))
    return part.unionByName(flag)


@query("merge_summaries", _SHARDS + """
r AS (SELECT CASE WHEN registry = 'PART' AND count <= 1 THEN 'LeakByLength' ELSE registry END AS registry,
             CASE WHEN registry = 'PART' AND count <= 1 THEN 'length_' || length(key) ELSE key END AS key, count FROM s),
m AS (SELECT registry, key, sum(count)::BIGINT AS count FROM r GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY registry ORDER BY count DESC, key) AS n FROM m)
SELECT registry, key, sum(count)::BIGINT AS count FROM (
  SELECT CASE WHEN registry = 'PART' AND n > 256 THEN 'LeakByLength' ELSE registry END AS registry,
         CASE WHEN registry = 'PART' AND n > 256 THEN 'length_' || length(key) ELSE key END AS key, count FROM k) GROUP BY ALL
""")
def merge_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.merge_summaries(shards(spark, sf_dir).drop("shard"), ["PART"], 256, 1)


@query("top_with_rest", """
WITH c AS (SELECT l_returnflag AS flag, l_partkey::VARCHAR AS part, count(*) AS count FROM lineitem GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY count DESC, part) AS n FROM c)
SELECT flag, CASE WHEN n <= 128 THEN part ELSE '-- OTHERS --' END AS part, sum(count)::BIGINT AS count FROM k GROUP BY ALL
""")
def top_with_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.col("l_partkey").cast("string").alias("part")).agg(F.count("*").alias("count"))
    return counters.top_with_rest(c, ["flag"], "part", "count", 128)


@query("nx_share", MESSAGES_SQL + "SELECT tld, sum((rcode = 3)::INT)::BIGINT AS nx, count(*) AS queries, round(sum((rcode = 3)::INT)::DOUBLE / count(*), 9) AS share FROM dns GROUP BY tld")
def nx_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir).groupBy("tld").agg(F.sum((F.col("rcode") == 3).cast("long")).alias("nx"), F.count("*").alias("queries"))
    return m.withColumn("share", F.round(counters.share(F.col("nx"), F.col("queries")), 9))


@query("listed_shares", MESSAGES_SQL + """
, c AS (SELECT client, k, count(*) AS count FROM dns GROUP BY ALL),
s AS (SELECT *, count::DOUBLE / sum(count) OVER (PARTITION BY client) AS share, count(*) OVER (PARTITION BY client) AS n FROM c)
SELECT client, k, count, round(share, 9) AS share FROM s WHERE n < 8 OR share >= 0.03
""")
def listed_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = messages(spark, sf_dir).groupBy("client", "k").agg(F.count("*").alias("count"))
    kept = counters.keep_share(counters.shares(c, ["client"], "count"), ["client"], "share", 0.03)
    return kept.withColumn("share", F.round("share", 9))


@query("remainder_shares", MESSAGES_SQL + """
, c AS (SELECT client, tld, count(*) AS count FROM dns GROUP BY ALL),
s AS (SELECT *, count::DOUBLE / sum(count) OVER (PARTITION BY client) AS share FROM c)
SELECT client, round(greatest(0, 1 - sum(CASE WHEN share >= 0.2 THEN share ELSE 0 END)), 9) AS rest FROM s GROUP BY client
""")
def remainder_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = messages(spark, sf_dir).groupBy("client", "tld").agg(F.count("*").alias("count"))
    s = counters.shares(c, ["client"], "count")
    return s.groupBy("client").agg(F.round(counters.remainder(F.lit(1.0), F.sum(F.when(F.col("share") >= 0.2, F.col("share")).otherwise(0.0))), 9).alias("rest"))


@query("adaptive_threshold", MESSAGES_SQL + """
, t AS (SELECT least(sum((rcode = 3)::INT)::DOUBLE / count(*) / 500, 0.001) AS least FROM dns),
c AS (SELECT client, tld, count(*) AS count FROM dns WHERE rcode = 3 GROUP BY ALL),
s AS (SELECT *, count::DOUBLE / sum(count) OVER () AS share, count(*) OVER () AS n FROM c)
SELECT client, tld, count FROM s, t WHERE n < 8 OR share >= least
""")
def adaptive_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir)
    limit = m.agg(F.least(counters.share(F.sum((F.col("rcode") == 3).cast("long")), F.count("*")) / 500, F.lit(0.001)).alias("least"))
    c = m.where("rcode = 3").groupBy("client", "tld").agg(F.count("*").alias("count"))
    total = c.agg(F.sum("count").alias("total"), F.count("*").alias("n"))
    kept = c.crossJoin(F.broadcast(limit.crossJoin(total)))  # one row
    return kept.where((F.col("n") < 8) | (F.col("count") / F.col("total") >= F.col("least"))).select("client", "tld", "count")


@query("parts_distribution", """
WITH p AS (SELECT least(len(string_split(split_part(split_part(url, '/', 3), ':', 1), '.')), 34)::INT AS parts FROM pages)
SELECT d.i::INT AS parts, count(p.parts) AS count, round(count(p.parts)::DOUBLE / (SELECT count(*) FROM p), 9) AS share FROM range(35) d(i) LEFT JOIN p ON p.parts = d.i GROUP BY d.i
""")
def parts_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.split_part(F.split_part("url", F.lit("/"), F.lit(3)), F.lit(":"), F.lit(1))
    p = read(spark, sf_dir, "pages").select(F.size(F.split(host, r"\.")).alias("parts"))
    return counters.parts_distribution(p, "parts").withColumn("share", F.round("share", 9))


@query("registry_coverage", """
WITH c AS (SELECT 'size' AS table_id, p_size AS key, count(*) AS count FROM part GROUP BY ALL UNION ALL SELECT 'line', l_linenumber, count(*) FROM lineitem GROUP BY ALL),
r AS (SELECT 'size' AS table_id, i AS key FROM range(1, 61, 2) t(i) UNION ALL SELECT 'line', i FROM range(1, 6) t(i)),
b AS (SELECT coalesce(c.table_id, r.table_id) AS table_id, r.key IS NOT NULL AS registered, c.count FROM c FULL JOIN r ON c.table_id = r.table_id AND c.key = r.key)
SELECT table_id, round(sum((registered AND count IS NOT NULL)::INT)::DOUBLE / sum(registered::INT), 9) AS seen_share,
       round(sum(CASE WHEN registered THEN 0 ELSE count END)::DOUBLE / sum(count), 9) AS unregistered_share FROM b GROUP BY table_id
""")
def registry_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = read(spark, sf_dir, "part").groupBy(F.lit("size").alias("table_id"), F.col("p_size").cast("long").alias("key")).agg(F.count("*").alias("count"))
    line = read(spark, sf_dir, "lineitem").groupBy(F.lit("line").alias("table_id"), F.col("l_linenumber").cast("long").alias("key")).agg(F.count("*").alias("count"))
    registry = spark.range(1, 61, 2).select(F.lit("size").alias("table_id"), F.col("id").alias("key")).union(spark.range(1, 6).select(F.lit("line"), "id"))
    out = counters.coverage(size.unionByName(line), registry)
    return out.select("table_id", F.round("seen_share", 9).alias("seen_share"), F.round("unregistered_share", 9).alias("unregistered_share"))

"""Leak, volume, report and publication queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from idhealth.functions.times import month
from idhealth.operators import leaks
from idhealth.operators.usage import gaps

from .catalog import query, read
from .names import _NAMES, hosts, made_names
from .series import _MONTHS, monthly
from .statistics import statistics
from .traffic import MESSAGES_SQL, messages


@query("tld_usage", f"""WITH {_NAMES}, t AS (SELECT name, string_split(name, '.')[-1] AS t FROM x),
k AS (SELECT *, translate(t, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS u,
  CASE WHEN regexp_matches(t, '[^\\x21-\\x7E]') THEN '-- BINARY --' WHEN NOT regexp_full_match(t, '[A-Za-z0-9-]+') THEN '-- SYNTAX --'
  WHEN regexp_full_match(t, '-?[0-9]+') AND regexp_matches(name, '(^|\\.)((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\\.){{3}}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$') THEN '-- IPV4 --' WHEN regexp_full_match(t, '-?[0-9]+') THEN '-- NUMBER --' END AS l FROM t),
g AS (SELECT *, u IN ('CLICK', 'VIEW', 'CORP') AS known FROM k)
SELECT 'TLD-Usage-Count' AS registry, known::INT::VARCHAR AS key, count(*) AS count FROM g GROUP BY ALL
UNION ALL SELECT CASE WHEN l IS NULL AND u IN ('EXAMPLE', 'LOCAL') THEN 'RFC6761Usage' ELSE 'Frequent-TLD-usage' END, coalesce(l, u), count(*) FROM g WHERE NOT known GROUP BY ALL
""")
def tld_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    registered = spark.createDataFrame([("CLICK",), ("VIEW",), ("CORP",)], "tld string")
    return leaks.tld_usage(made_names(spark, sf_dir), "name", registered)


@query("sld_leaks", f"""WITH {_NAMES}, s AS (SELECT string_split(name, '.')[-2] AS s FROM x),
c AS (SELECT CASE WHEN s IS NULL THEN '-- NONE --' WHEN regexp_full_match(s, '-?[0-9]+') THEN '-- NUMBER --' ELSE translate(s, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') END AS key, count(*) AS count FROM s GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY starts_with(key, '-- '), count DESC, key) AS n FROM c)
SELECT 'Leaked2ndLD' AS registry, CASE WHEN starts_with(key, '-- ') OR n <= 3 THEN key ELSE '-- OTHERS --' END AS key, sum(count)::BIGINT AS count FROM r GROUP BY ALL
""")
def sld_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.sld_leaks(made_names(spark, sf_dir), "name", 3)


@query("zone_usage", """WITH h AS (SELECT upper(split_part(split_part(url, '/', 3), ':', 1)) AS name, page_id % 3 = 0 AS s FROM pages), l AS (SELECT string_split(name, '.') AS l, s FROM h),
z AS (SELECT array_to_string(l[-least(len(l), 2):], '.') AS zone, bool_or(s) AS signed FROM l GROUP BY 1) SELECT signed, count(*) AS zones FROM z GROUP BY 1""")
def zone_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([("com", "std"), ("net", "std")], "suffix string, kind string")
    own = hosts(spark, sf_dir).withColumn("signed", F.col("page_id") % 3 == 0)
    return leaks.zone_usage(own, "name", "signed", rules)


@query("volumes", MESSAGES_SQL + ", v AS (SELECT k % 3 AS port, count(*) AS packets, sum(k)::BIGINT AS bytes FROM dns GROUP BY 1) SELECT port, packets, bytes, round(bytes::DOUBLE / sum(bytes) OVER (), 9) AS share, (SELECT max(us) - min(us) FROM dns) AS duration_us FROM v")
def volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir).withColumn("port", F.col("k") % 3)
    return leaks.volumes(m, "port", "k", "us").withColumn("share", F.round("share", 9))


@query("fixed_rcodes", MESSAGES_SQL + "SELECT CASE WHEN rcode = 3 AND tld = 'CLICK' THEN 0 ELSE rcode END AS rcode, count(*) AS count FROM dns GROUP BY 1")
def fixed_rcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks stand for ARPA names."""
    m = messages(spark, sf_dir).withColumn("tld", F.when(F.col("tld") == "CLICK", "arpa").otherwise(F.col("tld")))
    return m.groupBy(leaks.fix_arpa(F.col("rcode"), F.col("tld")).alias("rcode")).agg(F.count("*").alias("count"))


@query("address_report", MESSAGES_SQL + ", g AS (SELECT *, us - lag(us) OVER (PARTITION BY client, tld ORDER BY us, msg_id) AS gap FROM dns) SELECT client, tld, count(*) AS count, min(CASE WHEN gap > 0 THEN gap END) AS min_gap FROM g GROUP BY ALL ORDER BY client, tld DESC")
def address_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gaps(messages(spark, sf_dir), ["client", "tld"], ["us", "msg_id"], "us")
    return g.groupBy("client", "tld").agg(F.count("*").alias("count"), F.min(F.when(F.col("gap") > 0, F.col("gap"))).alias("min_gap")).orderBy("client", F.col("tld").desc())


@query("name_report", MESSAGES_SQL + "SELECT tld AS name, count(*) AS count, arg_min(CASE WHEN rcode = 3 THEN 'nx' ELSE 'ok' END, (us, CASE WHEN rcode = 3 THEN 'nx' ELSE 'ok' END)) AS kind, 1 AS parts FROM dns GROUP BY tld")
def name_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.name_report(messages(spark, sf_dir).withColumn("kind", F.when(F.col("rcode") == 3, "nx").otherwise("ok")), "tld", "us", "kind")


@query("presence", "SELECT o_custkey AS partner, bit_or(CASE strftime(o_orderdate, '%Y-%m') WHEN '1998-05' THEN 1 WHEN '1998-04' THEN 2 ELSE 0 END) AS mask FROM orders GROUP BY 1")
def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("partner"), month(F.col("o_orderdate")).alias("month"))
    return leaks.presence(o, "partner", "month", "1998-05", "1998-04")


@query("probe_backfill", "WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS date, o_custkey % 20 AS l, count(*)::DOUBLE AS v FROM orders GROUP BY ALL), b AS (SELECT date, coalesce(sum(v) FILTER (l BETWEEN 7 AND 15), 0) AS s FROM m GROUP BY 1) SELECT date, round(greatest(0, s - (SELECT avg(s) FROM b WHERE date >= '2000-01')), 6) AS value FROM b")
def probe_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = monthly(spark, sf_dir).groupBy(F.col("month").alias("date"), F.concat(F.lit("length_"), (F.col("custkey") % 20).cast("string")).alias("key")).agg(F.count("*").cast("double").alias("value"))
    return leaks.backfill_probe_share(m, "2000-01").withColumn("value", F.round("value", 6))


@query("filled_series", f"WITH {_MONTHS}, s AS (SELECT custkey % 50 AS k, month, sum((priority = '1-URGENT')::INT)::DOUBLE AS a, count(*)::DOUBLE AS b FROM o GROUP BY ALL), f AS (SELECT x.k, y.month, coalesce(100 * a / b, 0) AS percent FROM (SELECT DISTINCT k FROM s) x CROSS JOIN (SELECT DISTINCT month FROM s) y LEFT JOIN s ON s.k = x.k AND s.month = y.month) SELECT k, month, round(percent, 6) AS percent, round(avg(percent) OVER (PARTITION BY month), 6) AS mean FROM f")
def filled_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = monthly(spark, sf_dir).select((F.col("custkey") % 50).alias("k"), "month", (F.col("priority") == "1-URGENT").cast("double").alias("a_"), F.lit(1.0).alias("b_"))
    out = leaks.filled_series(o, "k", "month", "a_", "b_")
    return out.select("k", "month", F.round("percent", 6).alias("percent"), F.round("mean", 6).alias("mean"))


@query("location_country", "SELECT c_nationkey AS cc, o_orderpriority AS loc, count(*) AS queries FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def location_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("cc"))
    return read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderpriority").alias("loc")).join(c, "o_custkey").groupBy("cc", "loc").agg(F.count("*").alias("queries"))


@query("city_list", "SELECT DISTINCT split_part(split_part(url, '/', 3), ':', 1) AS city FROM pages ORDER BY 1")
def city_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts(spark, sf_dir).select(F.col("name").alias("city")).distinct().orderBy("city")


@query("explain_numeric", "WITH c AS (SELECT l_suppkey AS tld, l_partkey % 256 AS tail, sum(l_quantity::BIGINT)::BIGINT AS inner_total, max(l_quantity::BIGINT) AS most FROM lineitem GROUP BY ALL), t AS (SELECT tld, sum(inner_total)::BIGINT AS outer_total FROM c GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) SELECT tld, tail, inner_total, most, outer_total FROM (SELECT *, row_number() OVER (PARTITION BY tld ORDER BY inner_total DESC, tail) AS r FROM c JOIN t USING (tld)) WHERE r <= 10")
def explain_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("tld"), (F.col("l_partkey") % 256).alias("tail"), F.col("l_quantity").cast("long").alias("q"))
    return statistics.attach_totals(li, "tld", "tail", "q", 10)


@query("rank_within", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) AS n FROM orders")
def rank_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey", "o_orderstatus").orderBy("o_orderdate", "o_orderkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", F.row_number().over(w).cast("long").alias("n"))


@query("metric_index", f"""WITH {_MONTHS}, c AS (SELECT month, sum((priority = '1-URGENT')::INT)::DOUBLE / count(*) AS m1, sum((priority = '2-HIGH')::INT)::DOUBLE / count(*) AS m2 FROM o GROUP BY 1)
SELECT month, round(100 * m1, 6) AS m1, round(100 * greatest(0, m2 * (1 - m1)), 6) AS m2 FROM c""")
def metric_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published percentages: repeats are shown as a part of all queries, so times one less the first metric."""
    part = lambda p: F.sum((F.col("priority") == p).cast("double")) / F.count("*")
    c = monthly(spark, sf_dir).groupBy("month").agg(part("1-URGENT").alias("m1"), part("2-HIGH").alias("m2"))
    return c.select("month", F.round(100 * F.col("m1"), 6).alias("m1"), F.round(100 * F.greatest(F.lit(0.0), F.col("m2") * (1 - F.col("m1"))), 6).alias("m2"))


@query("protocol_volumes", """
WITH p AS (SELECT l_suppkey AS source, l_quantity::BIGINT AS size, CASE WHEN l_returnflag = 'N' THEN 17 ELSE 6 END AS protocol, [53, 853, 443, 80][l_linenumber % 4 + 1] AS port, CASE WHEN l_partkey % 3 = 0 THEN 2 ELSE 16 END AS flags FROM lineitem),
k AS (SELECT *, CASE WHEN protocol = 17 THEN CASE WHEN port = 53 THEN 0 END WHEN port <> 80 THEN port END AS key, CASE WHEN protocol = 6 AND flags = 2 AND port IN (853, 443) THEN CASE port WHEN 853 THEN 583 ELSE 443 END END AS opens FROM p)
SELECT 'VOLUME_PER_PROTO' AS registry, key::VARCHAR AS key, sum(size)::BIGINT AS count FROM k WHERE key IS NOT NULL GROUP BY key
UNION ALL SELECT 'TCPSYN_PER_PROTO', opens::VARCHAR, count(DISTINCT source) FROM k WHERE opens IS NOT NULL GROUP BY opens UNION ALL SELECT 'TCPSYN_PER_PROTO', '0', count(DISTINCT source) FROM k WHERE opens IS NOT NULL
""")
def protocol_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as packets, suppliers as clients."""
    li = read(spark, sf_dir, "lineitem")
    port = F.element_at(F.array(F.lit(53), F.lit(853), F.lit(443), F.lit(80)), (F.col("l_linenumber") % 4 + 1).cast("int"))
    packets = li.select(F.col("l_suppkey").alias("source"), F.col("l_quantity").cast("long").alias("size"), F.when(F.col("l_returnflag") == "N", 17).otherwise(6).alias("protocol"), F.lit(40_000).alias("source_port"), port.alias("target_port"), F.when(F.col("l_partkey") % 3 == 0, 2).otherwise(16).alias("tcp_flags"))
    return leaks.protocol_volumes(packets)

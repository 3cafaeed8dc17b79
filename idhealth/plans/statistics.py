"""Statistics queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idhealth.operators import counters, rsvlog, statistics

from .catalog import query, read
from .traffic import MESSAGES_SQL, messages


@query("describe_by", "WITH x AS (SELECT l_returnflag AS flag, 'quantity' AS \"column\", l_quantity AS v FROM lineitem UNION ALL SELECT l_returnflag, 'discount', l_discount FROM lineitem) SELECT flag, \"column\", count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.75), 6) AS q3, max(v) AS max FROM x GROUP BY ALL")
def describe_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"))
    d = statistics.describe_by(li, ["flag"], ["quantity", "discount"])
    return d.select("flag", "column", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "max")


@query("corr_matrix", "WITH c AS (SELECT l_returnflag AS flag, corr(l_quantity, l_extendedprice) AS qp, corr(l_quantity, l_discount) AS qd, corr(l_extendedprice, l_discount) AS pd FROM lineitem GROUP BY 1) SELECT flag, 'l_quantity' AS a, 'l_extendedprice' AS b, round(qp, 6) AS corr FROM c UNION ALL SELECT flag, 'l_quantity', 'l_discount', round(qd, 6) FROM c UNION ALL SELECT flag, 'l_extendedprice', 'l_discount', round(pd, 6) FROM c")
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "flag")
    return statistics.corr_matrix(li, ["l_quantity", "l_extendedprice", "l_discount"], ["flag"]).withColumn("corr", F.round("corr", 6))


@query("linear_fit", "WITH b AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem) SELECT l_orderkey, l_linenumber, round(l_extendedprice - (i + s * l_quantity), 3) AS residual FROM lineitem, b")
def linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return statistics.linear_fit(li, "l_extendedprice", ["l_quantity"]).select("l_orderkey", "l_linenumber", F.round("residual", 3).alias("residual"))


@query("fit_two_features")
def fit_two_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.log10(F.sum("l_extendedprice")).alias("y"), F.log10(F.sum("l_quantity")).alias("x1"), F.avg("l_discount").alias("x2"))
    return statistics.linear_fit(c, "y", ["x1", "x2"]).select("l_suppkey", F.round("residual", 6).alias("residual"))


@query("load_components")
def load_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = statistics.principal_components(read(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.select("component", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query("ratio_variance", "WITH s AS (SELECT l_returnflag AS flag, count(*) AS n, sum(l_quantity) AS sx, sum(l_discount) AS sy, sum(l_quantity * l_quantity) AS sxx, sum(l_quantity * l_discount) AS sxy, sum(l_discount * l_discount) AS syy, avg(l_discount / l_quantity) AS m FROM lineitem GROUP BY 1) SELECT flag, n, round(sy / sx, 9) AS ratio_of_means, round(m, 9) AS mean_of_ratios, round(1e9 * (syy - 2 * sy / sx * sxy + sy / sx * sy / sx * sxx) / (n - 1) / n / (sx / n * sx / n), 5) AS variance FROM s")
def ratio_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "flag")
    v = statistics.ratio_variance(li, ["flag"], "l_quantity", "l_discount")
    return v.select("flag", "n", F.round("ratio_of_means", 9).alias("ratio_of_means"), F.round("mean_of_ratios", 9).alias("mean_of_ratios"), F.round(F.col("variance") * 1e9, 5).alias("variance"))


@query("log_bins", "WITH d AS (SELECT c_mktsegment AS segment, round(c_acctbal, 2) AS v FROM customer WHERE c_acctbal > 0), s AS (SELECT min(log10(v)) AS a, max(log10(v)) AS b FROM d) SELECT segment, least(floor((log10(v) - a) / (b - a) * 20), 19)::INT AS bin, count(*) AS count FROM d, s GROUP BY ALL")
def log_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"), F.round("c_acctbal", 2).alias("v"))
    return statistics.log_bins(c, "v", ["segment"])


@query("segment", "WITH c AS (SELECT o_custkey, count(*) AS n, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents FROM orders GROUP BY 1), g AS (SELECT *, CASE WHEN n >= 15 AND cents >= 400000000 THEN 'big' WHEN n >= 15 THEN 'many small' WHEN n >= 8 THEN 'middle' ELSE 'small' END AS segment FROM c) SELECT segment, count(*) AS count, quantile_cont(n, 0.5) AS median FROM g GROUP BY 1")
def segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    rules = {"big": (F.col("n") >= 15) & (F.col("cents") >= 400_000_000), "many small": F.col("n") >= 15, "middle": F.col("n") >= 8}
    return statistics.segment(c, rules, "small").groupBy("segment").agg(F.count("*").alias("count"), F.percentile("n", F.lit(0.5)).alias("median"))


@query("mean_by_key", "WITH k AS (SELECT i AS l_linenumber FROM range(1, 11) t(i)), m AS (SELECT l_linenumber, avg(l_quantity) AS mean FROM lineitem WHERE l_quantity > 5 GROUP BY 1) SELECT k.l_linenumber, round(coalesce(mean, 0), 6) AS mean FROM k LEFT JOIN m ON k.l_linenumber = m.l_linenumber")
def mean_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(F.col("l_linenumber").cast("long").alias("l_linenumber"), F.when(F.col("l_quantity") > 5, F.col("l_quantity")).alias("q"))
    return statistics.mean_by_key(li, "l_linenumber", "q", spark.range(1, 11).toDF("l_linenumber")).withColumn("mean", F.round("mean", 6))


@query("min_average_max", MESSAGES_SQL + ", d AS (SELECT client, ts::DATE AS day, count(*) AS q, sum((rcode = 3)::INT)::BIGINT AS nx, sum((tld = 'CLICK')::INT)::BIGINT AS click FROM dns GROUP BY ALL), x AS (SELECT client, q, 'nx' AS part, nx AS v FROM d UNION ALL SELECT client, q, 'click', click FROM d) SELECT client, part, round(min(v::DOUBLE / q), 9) AS least, round(sum(v)::DOUBLE / sum(q), 9) AS average, round(max(v::DOUBLE / q), 9) AS greatest FROM x GROUP BY ALL")
def min_average_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = messages(spark, sf_dir).groupBy("client", F.to_date("ts").alias("day")).agg(F.count("*").alias("q"), F.sum((F.col("rcode") == 3).cast("long")).alias("nx"), F.sum((F.col("tld") == "CLICK").cast("long")).alias("click"))
    return statistics.min_average_max(d, "client", "q", ["nx", "click"]).select("client", "part", *[F.round(c, 9).alias(c) for c in ("least", "average", "greatest")])


@query("good_slices", MESSAGES_SQL + ", d AS (SELECT client, ts::DATE AS day, count(*) AS q FROM dns GROUP BY ALL), g AS (SELECT *, sum(q) OVER (PARTITION BY client) AS s FROM d WHERE q >= 2) SELECT client, strftime(day, '%Y-%m-%d') AS day, q FROM g WHERE s > 60")
def good_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = messages(spark, sf_dir).groupBy("client", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("q")).withColumn("s", F.lit(1))
    return statistics.good_slices(d, "client", "q", "s", 2, 60).select("client", "day", "q")


ISP = ("CLICK", "VIEW")
DAY = 86_400_000_000


def pivoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir).withColumn("cc", F.col("client") % 7)
    return statistics.resolver_pivot(m, ["cc"], "client", "us", "tld", ISP, DAY)


_PIVOT = MESSAGES_SQL + f""", t AS (SELECT client % 7 AS cc, client, tld, min(us) AS t FROM dns GROUP BY ALL), f AS (SELECT *, min(t) OVER (PARTITION BY client) AS first_us FROM t),
p AS (SELECT cc, client, any_value(first_us) AS first_us, arg_min(tld, (t, tld)) AS first_tag, array_to_string(list(tld ORDER BY tld) FILTER (t - first_us <= {DAY}), ',') AS near,
      coalesce(bool_or(tld IN ('CLICK', 'VIEW')) FILTER (t - first_us <= {DAY}), false) AS has_isp, coalesce(bool_or(tld NOT IN ('CLICK', 'VIEW')) FILTER (t - first_us <= {DAY}), false) AS has_public FROM f GROUP BY ALL)
"""


@query("resolver_pivot", _PIVOT + "SELECT * FROM p")
def resolver_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivoted(spark, sf_dir).withColumn("near", F.array_join("near", ","))


@query("resolver_summary", _PIVOT + "SELECT cc, count(*) AS total, sum((has_isp AND NOT has_public)::INT)::BIGINT AS isp, sum((has_public AND NOT has_isp)::INT)::BIGINT AS public, sum((has_isp AND has_public)::INT)::BIGINT AS both, " + ", ".join(f"sum((near LIKE '%{t}%')::INT)::BIGINT AS \"{t}\"" for t in ("CLICK", "ERROR", "VIEW")) + " FROM p GROUP BY cc")
def resolver_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.resolver_summary(pivoted(spark, sf_dir), ["cc"], ["CLICK", "ERROR", "VIEW"])


@query("resolver_subnets", MESSAGES_SQL + "SELECT client // 16 AS net, tld, count(*) AS count, count(DISTINCT client) AS clients FROM dns GROUP BY ALL")
def resolver_subnets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).groupBy(F.expr("client DIV 16").alias("net"), "tld").agg(F.count("*").alias("count"), F.countDistinct("client").alias("clients"))


_LINES = "l AS (SELECT event_id, user_id, epoch_us(ts) AS us, event_type FROM events)"


@query("rsv_log_parse", f"WITH {_LINES} SELECT event_id, us, '10.1.' || (user_id % 200)::VARCHAR || '.9' AS resolver, (1024 + event_id % 1000)::INT AS port, 'params' AS shape, 'u' || user_id::VARCHAR AS user, CASE WHEN user_id % 9 BETWEEN 1 AND 3 THEN ['AD', 'AE', 'AF'][user_id % 9] ELSE 'c' || (user_id % 9)::VARCHAR END AS cc, user_id * 3 AS asn, us // 1000000 - 5 AS ad_time, '1.2.3.' || (user_id % 256)::VARCHAR AS client, '0du' AS prefix, event_type AS experiment, event_id % 2 = 0 AS is_results, event_type || '.example.net' AS server FROM l")
def rsv_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines are made from events and parsed back."""
    from idhealth.functions.times import micros

    e = read(spark, sf_dir, "events").withColumn("us", micros(F.col("ts")))
    u = F.col("user_id")
    results = F.when(F.col("event_id") % 2 == 0, "results-").otherwise("")
    name = F.format_string("0du-%su%d-c%d-a%s-s%d-i010203%s-0.%s.example.net.", results, u, u % 9, F.lower(F.hex(u * 3)), F.floor(F.col("us") / 1_000_000) - 5, F.lpad(F.lower(F.hex(u % 256)), 2, "0"), F.col("event_type"))
    line = F.format_string("%d.%06d client 10.1.%d.9#%d: query: %s IN A -ED", F.floor(F.col("us") / 1_000_000), F.col("us") % 1_000_000, u % 200, 1024 + F.col("event_id") % 1000, name)
    got = rsvlog.parse(e.select("event_id", line.alias("value")), codes=("AD", "AE", "AF"), keep=["event_id"])
    return got.select("event_id", "us", "resolver", "port", "shape", "user", "cc", "asn", "ad_time", "client", "prefix", "experiment", "is_results", "server")


@query("explain_names", "WITH c AS (SELECT p_brand AS brand, p_type AS type, sum(p_size)::BIGINT AS inner_total, max(p_size) AS most FROM part GROUP BY ALL), t AS (SELECT brand, sum(inner_total)::BIGINT AS outer_total FROM c GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) SELECT brand, type, inner_total, most, outer_total FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY inner_total DESC, type) AS r FROM c JOIN t USING (brand)) WHERE r <= 10")
def explain_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), "p_size")
    return statistics.attach_totals(p, "brand", "type", "p_size", 10)


@query("zone_dnssec", "WITH r AS (SELECT c_custkey AS zone, o_orderpriority AS algo, length(c_custkey::VARCHAR) = 2 AS s FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON c_custkey = o_custkey), b AS (SELECT zone, s, count(algo) AS n FROM r GROUP BY ALL), a AS (SELECT zone, algo, count(*) AS c FROM r WHERE algo IS NOT NULL GROUP BY ALL) SELECT 'signed' AS metric, 'all' AS key, round(avg((n > 0)::INT), 9) AS value FROM b UNION ALL SELECT 'signed', 'short', round(avg((n > 0)::INT), 9) FROM b WHERE s UNION ALL SELECT 'algorithm', algo, round(sum(c::DOUBLE / n) / (SELECT count(*) FROM b), 9) FROM a JOIN b USING (zone) GROUP BY algo")
def zone_dnssec(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("zone"), F.col("o_orderpriority").alias("algo"))
    r = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("zone")).join(o, "zone", "left")
    return statistics.zone_dnssec(r, "zone", "algo", F.char_length(F.col("zone").cast("string")) == 2).withColumn("value", F.round("value", 9))


@query("distinct_rows", "SELECT DISTINCT text, lang, source FROM documents")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("text", "lang", "source").distinct()


@query("head", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 200")
def head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber").limit(200)


@query("non_tiny", "SELECT l_suppkey, count(*) AS total FROM lineitem GROUP BY 1 HAVING count(*) > 50")
def non_tiny(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.non_tiny(read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("total")), "total", 50)


@query("first_messages", MESSAGES_SQL + "SELECT msg_id, us, tld FROM dns ORDER BY us, msg_id LIMIT 500")
def first_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.first_rows(messages(spark, sf_dir).select("msg_id", "us", "tld"), ["us", "msg_id"], 500)


@query("sampled_largest", "SELECT * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('7 ' || o_orderkey::VARCHAR), o_orderkey LIMIT 13) ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def sampled_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.sampled_largest(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", "o_totalprice", seed=7)


@query("sample")
def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One percent of the line items, at least the first one."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return li.sample(0.01, seed=7).union(li.orderBy("l_orderkey", "l_linenumber").limit(1)).distinct()


@query("set_difference", "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order."""
    urgent = read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey")).subtract(urgent)


@query("set_equality", "WITH a AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1) SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_left, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_right")
def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows two summaries do not share; both 0 if they are equal."""
    a = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
    b = read(spark, sf_dir, "orders").groupBy(F.col("o_orderkey").alias("k")).agg(F.count("*").alias("n"))
    left, right = (x.exceptAll(y).agg(F.count("*").alias(c)) for x, y, c in ((a, b, "only_left"), (b, a, "only_right")))
    return left.crossJoin(right)  # one row each


@query("rule_union", "SELECT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT DISTINCT source FROM documents")
def rule_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).union(read(spark, sf_dir, "region").select("r_name")).union(read(spark, sf_dir, "documents").select("source")).distinct()

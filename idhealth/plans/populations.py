"""Population queries: entities are customers, suppliers and event users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from idhealth.operators import populations as p

from .catalog import query, read
from .traffic import MESSAGES_SQL, messages


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cents and orders of each customer with orders."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(F.sum(cents).alias("cents"), F.count("*").alias("orders"))


CUSTOMERS_SQL = "c AS (SELECT o_custkey AS custkey, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents, count(*) AS orders FROM orders GROUP BY 1)"


@query("concentration", """
WITH s AS (SELECT l_returnflag AS flag, l_suppkey AS supp, sum(l_quantity::BIGINT)::BIGINT AS q FROM lineitem GROUP BY ALL),
r AS (SELECT *, sum(q) OVER (PARTITION BY flag ORDER BY q DESC, supp ROWS UNBOUNDED PRECEDING) AS cum, sum(q) OVER (PARTITION BY flag) AS total FROM s)
SELECT flag, sum(q)::BIGINT AS total, count(*) AS entities, sum((cum - q < 0.5 * total)::INT)::BIGINT AS k50, sum((cum - q < 0.9 * total)::INT)::BIGINT AS k90 FROM r GROUP BY flag
""")
def concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_suppkey").alias("supp"), F.col("l_quantity").cast("long").alias("q"))
    return p.concentration(li, ["flag"], "supp", "q")


@query("load_curve", "WITH " + CUSTOMERS_SQL + """,
r AS (SELECT *, row_number() OVER (ORDER BY cents DESC, custkey) AS n, sum(cents) OVER (ORDER BY cents DESC, custkey ROWS UNBOUNDED PRECEDING)::BIGINT AS cum, sum(cents) OVER ()::BIGINT AS total FROM c),
m AS (SELECT *, floor(cum / (total * 0.05)) AS mark, count(*) OVER () AS k FROM r),
l AS (SELECT *, coalesce(lag(mark) OVER (ORDER BY n), -1) AS last FROM m)
SELECT n, cents AS load, cum, round(cum::DOUBLE / total, 9) AS share FROM l WHERE last <> mark OR n = k
""")
def load_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.load_curve(customers(spark, sf_dir), "cents", 0.05).withColumn("share", F.round("share", 9))


@query("overlap", "WITH " + CUSTOMERS_SQL + """,
l AS (SELECT custkey, orders AS v FROM c WHERE orders > 3), r AS (SELECT c_custkey AS custkey, c_nationkey::BIGINT AS v FROM customer WHERE c_acctbal > 0),
b AS (SELECT l.v AS l, r.v AS r FROM l FULL JOIN r ON l.custkey = r.custkey)
SELECT 'left only' AS part, count(*) AS count, sum(l)::BIGINT AS value FROM b WHERE r IS NULL UNION ALL SELECT 'right only', count(*), sum(r)::BIGINT FROM b WHERE l IS NULL
UNION ALL SELECT 'both, left value', count(*), sum(l)::BIGINT FROM b WHERE l IS NOT NULL AND r IS NOT NULL
UNION ALL SELECT 'both, right value', count(*), sum(r)::BIGINT FROM b WHERE l IS NOT NULL AND r IS NOT NULL
""")
def overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of several orders and customers with a balance above 0."""
    left = customers(spark, sf_dir).where("orders > 3").select("custkey", F.col("orders").alias("v"))
    right = read(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"), F.col("c_nationkey").cast("long").alias("v"))
    return p.overlap(left, right, "custkey", "v")


@query("overlap_list", "WITH " + CUSTOMERS_SQL + " SELECT custkey, orders, c_mktsegment AS segment FROM c JOIN customer ON custkey = c_custkey")
def overlap_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"))
    return customers(spark, sf_dir).join(c, "custkey").select("custkey", "orders", "segment")


@query("log_histogram", "WITH " + CUSTOMERS_SQL + " SELECT c_mktsegment AS segment, (length((cents // 100)::VARCHAR) - 1)::INT AS decade, count(*) AS count, sum(cents // 100)::BIGINT AS sum FROM c JOIN customer ON custkey = c_custkey WHERE cents >= 100 GROUP BY ALL")
def log_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"))
    own = customers(spark, sf_dir).where("cents >= 100").withColumn("units", F.expr("cents DIV 100")).join(c, "custkey")
    return p.log_histogram(own, "units", ["segment"])


@query("cross_path", MESSAGES_SQL + """
, b AS (SELECT client, tld, count(*) AS v FROM dns GROUP BY ALL),
t AS (SELECT client, sum(v) AS a, arg_max(tld, (v, tld)) AS dominant FROM b GROUP BY client HAVING sum(v) >= 50),
m AS (SELECT dominant, tld AS cluster, sum(v)::BIGINT AS value FROM b JOIN t USING (client) GROUP BY ALL)
SELECT *, round(value::DOUBLE / sum(value) OVER (PARTITION BY dominant), 9) AS share FROM m
""")
def cross_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir).withColumn("v", F.lit(1).cast("long"))
    return p.cross_path(m, "client", "tld", "v", 50).withColumn("share", F.round("share", 9))


@query("rank_limit", "WITH " + CUSTOMERS_SQL + """, r AS (SELECT cents, row_number() OVER (ORDER BY cents DESC) AS n FROM c)
SELECT CASE WHEN count(*) > 50 THEN avg(cents) FILTER (n IN (50, 51)) ELSE min(cents) END::DOUBLE AS "limit", max(cents) AS largest FROM r
""")
def rank_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.rank_limit(customers(spark, sf_dir), "cents", 50)


@query("rollup_chain", "WITH " + CUSTOMERS_SQL + """,
f AS (SELECT custkey, n_name AS nation, r_name AS region, cents AS value, orders AS most FROM c JOIN customer ON custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT 'custkey' AS level, custkey::VARCHAR AS name, sum(value)::BIGINT AS value, max(most) AS most, count(*) AS members FROM f GROUP BY ALL
UNION ALL SELECT 'nation', nation, sum(value)::BIGINT, max(most), count(*) FROM f GROUP BY ALL UNION ALL SELECT 'region', region, sum(value)::BIGINT, max(most), count(*) FROM f GROUP BY ALL
""")
def rollup_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    dim = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    f = customers(spark, sf_dir).join(dim, F.col("custkey") == F.col("c_custkey")).select("custkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"), "cents", "orders")
    return p.rollup_chain(f, ["custkey", "nation", "region"], "cents", "orders")


@query("projections", MESSAGES_SQL + """
, x AS (SELECT tld, ts, (rcode = 3)::INT AS nx FROM dns)
SELECT 'tld' AS kind, tld AS key, count(*) AS queries, sum(nx)::BIGINT AS nx FROM x GROUP BY ALL
UNION ALL SELECT 'tld-day', tld || '/' || strftime(ts, '%Y-%m-%d'), count(*), sum(nx)::BIGINT FROM x GROUP BY ALL
UNION ALL SELECT 'tld-weekday', tld || '/' || (dayofweek(ts) + 1)::VARCHAR, count(*), sum(nx)::BIGINT FROM x GROUP BY ALL
UNION ALL SELECT 'tld-hour', tld || '/' || hour(ts)::VARCHAR, count(*), sum(nx)::BIGINT FROM x GROUP BY ALL
""")
def projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir).select("tld", "ts", F.lit(1).cast("long").alias("queries"), (F.col("rcode") == 3).cast("long").alias("nx"))
    t = F.col("tld")
    kinds = {"tld": [t], "tld-day": [t, F.date_format("ts", "yyyy-MM-dd")], "tld-weekday": [t, F.dayofweek("ts")], "tld-hour": [t, F.hour("ts")]}
    return p.projections(m, kinds, ["queries", "nx"])


@query("cluster_totals", MESSAGES_SQL + "SELECT tld, rcode, sum(k)::BIGINT AS value, count(DISTINCT client) AS entities FROM dns GROUP BY ROLLUP (tld, rcode)")
def cluster_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.cluster_totals(messages(spark, sf_dir), "tld", "rcode", "client", "k")


_CLASS = "CASE WHEN orders >= 15 THEN 'top' WHEN orders >= 10 THEN 'frequent' WHEN orders >= 3 THEN 'others' ELSE 'tiny' END"


def rules() -> dict:
    o = F.col("orders")
    return {"top": o >= 15, "frequent": o >= 10, "others": o >= 3}


@query("class_share", "WITH " + CUSTOMERS_SQL + f", k AS (SELECT {_CLASS} AS class, count(*) AS count, sum(cents)::BIGINT AS load FROM c GROUP BY 1) SELECT *, round(load::DOUBLE / sum(load) OVER (), 9) AS share FROM k")
def class_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.class_share(customers(spark, sf_dir), rules(), "tiny", "cents").withColumn("share", F.round("share", 9))


@query("class_by_country", "WITH " + CUSTOMERS_SQL + f", k AS (SELECT c_nationkey AS nation, {_CLASS} AS class, count(*) AS count, sum(cents)::BIGINT AS load FROM c JOIN customer ON custkey = c_custkey GROUP BY ALL) SELECT *, round(load::DOUBLE / sum(load) OVER (PARTITION BY nation), 9) AS share FROM k")
def class_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nation"))
    return p.class_share(customers(spark, sf_dir).join(c, "custkey"), rules(), "tiny", "cents", ["nation"]).withColumn("share", F.round("share", 9))


def criteria() -> dict:
    mean = F.col("cents") / F.col("orders")
    return {"orders": (F.col("orders"), 8, 12), "load": (F.col("cents"), 15_000_000_00, 30_000_000_00), "mean": (mean, 20_000_000, 25_000_000)}


_CATEGORY = "concat(CASE WHEN orders <= 8 THEN 'l' WHEN orders >= 12 THEN 'H' ELSE 'm' END, CASE WHEN cents <= 1500000000 THEN 'l' WHEN cents >= 3000000000 THEN 'H' ELSE 'm' END, CASE WHEN cents::DOUBLE / orders <= 20000000 THEN 'l' WHEN cents::DOUBLE / orders >= 25000000 THEN 'H' ELSE 'm' END)"


@query("categorize", "WITH " + CUSTOMERS_SQL + f""", k AS (SELECT *, {_CATEGORY} AS category FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY custkey) AS n FROM k)
SELECT category, count(*) AS count, sum(cents)::BIGINT AS load, array_to_string(list(custkey ORDER BY custkey) FILTER (n <= 10), ',') AS samples FROM r GROUP BY category
""")
def categorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = p.categorize(customers(spark, sf_dir), criteria(), "cents", "custkey")
    return out.withColumn("samples", F.array_join(F.transform("samples", lambda x: x.cast("string")), ","))


@query("step_histogram", "WITH " + CUSTOMERS_SQL + """
SELECT 'orders' AS criterion, floor(least(orders, 20) / 2)::BIGINT AS bin, count(*) AS count FROM c GROUP BY ALL
UNION ALL SELECT 'load', floor(least(cents, 3000000000) / 100000000)::BIGINT, count(*) FROM c GROUP BY ALL
""")
def step_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.step_histogram(customers(spark, sf_dir), {"orders": (F.col("orders"), 2, 20), "load": (F.col("cents"), 100_000_000, 3_000_000_000)})


_M9 = """
, r AS (SELECT client, sum(k)::BIGINT * 100 AS load, sum(CASE WHEN rcode = 3 THEN k ELSE 0 END)::BIGINT * 100 AS nx, (client % 3) * 500 AS users FROM dns GROUP BY client),
l AS (SELECT *, CASE WHEN users >= 1000 THEN 'apnic-top' WHEN users > 0 THEN 'apnic-others' WHEN load < 1000 THEN 'tiny' WHEN load >= 100000 AND 0.1 * load > nx THEN 'positive' ELSE 'else' END AS class,
             CASE WHEN load < 100 THEN 1 WHEN load < 1000 THEN 2 WHEN load < 10000 THEN 3 WHEN load < 100000 THEN 4 WHEN load < 1000000 THEN 5 WHEN load < 10000000 THEN 6 WHEN load < 100000000 THEN 7 ELSE 8 END AS decade,
             least(floor(coalesce(nx::DOUBLE / nullif(load, 0), 0) * 20), 19)::INT AS b FROM r),
x AS (SELECT 'total' AS metric, 'all' AS key, load FROM l UNION ALL SELECT 'class', class, load FROM l
      UNION ALL SELECT 'decade', decade::VARCHAR, load FROM l WHERE class = 'apnic-top' UNION ALL SELECT 'nx', b::VARCHAR, load FROM l WHERE class = 'apnic-top'),
d AS (SELECT 'total' AS metric, 'all' AS key UNION ALL SELECT 'class', unnest(['apnic-top', 'apnic-others', 'tiny', 'positive', 'else'])
      UNION ALL SELECT 'decade', unnest(range(1, 9))::VARCHAR UNION ALL SELECT 'nx', unnest(range(20))::VARCHAR)
SELECT d.metric, d.key, count(x.load) AS resolvers, coalesce(sum(x.load), 0)::BIGINT AS load FROM d LEFT JOIN x ON d.metric = x.metric AND d.key = x.key GROUP BY ALL
"""


@query("resolver_metrics", MESSAGES_SQL + _M9)
def resolver_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir).groupBy("client").agg((F.sum("k") * 100).alias("load"), (F.sum(F.when(F.col("rcode") == 3, F.col("k")).otherwise(0)) * 100).alias("nx"))
    return p.resolver_metrics(m.withColumn("users", (F.col("client") % 3) * 500), "load", "nx", "users", 1000)


@query("enrich", "SELECT s_suppkey AS suppkey, s_nationkey AS nation, coalesce(c.n, 0) AS customers FROM supplier LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 0 AND c_nationkey < 20 GROUP BY 1) c ON s_nationkey = c_nationkey")
def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = read(spark, sf_dir, "customer").where("c_acctbal > 0 AND c_nationkey < 20").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"))
    return p.enrich(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("suppkey"), F.col("s_nationkey").alias("nation")), dim, "nation", {"customers": 0})


@query("semi_members", "SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49 AND l_returnflag = 'R')")
def semi_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").where("l_quantity >= 49 AND l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return read(spark, sf_dir, "part").select("p_partkey").join(li, "p_partkey", "left_semi")


@query("anti_members", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def anti_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey").join(o, "c_custkey", "left_anti")


@query("suffix_histogram", "SELECT c_mktsegment AS class, floor((c_custkey % 256) / 16)::INT AS bin, count(*) AS count FROM customer GROUP BY ALL")
def suffix_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.suffix_histogram(read(spark, sf_dir, "customer"), F.col("c_custkey"), F.col("c_mktsegment"))


KINDS = ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW")


@query("client_profile", MESSAGES_SQL + "SELECT client, " + ", ".join(f"coalesce(sum(k) FILTER (tld = '{k}'), 0)::BIGINT AS \"{k}\"" for k in KINDS) + ", sum(k)::BIGINT AS total FROM dns GROUP BY client")
def client_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.profile(messages(spark, sf_dir), "client", "tld", KINDS, "k")


@query("reduce_addresses", MESSAGES_SQL + ", g AS (SELECT *, us - lag(us) OVER (PARTITION BY client ORDER BY us, msg_id) AS gap FROM dns) SELECT client, " + ", ".join(f"sum(CASE WHEN tld = '{k}' THEN 1 ELSE 0 END)::BIGINT AS \"{k}\"" for k in KINDS) + ", count(*) AS total, min(CASE WHEN gap > 0 THEN gap END) AS min_delay, count(DISTINCT ts::DATE) AS slices FROM g GROUP BY client")
def reduce_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from idhealth.operators.usage import gaps

    m = gaps(messages(spark, sf_dir), ["client"], ["us", "msg_id"], "us").withColumns({"one": F.lit(1).cast("long"), "day": F.to_date("ts")})
    return p.reduce_addresses(m, "client", "tld", "one", "gap", "day", KINDS)

"""Monthly health metrics from summaries and registry tables; each gives (metric, key, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from idhealth.functions.names import RFC6761
from idhealth.operators.counters import coverage, keep_share, remainder, share
from idhealth.operators.populations import concentration
from idhealth.operators.statistics import mean_by_key, zone_dnssec

from .catalog import query, read


def long_rows(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.lit("").alias("key"), v.cast("double").alias("value")) for k, v in values.items()])).alias("x")).select("x.*")


def of(registry: str, key: str) -> Column:
    """Counter of a registry's key, 0 if absent; for use in one aggregation over a summary."""
    return F.coalesce(F.sum(F.when((F.col("registry") == registry) & (F.col("key") == key), F.col("count"))), F.lit(0))


def total_of(registry: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("registry") == registry, F.col("count"))), F.lit(0))


def key_share(registry: str, key: str = "1") -> Column:
    return share(of(registry, key), total_of(registry))


def m1(compliance: DataFrame) -> DataFrame:
    """Complaints: notices per million domains, fewest registrars with 50 and 90 % of the notices, registrars with rows.

    A registrar's domains are those of its first row by id and name; its first notices are summed.
    """
    by = compliance.groupBy("iana_id").agg(F.max("domain_count").alias("domains"), F.sum(F.col("first_notices")).alias("notices"))
    all_ = by.agg(F.sum("domains").alias("d"), F.sum("notices").alias("n"), F.count("*").alias("c"))
    k = concentration(by.withColumn("g", F.lit(1)), ["g"], "iana_id", "notices").select("k50", "k90")
    return long_rows(all_.crossJoin(k), {"M1.1": F.col("n") * 1e6 / F.col("d"), "M1.2": F.col("k50"), "M1.3": F.col("k90"), "M1.4": F.col("c")})  # one row each


def m2(abuse: DataFrame, source: int, name: str = "name") -> DataFrame:
    """Abuse of a source (1 names, 2 registrars): for phishing, malware, botnet and spam the rate per 10,000 domains and the fewest entities with 50 and 90 %."""
    kinds = ("phishing", "malware", "botnet", "spam")
    long = abuse.select(name, "domains", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(k).alias("v")) for i, k in enumerate(kinds, 1)])).alias("x")).select(name, "domains", "x.*")
    rate = long.groupBy("i").agg((F.sum("v") * 10_000 / F.sum("domains")).alias("rate"))
    k = concentration(long, ["i"], name, "v").join(rate, "i")
    cells = F.array(*[F.struct(F.concat(F.lit(f"M2.{source}."), F.col("i").cast("string"), F.lit(f".{n}")).alias("metric"), F.lit("").alias("key"), F.col(c).cast("double").alias("value")) for n, c in ((1, "rate"), (2, "k50"), (3, "k90"))])
    return k.select(F.explode(cells).alias("x")).select("x.*")


#: Registry, its metric, what stands before or for its keys, the base of its shares, and the least share in a long list.
Listing = tuple[str, str, Column, str, float]


def listed(summary: DataFrame, bases: DataFrame, listings: Sequence[Listing]) -> DataFrame:
    """(metric, key, value) of whole registries in one pass: each key's share in a base (a column of the one row `bases`), small ones left out of long lists."""
    name, metric, key, base = F.col("registry"), F.lit(None), F.lit(None), F.lit(None)
    least = F.lit(0.0)
    for registry, m, k, b, smallest in listings:
        here = name == registry
        metric, key, base, least = F.when(here, m).otherwise(metric), F.when(here, k).otherwise(key), F.when(here, F.col(b)).otherwise(base), F.when(here, F.lit(smallest)).otherwise(least)
    rows = summary.where(name.isin(*[x[0] for x in listings])).crossJoin(F.broadcast(bases))  # one row
    rows = rows.select("registry", metric.alias("metric"), key.alias("key"), share(F.col("count"), base).alias("value"), least.alias("least_"))
    return keep_share(rows, ["registry"], "value", F.col("least_")).select("metric", "key", "value")


def rest_of(scalars: DataFrame, of_: Column, lists: DataFrame, metrics: Sequence[str], metric: str) -> DataFrame:
    """What lists leave of a share, as one row."""
    sums = lists.where(F.col("metric").isin(*metrics)).agg(F.sum("value").alias("listed"))
    return scalars.select(of_.alias("base_")).crossJoin(sums).select(F.lit(metric).alias("metric"), F.lit("").alias("key"), remainder(F.col("base_"), F.col("listed")).alias("value"))  # one row each


#: Labels that a name has at most in M3.10; names with more count here.
MOST_LABELS = 34


def m3(summary: DataFrame) -> DataFrame:
    """Root traffic: NX share, repeats, leak shares by class, EDNS, DO, name minimisation, recursion, probes, names by number of labels (0 to 34 and more).

    One aggregate gives all scalars, bases and label counts, one pass all lists.
    """
    n = of("root-QR", "0") + of("root-QR", "3")
    parts = [of("NAME_PARTS_COUNT", str(i)) for i in range(MOST_LABELS)]
    parts.append(total_of("NAME_PARTS_COUNT") - sum(parts[1:], parts[0]))
    scalars = summary.agg(
        share(of("root-QR", "3"), n).alias("M3.1"),
        share(of("UsefulQueries", "0"), of("UsefulQueries", "0") + of("UsefulQueries", "1")).alias("M3.2"),
        share(of("UsefulQueries", "3"), of("UsefulQueries", "2") + of("UsefulQueries", "3")).alias("M3.3.5"),
        key_share("EDNS_CLIENT_USAGE").alias("M3.4.1"),
        key_share("DNSSEC_Client_Usage").alias("M3.5"),
        key_share("QNAME_MINIMIZATION_USAGE").alias("M3.6"),
        key_share("SENDING_RECURSIVE_SET").alias("M3.8"),
        share(total_of("CHROMIUM_PROBES"), of("CHROMIUM_LEAK_REF", "0")).alias("M3.9"),
        F.array(*parts).alias("parts_"), n.alias("n_"), of("EDNS_OPTIONS_TOTAL_QUERIES", "0").alias("options_"),
    )
    out = long_rows(scalars, {c: F.col(f"`{c}`") for c in scalars.columns if c.startswith("M")}).where("metric <> 'M3.3.5' OR value > 0")
    key, number = F.col("key"), F.regexp_extract("key", r"(\d+)$", 1)
    listings: list[Listing] = [
        ("RFC6761-TLD", "M3.3.1", key, "n_", 0.0), ("LeakedTLD", "M3.3.2", key, "n_", 0.001), ("LeakByLength", "M3.3.3", F.concat(F.lit("length_"), number), "n_", 0.001),
        ("CHROMIUM_PROBES", "M3.3.3", F.concat(F.lit("chr_"), number), "n_", 0.001), ("LeakedTLD_BINARY", "M3.3.3", F.lit("binary"), "n_", 0.0), ("LeakedTLD_SYNTAX", "M3.3.3", F.lit("bad_syntax"), "n_", 0.0),
        ("LeakedTLD_IPV4", "M3.3.3", F.lit("ipv4"), "n_", 0.0), ("LeakedTLD_NUMERIC", "M3.3.3", F.lit("numeric"), "n_", 0.0), ("Leaked2ndLD", "M3.7", key, "n_", 0.001),
        ("EDNS_OPTIONS_USAGE", "M3.4.2", key, "options_", 0.0),
    ]
    lists = listed(summary, scalars.select("n_", "options_"), listings).where("metric <> 'M3.3.2' OR key <> 'ARPA'")
    labels = scalars.select(F.posexplode("parts_").alias("i", "c"), F.aggregate("parts_", F.lit(0).cast("long"), lambda a, x: a + x).alias("all_"))
    labels = labels.select(F.lit("M3.10").alias("metric"), F.col("i").cast("string").alias("key"), share(F.col("c"), F.col("all_")).alias("value"))
    return out.unionByName(lists).unionByName(labels).unionByName(rest_of(scalars, F.col("`M3.1`"), lists, ("M3.3.1", "M3.3.2", "M3.3.3"), "M3.3.4"))


def m4(summary: DataFrame) -> DataFrame:
    """Recursive traffic: share of delegated names, special-use and frequent names, rest, DO."""
    total = total_of("TLD-Usage-Count")
    least = F.least(share(of("TLD-Usage-Count", "0"), total * 500), F.lit(0.001))
    s = summary.agg(key_share("TLD-Usage-Count").alias("M4.1"), key_share("DNSSEC_Client_Usage").alias("M4.5"), least.alias("least"), total.alias("n_"), total_of("Local_TLD_Usage_Count").alias("local_"))
    lists = listed(summary, s.select("n_"), [("RFC6761Usage", "M4.2", F.col("key"), "n_", 0.0), ("Frequent-TLD-usage", "M4.3", F.col("key"), "n_", 0.0)])
    # one row; a long list's least share goes by the traffic
    lists = keep_share(lists.crossJoin(F.broadcast(s.select("least"))), ["metric"], "value", F.when(F.col("metric") == "M4.3", F.col("least")).otherwise(F.lit(0.0))).drop("least")
    lists = lists.unionByName(s.where("local_ > 0").select(F.lit("M4.3").alias("metric"), F.lit("(local host names)").alias("key"), share(F.col("local_"), F.col("n_")).alias("value")))
    return long_rows(s, {"M4.1": F.col("`M4.1`"), "M4.5": F.col("`M4.5`")}).unionByName(lists).unionByName(rest_of(s, 1 - F.col("`M4.1`"), lists, ("M4.2", "M4.3"), "M4.4"))


def m5(survey: DataFrame, keys: DataFrame) -> DataFrame:
    return mean_by_key(survey, "key", "value", keys).select(F.col("key").alias("metric"), F.lit("").alias("key"), F.col("mean").alias("value"))


def m6(counts: DataFrame, registry: DataFrame) -> DataFrame:
    """Per table: share of registered parameters in use, share of unregistered ones in the traffic, count of each key."""
    c = coverage(counts, registry)
    both = c.select(F.explode(F.array(F.struct(F.concat(F.lit("M6."), "table_id", F.lit(".1")).alias("metric"), F.lit("").alias("key"), F.col("seen_share").alias("value")), F.struct(F.concat(F.lit("M6."), "table_id", F.lit(".2")).alias("metric"), F.lit("").alias("key"), F.col("unregistered_share").alias("value")))).alias("x")).select("x.*")
    each = counts.groupBy("table_id", "key").agg(F.sum("count").cast("double").alias("value"))
    return both.unionByName(each.select(F.concat(F.lit("M6."), "table_id", F.lit(".3")).alias("metric"), F.col("key").cast("string").alias("key"), "value"))


def m7(zone: DataFrame) -> DataFrame:
    """Root zone: share of signed names, of signed two-letter names, and algorithms."""
    z = zone_dnssec(zone, "tld", "algorithm", F.char_length("tld") == 2)
    return z.select(F.when(F.col("metric") == "algorithm", "M7.3").when(F.col("key") == "all", "M7.1").otherwise("M7.2").alias("metric"), F.when(F.col("metric") == "algorithm", F.col("key")).otherwise("").alias("key"), "value")


def m8(summary: DataFrame) -> DataFrame:
    """Authoritative traffic: NX share, EDNS and options, DO, name minimisation; the return-code table counts queries and responses, so half of it is the base."""
    s = summary.agg(share(of("RCODE", "3"), (of("RCODE", "0") + of("RCODE", "3")) / 2).alias("M8.1"), key_share("EDNS_CLIENT_USAGE").alias("M8.2.1"), key_share("DNSSEC_Client_Usage").alias("M8.3"), key_share("QNAME_MINIMIZATION_USAGE").alias("M8.4"), of("EDNS_OPTIONS_TOTAL_QUERIES", "0").alias("options_"))
    options = listed(summary, s.select("options_"), [("EDNS_OPTIONS_USAGE", "M8.2.2", F.col("key"), "options_", 0.0)])
    return long_rows(s, {c: F.col(f"`{c}`") for c in s.columns if c.startswith("M")}).unionByName(options)


def m10(rows: DataFrame) -> DataFrame:
    """Open-resolver use per country from rows M10.<cc>.<name>: allopnrvrs, samecc, diffcc (0 if absent), list and number of services."""
    part = lambda i: F.regexp_extract("metric", r"^M10\.([A-Z]{2})\.(\w+)$", i)
    r = rows.where(F.col("metric").rlike(r"^M10\.[A-Z]{2}\.\w+$")).select(part(1).alias("cc"), part(2).alias("name"), "key", "value")
    pick = lambda n: F.coalesce(F.max(F.when(F.col("name") == n, F.col("value"))), F.lit(0.0)).alias(n)
    services = F.sort_array(F.collect_list(F.when(F.col("name") == "service", F.struct(-F.col("value"), F.col("key")))))
    return r.groupBy("cc").agg(pick("allopnrvrs"), pick("samecc"), pick("diffcc"), services.alias("s")).select("cc", "allopnrvrs", "samecc", "diffcc", F.transform("s", lambda x: x["key"]).alias("services"), F.size("s").alias("n_services"))


def pair_metrics(rows: DataFrame, first: str, second: str) -> DataFrame:
    """(key, share, dnssec): values of two metrics by key, 0 where the second has none."""
    a = rows.where(F.col("metric") == first).select("key", F.col("value").alias("share"))
    b = rows.where(F.col("metric") == second).select("key", F.col("value").alias("dnssec"))
    return a.join(b, "key", "left").fillna({"dnssec": 0.0})


def m11(rows: DataFrame) -> DataFrame:
    """The published set of M11 from rows (metric, key, value): section, place, key, share, dnssec.

    M11_1 to M11_8 are the algorithms of eight slices (dnssec null); providers and tlds join each name's share (M11.15.1,
    M11.16.1) with its share of signed names (M11.15.2, M11.16.2; 0 if it has none; names without a share are left out).
    Within a section larger shares come first, equal ones by key. Of repeated rows the largest value counts.
    """
    part = lambda i: F.regexp_extract("metric", r"^M11\.(?:([1-8])|1([56])\.([12]))$", i)
    r = rows.where(F.col("metric").rlike(r"^M11\.(?:[1-8]|1[56]\.[12])$"))
    r = r.select(F.when(part(2) == "5", "providers").when(part(2) == "6", "tlds").otherwise(F.concat(F.lit("M11_"), part(1))).alias("section"), (part(3) == "2").alias("signed"), "key", "value")
    r = r.groupBy("section", "key").agg(F.max(F.when(~F.col("signed"), F.col("value"))).alias("share"), F.max(F.when(F.col("signed"), F.col("value"))).alias("dnssec")).where("share IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("share"), "key")).cast("long")  # published lists: algorithms, some providers, top-level names
    return r.select("section", place.alias("place"), "key", "share", F.when(~F.col("section").startswith("M11_"), F.coalesce("dnssec", F.lit(0.0))).alias("dnssec"))


def sum3(summary: DataFrame, named: Sequence[str] = ("LOCAL", "LOCALHOST", "HOME", "LAN", "INTERNAL", "IP", "LOCALDOMAIN", "CORP", "MAIL")) -> DataFrame:
    """One slice row from a summary: queries, nx_domain, useful, useless, dga, jumbo, others, the named leaks, special-use names not among them (rfc6761), other_names."""
    length = lambda a, b: F.coalesce(F.sum(F.when((F.col("registry") == "LeakByLength") & F.regexp_extract("key", r"(\d+)$", 1).try_cast("int").between(a, b), F.col("count"))), F.lit(0))
    leaks = [F.coalesce(F.sum(F.when(F.col("registry").isin("LeakedTLD", "RFC6761-TLD") & (F.col("key") == n), F.col("count"))), F.lit(0)).alias(n.lower()) for n in named]
    a = summary.agg(of("root-QR", "0").alias("ok"), of("root-QR", "3").alias("nx_domain"), of("UsefulQueries", "0").alias("u0"), of("UsefulQueries", "1").alias("u1"), total_of("CHROMIUM_PROBES").alias("probes"), total_of("CHROMIUM_LEAK_REF").alias("ref"), length(7, 15).alias("d"), length(16, 64).alias("jumbo"), total_of("RFC6761-TLD").alias("special"), *leaks)
    a = a.withColumn("useless", F.floor(share(F.col("u0"), F.col("u0") + F.col("u1")) * F.col("ok")).cast("long")).withColumn("queries", F.col("ok") + F.col("nx_domain"))
    a = a.withColumn("dga", F.when((F.col("probes") == 0) & (F.col("ref") == 0), F.col("d")).otherwise(F.col("probes"))).withColumn("useful", F.col("queries") - F.col("useless") - F.col("nx_domain"))
    a = a.withColumn("others", F.col("nx_domain") - F.col("dga") - F.col("jumbo"))
    names = [n.lower() for n in named]
    a = a.withColumn("rfc6761", F.col("special") - sum((F.col(n) for n in names if n.upper() in RFC6761), F.lit(0)))
    return a.withColumn("other_names", F.col("others") - sum((F.col(n) for n in names), F.col("rfc6761"))).select("queries", "nx_domain", "useful", "useless", "dga", "others", *names, "rfc6761", "other_names", "jumbo")


@query("metrics_m1", """WITH r AS (SELECT l_suppkey AS id, count(*) AS domains, sum((l_returnflag = 'R')::INT)::BIGINT AS notices FROM lineitem GROUP BY 1),
c AS (SELECT *, sum(notices) OVER (ORDER BY notices DESC, id ROWS UNBOUNDED PRECEDING) AS cum, sum(notices) OVER () AS t FROM r)
SELECT metric, key, round(value, 6) AS value FROM (SELECT 'M1.1' AS metric, '' AS key, sum(notices) * 1e6 / sum(domains) AS value FROM r UNION ALL SELECT 'M1.2', '', sum((cum - notices < 0.5 * t)::INT) FROM c
  UNION ALL SELECT 'M1.3', '', sum((cum - notices < 0.9 * t)::INT) FROM c UNION ALL SELECT 'M1.4', '', count(*) FROM r)
""")
def metrics_m1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as registrars, returned items as notices."""
    li = read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("iana_id")).agg(F.count("*").alias("domain_count"), F.sum((F.col("l_returnflag") == "R").cast("long")).alias("first_notices"))
    return m1(li).withColumn("value", F.round("value", 6))


@query("metrics_m2", """WITH r AS (SELECT l_suppkey AS id, count(*) AS domains, sum((l_returnflag = 'R')::INT)::BIGINT AS a, sum((l_returnflag = 'A')::INT)::BIGINT AS b, sum((l_linestatus = 'O')::INT)::BIGINT AS c, sum((l_quantity > 45)::INT)::BIGINT AS d FROM lineitem GROUP BY 1),
x AS (SELECT id, domains, 1 AS i, a AS v FROM r UNION ALL SELECT id, domains, 2, b FROM r UNION ALL SELECT id, domains, 3, d FROM r UNION ALL SELECT id, domains, 4, c FROM r),
c AS (SELECT *, sum(v) OVER (PARTITION BY i ORDER BY v DESC, id ROWS UNBOUNDED PRECEDING) AS cum, sum(v) OVER (PARTITION BY i) AS t FROM x),
g AS (SELECT i, sum(v) * 10000.0 / sum(domains) AS r, sum((cum - v < 0.5 * t)::INT) AS k50, sum((cum - v < 0.9 * t)::INT) AS k90 FROM c GROUP BY i)
SELECT 'M2.2.' || i || '.1' AS metric, '' AS key, round(r, 6) AS value FROM g UNION ALL SELECT 'M2.2.' || i || '.2', '', k50 FROM g UNION ALL SELECT 'M2.2.' || i || '.3', '', k90 FROM g
""")
def metrics_m2(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda c: F.sum(c.cast("long"))
    li = read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("name")).agg(F.count("*").alias("domains"), one(F.col("l_returnflag") == "R").alias("phishing"), one(F.col("l_returnflag") == "A").alias("malware"), one(F.col("l_linestatus") == "O").alias("spam"), one(F.col("l_quantity") > 45).alias("botnet"))
    return m2(li, 2).withColumn("value", F.round("value", 6))


@query("metrics_m6", """WITH c AS (SELECT l_returnflag AS t, l_linenumber::VARCHAR AS key, count(*) AS n FROM lineitem GROUP BY ALL), r AS (SELECT DISTINCT l_returnflag AS t, ((s_suppkey % 6) * 2)::VARCHAR AS key FROM supplier, (SELECT DISTINCT l_returnflag FROM lineitem))
SELECT metric, key, round(value, 9) AS value FROM (
  SELECT 'M6.' || r.t || '.1' AS metric, '' AS key, count(c.key)::DOUBLE / count(*) AS value FROM r LEFT JOIN c ON r.t = c.t AND r.key = c.key GROUP BY r.t
  UNION ALL SELECT 'M6.' || c.t || '.2', '', coalesce(sum(n) FILTER (r.key IS NULL), 0)::DOUBLE / sum(n) FROM c LEFT JOIN r ON r.t = c.t AND r.key = c.key GROUP BY c.t
  UNION ALL SELECT 'M6.' || t || '.3', key, n::DOUBLE FROM c)
""")
def metrics_m6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers as parameters in use; even ones are registered."""
    li = read(spark, sf_dir, "lineitem")
    counts = li.groupBy(F.col("l_returnflag").alias("table_id"), F.col("l_linenumber").cast("string").alias("key")).agg(F.count("*").alias("count"))
    keys = read(spark, sf_dir, "supplier").select(((F.col("s_suppkey") % 6) * 2).cast("string").alias("key")).distinct()
    tables = li.select(F.col("l_returnflag").alias("table_id")).distinct()
    return m6(counts, tables.crossJoin(F.broadcast(keys))).withColumn("value", F.round("value", 9))  # three flags, six keys


@query("metrics_m10", """WITH c AS (SELECT upper(substr(n_name, 1, 2)) AS cc, c_mktsegment AS seg, c_acctbal AS a FROM customer JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT cc, seg, count(*) AS n FROM c GROUP BY ALL), l AS (SELECT cc, string_agg(seg, ',' ORDER BY n DESC, seg) AS services, count(*)::INT AS n_services FROM s GROUP BY cc)
SELECT cc, count(*)::DOUBLE AS allopnrvrs, (count(*) FILTER (a > 9000))::DOUBLE AS samecc, (count(*) FILTER (a < -900))::DOUBLE AS diffcc, services, n_services FROM c JOIN l USING (cc) GROUP BY ALL
""")
def metrics_m10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as countries, customers as users of resolvers, market segments as services."""
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.upper(F.substring("n_name", 1, 2)).alias("cc"))
    c = read(spark, sf_dir, "customer").join(n, "c_nationkey")
    name = lambda x: F.concat(F.lit("M10."), F.col("cc"), F.lit(f".{x}")).alias("metric")
    count = lambda df, x, *key: df.groupBy(name(x), (F.col(key[0]) if key else F.lit("")).alias("key")).agg(F.count("*").cast("double").alias("value"))
    rows = count(c, "allopnrvrs").unionByName(count(c.where("c_acctbal > 9000"), "samecc")).unionByName(count(c.where("c_acctbal < -900"), "diffcc")).unionByName(count(c, "service", "c_mktsegment"))
    return m10(rows).withColumn("services", F.array_join("services", ","))


@query("pair_metrics", "WITH a AS (SELECT o_custkey::VARCHAR AS key, count(*)::DOUBLE AS share FROM orders GROUP BY 1), b AS (SELECT o_custkey::VARCHAR AS key, count(*)::DOUBLE AS dnssec FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT a.key, share, coalesce(dnssec, 0) AS dnssec FROM a LEFT JOIN b ON a.key = b.key")
def pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumn("key", F.col("o_custkey").cast("string"))
    a = o.groupBy(F.lit("a").alias("metric"), "key").agg(F.count("*").cast("double").alias("value"))
    b = o.where("o_orderstatus = 'F'").groupBy(F.lit("b").alias("metric"), "key").agg(F.count("*").cast("double").alias("value"))
    return pair_metrics(a.unionByName(b), "a", "b")


@query("metrics_m11", """WITH s AS (SELECT 'M11_' || (l_orderkey % 8 + 1) AS section, l_linenumber::VARCHAR AS key, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY l_orderkey % 8) AS share, NULL::DOUBLE AS dnssec FROM lineitem GROUP BY l_orderkey % 8, l_linenumber),
p AS (SELECT 'providers' AS section, l_suppkey::VARCHAR AS key, count(*)::DOUBLE / sum(count(*)) OVER () AS share, sum((l_linestatus = 'F')::INT)::DOUBLE / count(*) AS dnssec FROM lineitem GROUP BY l_suppkey),
t AS (SELECT 'tlds' AS section, l_returnflag || l_linenumber AS key, count(*)::DOUBLE / sum(count(*)) OVER () AS share, sum((l_linestatus = 'F')::INT)::DOUBLE / count(*) AS dnssec FROM lineitem GROUP BY l_returnflag, l_linenumber)
SELECT section, row_number() OVER (PARTITION BY section ORDER BY share DESC, key) AS place, key, round(share, 9) AS share, round(dnssec, 9) AS dnssec FROM (FROM s UNION ALL FROM p UNION ALL FROM t)
""")
def metrics_m11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dealt to eight slices, line numbers as algorithms; suppliers as providers, flags with line numbers as top-level names, finished items as signed names. One scan."""
    section = F.explode(F.array(F.struct(F.concat(F.lit("M11."), (F.col("l_orderkey") % 8 + 1).cast("string")).alias("metric"), F.col("l_linenumber").cast("string").alias("key")), F.struct(F.lit("M11.15.").alias("metric"), F.col("l_suppkey").cast("string").alias("key")), F.struct(F.lit("M11.16.").alias("metric"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("key"))))
    counts = read(spark, sf_dir, "lineitem").select(section.alias("x"), (F.col("l_linestatus") == "F").alias("signed")).groupBy("x.metric", "x.key").agg(F.count("*").alias("n"), F.sum(F.col("signed").cast("long")).alias("signed"))
    counts = counts.withColumn("all", F.sum("n").over(Window.partitionBy("metric")))
    table = F.col("metric").endswith(".")
    values = F.array(F.struct(F.when(table, F.concat("metric", F.lit("1"))).otherwise(F.col("metric")).alias("metric"), (F.col("n") / F.col("all")).alias("value")), F.struct(F.when(table, F.concat("metric", F.lit("2"))).alias("metric"), (F.col("signed") / F.col("n")).alias("value")))
    return m11(counts.select("key", F.explode(values).alias("x")).select("x.metric", "key", "x.value")).withColumns({"share": F.round("share", 9), "dnssec": F.round("dnssec", 9)})

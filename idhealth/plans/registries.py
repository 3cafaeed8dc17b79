"""Wire messages bound to the events table, their registries in one pass, and the metrics that follow from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idhealth.functions.times import micros
from idhealth.operators.counters import extract, lookup
from idhealth.operators.registries import SELDOM, message_registries

from .catalog import query, read
from .metrics import MOST_LABELS, m3, m4, m6, m8, sum3

REGISTERED = ("COM", "NET", "ERROR", "ARPA")
#: Names that the bound messages' lists keep.
LISTED = 16
RECORDS = "array<struct<section:string,name:string,type:int,class:int,ttl:bigint,rdata:binary>>"


def wire_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decoded message per event: a third goes to root servers, a fourth are queries; names of all leak classes, signatures, EDNS with options."""
    e = read(spark, sf_dir, "events").select(F.col("event_id").alias("i"), F.col("user_id").alias("u"), "event_type", "ts", F.get_json_object("props", "$.k").cast("long").alias("k"))
    letters = lambda c: F.translate(c.cast("string"), "0123456789", "abcdefghij")
    i, u, k, t = F.col("i"), F.col("u"), F.col("k"), F.col("event_type")
    names = [
        t, F.concat(F.lit("host"), k, F.lit(".local")), F.concat(F.lit("10.0."), k, F.lit(".1")), F.concat(F.lit("x."), k), F.concat(F.lit("a.bad_"), k % 7), F.concat(F.lit("probe"), letters(i)),
        F.concat(F.lit("www."), t, F.lit(".com")), F.lit("printer.home"), F.lit(""), F.concat(F.lit("very.longlonglonglong"), letters(i % 40)), F.concat(F.lit("ns."), letters(u), F.lit(".arpa")), F.concat(F.lit("host-"), k, F.lit(".d"), letters(F.floor(i / 15) % 300)),
    ]
    e = e.withColumn("name", F.element_at(F.array(*names), (k % len(names) + 1).cast("int")))
    name = F.col("name")
    answers = i % 4 != 3
    rcode = F.when(i % 5 == 0, 3).when(i % 53 == 0, 2).otherwise(0)
    minimizes = u % 11 == 3
    has_answer, has_authority = answers & (rcode == 0) & (i % 2 == 0), answers & (i % 7 == 1) & ~minimizes
    octets = lambda x: F.unhex(F.lit(x)) if isinstance(x, str) else F.unhex(x)
    rr = lambda section, owner, kind, klass, ttl, data: F.struct(F.lit(section).alias("section"), owner.alias("name"), F.lit(kind).alias("type"), F.lit(klass).alias("class"), ttl.cast("long").alias("ttl"), octets(data).alias("rdata"))
    ttl = F.when(u % 3 == 0, 32768).otherwise(0) + F.when(i % 101 == 0, 1 << 24).otherwise(0)
    options = F.when(k % 4 == 0, "000A0000").when(k % 4 == 1, "00080002AABB000A0000").otherwise("")
    records = [
        F.when(has_answer, rr("answer", F.when((i % 6 == 0) | minimizes, name).otherwise(F.concat(F.lit("zone."), t)), 1, 1, F.lit(60), "01020304")),
        F.when(has_authority, rr("authority", F.concat(t, F.lit(".net")), 46, 1, F.lit(60), F.concat(F.lit("0001"), F.when(u % 2 == 0, "08").otherwise("0D"), F.lit("00" * 17)))),
        F.when(u % 4 != 2, rr("additional", F.lit(""), 41, 4096, ttl, options)),
    ]
    flags = F.when(u % 10 == 1, 16).otherwise(0) + F.when(i % 7 == 0, 64).otherwise(0)
    return e.select(
        F.concat(F.lit("c"), u).alias("client"), F.when(i % 3 == 0, "root").otherwise("user").alias("server"), micros(F.col("ts")).alias("us"), answers.alias("is_response"), F.when(i % 97 == 0, 5).otherwise(0).alias("opcode"),
        rcode.alias("rcode"), flags.alias("flags"), name.alias("qname"), F.when(minimizes, 1).otherwise(F.element_at(F.array(F.lit(1), F.lit(2), F.lit(16)), (F.floor(i / 3) % 3 + 1).cast("int"))).alias("qtype"), F.when((k == 99) & ~minimizes, 3).otherwise(1).alias("qclass"),
        has_answer.cast("int").alias("n_answer"), has_authority.cast("int").alias("n_authority"), F.concat(*[F.when(r.isNotNull(), F.array(r)).otherwise(F.array().cast(RECORDS)) for r in records]).alias("rrs"), (i % 211 == 0).alias("error"), (40 + k).cast("int").alias("size"),
    )


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registries of the bound messages; written, as metrics use them more than once."""
    roots = spark.range(1).select(F.lit("root").alias("server"))
    registered = spark.range(1).select(F.explode(F.array(*map(F.lit, REGISTERED))).alias("tld"))
    zones = spark.range(1).select(F.lit("com").alias("suffix"), F.lit("std").alias("kind"))
    return message_registries(wire_messages(spark, sf_dir), roots, registered, zones, LISTED, nx_usage=True, sizes=True, count_queries=True, underscores=True)


_LETTERS = lambda x: f"translate(({x})::VARCHAR, '0123456789', 'abcdefghij')"
_NAMES = (
    "event_type", "'host' || k || '.local'", "'10.0.' || k || '.1'", "'x.' || k", "'a.bad_' || (k % 7)", f"'probe' || {_LETTERS('i')}", "'www.' || event_type || '.com'", "'printer.home'", "''",
    f"'very.longlonglonglong' || {_LETTERS('i % 40')}", f"'ns.' || {_LETTERS('u')} || '.arpa'", f"'host-' || k || '.d' || {_LETTERS('i // 15 % 300')}",
)
_COUNT = lambda registry, key, where="true", table="m": f"SELECT '{registry}' AS registry, ({key})::VARCHAR AS key, count(*) AS count FROM {table} WHERE {where} GROUP BY 2"

#: The same counters in SQL; `s` is the summary.
REGISTRIES_SQL = f"""
WITH e AS (SELECT event_id AS i, user_id AS u, event_type, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
a AS (SELECT *, i % 4 <> 3 AS answers, i % 3 = 0 AS at_root, i % 97 <> 0 AS plain, CASE WHEN i % 5 = 0 THEN 3 WHEN i % 53 = 0 THEN 2 ELSE 0 END AS rcode, CASE (k % 12)::INT {" ".join(f"WHEN {j} THEN {x}" for j, x in enumerate(_NAMES))} END AS qname,
  CASE WHEN u % 11 = 3 THEN 1 ELSE [1, 2, 16][(i // 3 % 3 + 1)::INT] END AS qtype, CASE WHEN k = 99 AND u % 11 <> 3 THEN 3 ELSE 1 END AS qclass, i % 211 <> 0 AS clean, u % 10 = 1 AS rd, u % 4 <> 2 AS edns, k % 12 AS form FROM e),
b AS (SELECT *, answers AND rcode = 0 AND i % 2 = 0 AS answer, answers AND i % 7 = 1 AND u % 11 <> 3 AS authority, upper(string_split(qname, '.')[-1]) AS tld, CASE WHEN qname = '' THEN 0 ELSE len(string_split(qname, '.')) END AS parts,
  CASE WHEN form = 1 THEN 'rfc6761' WHEN form = 2 THEN 'ipv4' WHEN form = 3 THEN 'numeric' WHEN form IN (4, 8) THEN 'bad_syntax' ELSE 'name' END AS kind FROM a),
m AS (SELECT *, tld IN {REGISTERED} AS known, CASE WHEN rcode = 3 AND tld = 'ARPA' THEN 0 ELSE rcode END AS fixed, edns AND (u % 3 = 0 OR authority) AS dok, plain AND rcode = 0 AND clean AS good,
  CASE WHEN answer THEN CASE WHEN i % 6 = 0 OR u % 11 = 3 THEN qname ELSE 'zone.' || event_type END WHEN authority THEN event_type || '.net' END AS owner FROM b),
r AS (SELECT *, at_root AND answers AND plain AND fixed = 3 AS nx, at_root AND answers AND plain AND fixed = 0 AND (answer OR authority) AS found FROM m),
f AS (SELECT *, nx AND kind = 'name' AS leak, CASE WHEN parts <= 1 THEN '-- NONE --' ELSE upper(string_split(qname, '.')[-2]) END AS second FROM r),
rr AS (SELECT 1 AS t, 1 AS c, answers, u, i FROM m WHERE answer UNION ALL SELECT 46, 1, answers, u, i FROM m WHERE authority),
us AS (SELECT u, tld, count(*) AS n, arg_min(CASE WHEN nx THEN 1 ELSE 0 END, epoch_us(ts) * 2 + CASE WHEN nx THEN 1 ELSE 0 END) AS nx FROM r WHERE nx OR found GROUP BY ALL),
cl AS (SELECT u, bool_or(dok) AS d, bool_or(edns) AS e, bool_or(rd) AS r, bool_and(qclass = 1 AND qtype IN (1, 2) AND (owner IS NULL OR lower(owner) = lower(qname))) AS mini FROM m WHERE answers AND good GROUP BY u),
ask AS (SELECT * FROM m WHERE NOT answers AND good AND known),
op AS (SELECT DISTINCT u, unnest(CASE k % 4 WHEN 0 THEN [10] WHEN 1 THEN [8, 10] ELSE [] END) AS o FROM ask WHERE edns),
z AS (SELECT array_to_string(string_split(upper(name), '.')[-2:], '.') AS zone, bool_or(signed) AS signed FROM (SELECT CASE WHEN authority THEN event_type || '.net' ELSE qname END AS name, authority AS signed FROM m WHERE answers AND good AND dok) WHERE name <> '' GROUP BY 1),
top AS (SELECT registry, key, count, probe, CASE WHEN NOT (probe AND count < {SELDOM}) THEN row_number() OVER (PARTITION BY registry, probe AND count < {SELDOM} ORDER BY count DESC, key) <= {LISTED} ELSE false END AS top FROM (
  SELECT 'LeakedTLD' AS registry, tld AS key, count(*) AS count, bool_and(parts = 1) AND regexp_full_match(tld, '[A-Za-z]{{7,15}}') AS probe FROM f WHERE leak GROUP BY tld
  UNION ALL SELECT 'Leaked2ndLD', second, count(*), false FROM f WHERE leak GROUP BY second)),
s AS (SELECT registry, key, sum(count)::BIGINT AS count FROM (
  {_COUNT("OpCode", "CASE WHEN plain THEN 0 ELSE 5 END")} UNION ALL {_COUNT("RCODE", "rcode | CASE WHEN edns AND i % 101 = 0 THEN 16 ELSE 0 END")} UNION ALL {_COUNT("Z-Error Flags", "(NOT clean)::INT")}
  UNION ALL {_COUNT("Header Flags", "4", "rd")} UNION ALL {_COUNT("Header Flags", "6", "i % 7 = 0")}
  UNION ALL {_COUNT("CLASS", "c", "answers", "rr")} UNION ALL {_COUNT("RR Type", "t", "answers", "rr")} UNION ALL {_COUNT("RR Type", "41", "answers AND edns")} UNION ALL {_COUNT("Q-RR Type", "41", "NOT answers AND edns")}
  UNION ALL {_COUNT("Q-CLASS", "qclass")} UNION ALL {_COUNT("Q-RR Type", "qtype")} UNION ALL {_COUNT("DNSSEC Algorithm Numbers", "CASE WHEN u % 2 = 0 THEN 8 ELSE 13 END", "t = 46", "rr")}
  UNION ALL {_COUNT("EDNS Version number", "0", "edns")} UNION ALL {_COUNT("EDNS Header_Flags", "0", "dok")} UNION ALL {_COUNT("EDNS OPT CODE", "10", "edns AND k % 4 < 2")} UNION ALL {_COUNT("EDNS OPT CODE", "8", "edns AND k % 4 = 1")}
  UNION ALL {_COUNT("Response Size", "40 + k", "answers")} UNION ALL {_COUNT("Query Size", "40 + k", "NOT answers")} UNION ALL {_COUNT("EDNS Packet Size", "CASE WHEN edns THEN 4096 ELSE 512 END", "NOT answers")} UNION ALL {_COUNT("Underlined part", "'TXT'", "qtype = 16")}
  UNION ALL {_COUNT("root-QR", "rcode", "at_root AND answers AND plain")} UNION ALL {_COUNT("CHROMIUM_LEAK_REF", "0", "at_root AND answers AND plain AND rcode IN (0, 3)")} UNION ALL {_COUNT("NAME_PARTS_COUNT", "parts", "nx OR found", "r")}
  UNION ALL {_COUNT("RFC6761-TLD", "tld", "nx AND kind = 'rfc6761'", "r")} UNION ALL {_COUNT("LeakedTLD_SYNTAX", "0", "nx AND kind = 'bad_syntax'", "r")} UNION ALL {_COUNT("LeakedTLD_IPV4", "0", "nx AND kind = 'ipv4'", "r")} UNION ALL {_COUNT("LeakedTLD_NUMERIC", "0", "nx AND kind = 'numeric'", "r")}
  UNION ALL SELECT CASE WHEN top OR registry = 'Leaked2ndLD' THEN registry WHEN probe THEN 'CHROMIUM_PROBES' ELSE 'LeakByLength' END, CASE WHEN top THEN key WHEN registry = 'Leaked2ndLD' THEN '-- OTHERS --' ELSE length(key)::VARCHAR END, count FROM top
  UNION ALL SELECT 'UsefulQueries', CASE WHEN nx = 1 THEN '2' ELSE '1' END, count(*) FROM us GROUP BY nx UNION ALL SELECT 'UsefulQueries', CASE WHEN nx = 1 THEN '3' ELSE '0' END, sum(n - 1)::BIGINT FROM us GROUP BY nx
  UNION ALL {_COUNT("TLD-Usage-Count", "(known OR tld = '')::INT", "answers AND plain AND NOT at_root")} UNION ALL {_COUNT("RFC6761Usage", "tld", "answers AND plain AND NOT at_root AND NOT known AND kind = 'rfc6761'")}
  UNION ALL {_COUNT("Frequent-TLD-usage", "CASE kind WHEN 'bad_syntax' THEN '-- SYNTAX --' WHEN 'ipv4' THEN '-- IPV4 --' WHEN 'numeric' THEN '-- NUMBER --' ELSE tld END", "answers AND plain AND NOT at_root AND NOT known AND tld <> '' AND kind <> 'rfc6761'")}
  UNION ALL {_COUNT("DNSSEC_Client_Usage", "d::INT", table="cl")} UNION ALL {_COUNT("EDNS_CLIENT_USAGE", "e::INT", table="cl")} UNION ALL {_COUNT("SENDING_RECURSIVE_SET", "r::INT", table="cl")} UNION ALL {_COUNT("QNAME_MINIMIZATION_USAGE", "(mini AND NOT r)::INT", table="cl")}
  UNION ALL SELECT 'EDNS_OPTIONS_TOTAL_QUERIES', '0', count(DISTINCT u) FROM ask UNION ALL {_COUNT("EDNS_OPTIONS_USAGE", "o", table="op")} UNION ALL {_COUNT("DNSSEC_Zone_Usage", "signed::INT", table="z")}) GROUP BY ALL),
q AS (SELECT coalesce(sum(count) FILTER (registry = 'root-QR' AND key IN ('0', '3')), 0)::DOUBLE AS n, coalesce(sum(count) FILTER (registry = 'root-QR' AND key = '3'), 0)::DOUBLE AS nx, sum(count) FILTER (registry = 'TLD-Usage-Count')::DOUBLE AS users,
  sum(count) FILTER (registry = 'TLD-Usage-Count' AND key = '0')::DOUBLE AS other, sum(count) FILTER (registry = 'EDNS_OPTIONS_TOTAL_QUERIES')::DOUBLE AS asked, sum(count) FILTER (registry = 'NAME_PARTS_COUNT')::DOUBLE AS parts FROM s),
one AS (SELECT registry, coalesce(sum(count) FILTER (key = '1'), 0)::DOUBLE / sum(count) AS value FROM s GROUP BY registry),
l AS (SELECT registry, key, count / CASE WHEN registry = 'EDNS_OPTIONS_USAGE' THEN asked WHEN registry IN ('RFC6761Usage', 'Frequent-TLD-usage') THEN users ELSE n END AS value, count(*) OVER (PARTITION BY registry) AS size FROM s, q),
l3 AS (SELECT CASE registry WHEN 'RFC6761-TLD' THEN 'M3.3.1' WHEN 'LeakedTLD' THEN 'M3.3.2' WHEN 'Leaked2ndLD' THEN 'M3.7' WHEN 'EDNS_OPTIONS_USAGE' THEN 'M3.4.2' ELSE 'M3.3.3' END AS metric,
  CASE registry WHEN 'LeakByLength' THEN 'length_' || key WHEN 'CHROMIUM_PROBES' THEN 'chr_' || key WHEN 'LeakedTLD_SYNTAX' THEN 'bad_syntax' WHEN 'LeakedTLD_IPV4' THEN 'ipv4' WHEN 'LeakedTLD_NUMERIC' THEN 'numeric' ELSE key END AS key, value
  FROM l WHERE registry IN ('RFC6761-TLD', 'EDNS_OPTIONS_USAGE', 'LeakedTLD_SYNTAX', 'LeakedTLD_IPV4', 'LeakedTLD_NUMERIC') OR registry IN ('LeakedTLD', 'Leaked2ndLD', 'LeakByLength', 'CHROMIUM_PROBES') AND (size < 8 OR value >= 0.001)),
l4 AS (SELECT CASE registry WHEN 'RFC6761Usage' THEN 'M4.2' ELSE 'M4.3' END AS metric, key, value FROM l, q WHERE registry = 'RFC6761Usage' OR registry = 'Frequent-TLD-usage' AND (size < 8 OR value >= least(other / users / 500, 0.001)))
"""


@query("message_registries", REGISTRIES_SQL + "SELECT * FROM s")
def registries_of_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(spark, sf_dir)


_USEFUL = lambda a, b: f"(SELECT sum(count) FILTER (key = '{a}')::DOUBLE / sum(count) FILTER (key IN ('{a}', '{b}')) FROM s WHERE registry = 'UsefulQueries')"


@query("metrics_m3", REGISTRIES_SQL + f"""
SELECT metric, key, round(value, 9) AS value FROM (
  SELECT 'M3.1' AS metric, '' AS key, nx / n AS value FROM q UNION ALL SELECT 'M3.2', '', {_USEFUL(0, 1)} UNION ALL SELECT 'M3.3.5', '', {_USEFUL(3, 2)}
  UNION ALL SELECT CASE registry WHEN 'EDNS_CLIENT_USAGE' THEN 'M3.4.1' WHEN 'DNSSEC_Client_Usage' THEN 'M3.5' WHEN 'QNAME_MINIMIZATION_USAGE' THEN 'M3.6' ELSE 'M3.8' END, '', value FROM one WHERE registry IN ('EDNS_CLIENT_USAGE', 'DNSSEC_Client_Usage', 'QNAME_MINIMIZATION_USAGE', 'SENDING_RECURSIVE_SET')
  UNION ALL SELECT 'M3.9', '', (SELECT sum(count) FROM s WHERE registry = 'CHROMIUM_PROBES') / n FROM q UNION ALL SELECT * FROM l3
  UNION ALL SELECT 'M3.10', i::VARCHAR, (SELECT coalesce(sum(count), 0) FROM s WHERE registry = 'NAME_PARTS_COUNT' AND least(key::BIGINT, {MOST_LABELS}) = i) / parts FROM range({MOST_LABELS + 1}) t(i), q
  UNION ALL SELECT 'M3.3.4', '', greatest(0, nx / n - (SELECT sum(value) FROM l3 WHERE metric IN ('M3.3.1', 'M3.3.2', 'M3.3.3'))) FROM q)
""")
def metrics_m3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m3(summary(spark, sf_dir)).withColumn("value", F.round("value", 9))


@query("metrics_m4", REGISTRIES_SQL + """
SELECT metric, key, round(value, 9) AS value FROM (
  SELECT 'M4.1' AS metric, '' AS key, 1 - other / users AS value FROM q UNION ALL SELECT * FROM l4 UNION ALL SELECT 'M4.4', '', greatest(0, other / users - (SELECT sum(value) FROM l4)) FROM q UNION ALL SELECT 'M4.5', '', value FROM one WHERE registry = 'DNSSEC_Client_Usage')
""")
def metrics_m4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m4(summary(spark, sf_dir)).withColumn("value", F.round("value", 9))


@query("metrics_m8", REGISTRIES_SQL + """
SELECT metric, key, round(value, 9) AS value FROM (
  SELECT 'M8.1' AS metric, '' AS key, sum(count) FILTER (key = '3')::DOUBLE / (sum(count) FILTER (key IN ('0', '3')) / 2.0) AS value FROM s WHERE registry = 'RCODE'
  UNION ALL SELECT CASE registry WHEN 'EDNS_CLIENT_USAGE' THEN 'M8.2.1' WHEN 'DNSSEC_Client_Usage' THEN 'M8.3' ELSE 'M8.4' END, '', value FROM one WHERE registry IN ('EDNS_CLIENT_USAGE', 'DNSSEC_Client_Usage', 'QNAME_MINIMIZATION_USAGE')
  UNION ALL SELECT 'M8.2.2', key, value FROM l WHERE registry = 'EDNS_OPTIONS_USAGE')
""")
def metrics_m8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m8(summary(spark, sf_dir)).withColumn("value", F.round("value", 9))


#: Tables of M6 that wire messages have, with a few registered keys each.
_TABLES = {"DNS.01": ("CLASS", (1, 3, 4)), "DNS.02": ("RR Type", (1, 2, 41, 46, 48)), "DNS.03": ("OpCode", (0, 1, 2, 4)), "DNS.08": ("EDNS OPT CODE", (3, 8, 10)), "DNSSEC.3": ("DNSSEC Algorithm Numbers", (8, 10)), "DANE.1": ("DANE_CertUsage", (0, 1))}


@query("metrics_m6_messages", REGISTRIES_SQL + f""", t(id, registry, keys) AS (VALUES {", ".join(f"('{t}', '{r}', {list(map(str, k))})" for t, (r, k) in _TABLES.items())}),
g AS (SELECT id, unnest(keys) AS key FROM t), c AS (SELECT id, key, count FROM s JOIN t USING (registry))
SELECT metric, key, round(value, 9) AS value FROM (
  SELECT 'M6.' || g.id || '.1' AS metric, '' AS key, count(c.key)::DOUBLE / count(*) AS value FROM g LEFT JOIN c USING (id, key) GROUP BY g.id
  UNION ALL SELECT 'M6.' || t.id || '.2', '', coalesce((SELECT sum(count) FILTER (NOT list_contains(t.keys, c.key))::DOUBLE / sum(count) FROM c WHERE c.id = t.id), 0) FROM t
  UNION ALL SELECT 'M6.' || id || '.3', key, count::DOUBLE FROM c)
""")
def metrics_m6_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters in use from the messages' registries; a table that no message touches is there with zeros."""
    tables = F.array(*[F.struct(F.lit(t).alias("table_id"), F.lit(r).alias("registry"), F.array(*[F.lit(str(x)) for x in k]).alias("keys")) for t, (r, k) in _TABLES.items()])
    domain = spark.range(1).select(F.explode(tables).alias("t")).select("t.*")
    counts = summary(spark, sf_dir).join(F.broadcast(domain), "registry").select("table_id", "key", "count")  # a row per table of the constant above
    return m6(counts, domain.select("table_id", F.explode("keys").alias("key"))).withColumn("value", F.round("value", 9))


@query("slice_summary", REGISTRIES_SQL + """, v AS (SELECT n::BIGINT AS queries, nx::BIGINT AS nx, floor((SELECT sum(count) FILTER (key = '0')::DOUBLE / sum(count) FILTER (key IN ('0', '1')) FROM s WHERE registry = 'UsefulQueries') * (n - nx))::BIGINT AS useless,
  (SELECT coalesce(sum(count), 0) FROM s WHERE registry = 'CHROMIUM_PROBES')::BIGINT AS dga, (SELECT coalesce(sum(count), 0) FROM s WHERE registry = 'LeakByLength' AND key::INT BETWEEN 16 AND 64)::BIGINT AS jumbo,
  (SELECT coalesce(sum(count), 0) FROM s WHERE registry = 'RFC6761-TLD' AND key = 'LOCAL')::BIGINT AS local, (SELECT coalesce(sum(count), 0) FROM s WHERE registry = 'LeakedTLD' AND key = 'HOME')::BIGINT AS home FROM q)
SELECT queries, nx AS nx_domain, queries - useless - nx AS useful, useless, dga, nx - dga - jumbo AS others, local, home, 0::BIGINT AS rfc6761, nx - dga - jumbo - local - home AS other_names, jumbo FROM v""")
def slice_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sum3(summary(spark, sf_dir)).select("queries", "nx_domain", "useful", "useless", "dga", "others", "local", "home", "rfc6761", "other_names", "jumbo")


@query("lookup", REGISTRIES_SQL + "SELECT (SELECT nx::BIGINT FROM q) AS nx, (SELECT count FROM s WHERE registry = 'UsefulQueries' AND key = '1') AS pairs, 0::BIGINT AS absent")
def lookup_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup(summary(spark, sf_dir), {"nx": ("root-QR", "3"), "pairs": ("UsefulQueries", "1"), "absent": ("root-QR", "99")})


@query("extract", REGISTRIES_SQL + "SELECT key, count FROM s WHERE registry = 'LeakedTLD'")
def extract_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(summary(spark, sf_dir), "LeakedTLD")

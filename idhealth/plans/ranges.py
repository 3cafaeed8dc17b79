"""Range queries: ranges are made from part and customer keys, lookups are line items' parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idhealth.operators import ranges as r

from .catalog import query, read

_BLOCKS = "b AS (SELECT DISTINCT (p_partkey // 100) * 100 AS lo, (p_partkey // 100) * 100 + 59 AS hi, (p_partkey // 100) % 7 + 1 AS asn FROM part)"


@query("ip_to_asn", f"WITH {_BLOCKS} SELECT l_orderkey, l_linenumber, l_partkey, coalesce(asn, 0) AS asn FROM lineitem LEFT JOIN b ON l_partkey BETWEEN lo AND hi")
def ip_to_asn(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.expr("p_partkey DIV 100")
    blocks = read(spark, sf_dir, "part").select((k * 100).alias("lo"), (k * 100 + 59).alias("hi"), (k % 7 + 1).alias("asn")).distinct()
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return r.interval_join(li, "l_partkey", blocks, "lo", "hi", "asn", 0, bits=8)


_NETS = "n AS (SELECT (c_custkey * 37) % 20000 AS lo, (c_custkey * 37) % 20000 + (c_custkey * 13) % 200 AS hi, c_custkey % 5 AS value FROM customer)"


def nets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    lo = (c * 37) % 20000
    return read(spark, sf_dir, "customer").select(lo.alias("lo"), (lo + (c * 13) % 200).alias("hi"), (c % 5).alias("value"))


@query("net_match", f"""WITH {_NETS}, k AS (SELECT DISTINCT l_partkey FROM lineitem)
SELECT l_partkey, arg_min(value, (hi - lo, -lo, value)) AS value FROM k LEFT JOIN n ON l_partkey BETWEEN lo AND hi GROUP BY l_partkey
""")
def net_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = read(spark, sf_dir, "lineitem").select("l_partkey").distinct()
    return r.most_specific(keys, "l_partkey", nets(spark, sf_dir), "lo", "hi", "value", bits=8)


_BYTES = "b AS (SELECT DISTINCT substr(md5(p_partkey::VARCHAR), 1, 2) AS b FROM part), r AS (SELECT rpad(b, 32, '0') AS lo, rpad(b || '7', 32, 'f') AS hi, 'block ' || b AS value FROM b)"
_WIDE = "w AS (SELECT '7f' || repeat('0', 30) AS lo, '80' || repeat('f', 30) AS hi, 'middle' AS value UNION ALL SELECT repeat('0', 32), repeat('f', 32), 'all')"


def byte_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of each block of addresses that the first byte of a part key's MD5 names."""
    b = F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 2)
    blocks = read(spark, sf_dir, "part").select(b.alias("b")).distinct()
    return blocks.select(F.unhex(F.rpad("b", 32, "0")).alias("lo"), F.unhex(F.rpad(F.concat("b", F.lit("7")), 32, "f")).alias("hi"), F.concat(F.lit("block "), "b").alias("value"))


@query("ip6_to_asn", f"WITH {_BYTES} SELECT o_orderkey, coalesce(value, 'none') AS value FROM orders LEFT JOIN r ON md5(o_orderkey::VARCHAR) BETWEEN lo AND hi")
def ip6_to_asn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of 16 bytes, made from orders' keys."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.unhex(F.md5(F.col("o_orderkey").cast("string"))).alias("address"))
    return r.interval_join_bytes(o, "address", byte_blocks(spark, sf_dir), "lo", "hi", "value", "none").select("o_orderkey", "value")


@query("net6_match", f"""WITH {_BYTES}, {_WIDE}, s AS (SELECT DISTINCT substr(md5(s_suppkey::VARCHAR), 1, 3) AS b FROM supplier),
n AS (SELECT lo, hi, value FROM r UNION ALL SELECT rpad(b, 32, '0'), rpad(b, 32, 'f'), 'net ' || b FROM s UNION ALL SELECT * FROM w)
SELECT o_orderkey, arg_max(value, (lo, translate(hi, '0123456789abcdef', 'fedcba9876543210'))) AS value FROM orders LEFT JOIN n ON md5(o_orderkey::VARCHAR) BETWEEN lo AND hi GROUP BY o_orderkey
""")
def net6_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.substring(F.md5(F.col("s_suppkey").cast("string")), 1, 3)
    s = read(spark, sf_dir, "supplier").select(b.alias("b")).distinct()
    nets = byte_blocks(spark, sf_dir).unionByName(s.select(F.unhex(F.rpad("b", 32, "0")).alias("lo"), F.unhex(F.rpad("b", 32, "f")).alias("hi"), F.concat(F.lit("net "), "b").alias("value")))
    wide = [("7F" + "0" * 30, "80" + "F" * 30, "middle"), ("0" * 32, "F" * 32, "all")]  # across a border of the highest bits, and everything
    nets = nets.unionByName(spark.range(1).select(F.explode(F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(w, ("lo", "hi", "value"), strict=True)]) for w in wide])).alias("w")).select(F.unhex("w.lo").alias("lo"), F.unhex("w.hi").alias("hi"), "w.value"))
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.unhex(F.md5(F.col("o_orderkey").cast("string"))).alias("address"))
    return r.most_specific_bytes(o, "address", nets, "lo", "hi", "value").select("o_orderkey", "value")


@query("flatten_ranges", f"""WITH {_NETS},
p AS (SELECT lo AS x FROM n UNION SELECT hi + 1 FROM n), s AS (SELECT x, lead(x) OVER (ORDER BY x) - 1 AS y FROM p),
c AS (SELECT x, y, arg_max(value, (lo, -hi, -value)) AS value FROM s JOIN n ON lo <= x AND y <= hi GROUP BY x, y),
i AS (SELECT *, sum(new) OVER (ORDER BY x) AS island FROM (SELECT *, CASE WHEN lag(y) OVER (ORDER BY x) + 1 = x AND lag(value) OVER (ORDER BY x) = value THEN 0 ELSE 1 END AS new FROM c))
SELECT min(x) AS lo, max(y) AS hi, any_value(value) AS value FROM i GROUP BY island
""")
def flatten_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.flatten_ranges(nets(spark, sf_dir), bits=10)


@query("asof_ranges", f"WITH {_BLOCKS}, d AS (SELECT * FROM b WHERE lo < (SELECT max(lo) FROM b) UNION ALL SELECT max(lo), 4611686018427387904, 99 FROM b) SELECT l_orderkey, l_linenumber, l_partkey, coalesce(asn, 0) AS asn FROM lineitem LEFT JOIN d ON l_partkey BETWEEN lo AND hi")
def asof_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items and blocks of part keys, the last of which reaches far beyond all keys."""
    k = F.expr("p_partkey DIV 100")
    blocks = read(spark, sf_dir, "part").select((k * 100).alias("lo"), (k * 100 + 59).alias("hi"), (k % 7 + 1).alias("asn")).distinct()
    last = F.broadcast(blocks.agg(F.max("lo").alias("last")))  # one row
    is_last = F.col("lo") == F.col("last")
    blocks = blocks.crossJoin(last).select("lo", F.when(is_last, 1 << 62).otherwise(F.col("hi")).alias("hi"), F.when(is_last, 99).otherwise(F.col("asn")).alias("asn"))
    return r.asof_join(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", blocks, "lo", "hi", "asn", 0)


@query("asof_ranges_bytes", f"WITH {_BYTES} SELECT o_orderkey, coalesce(value, 'none') AS value FROM orders LEFT JOIN r ON md5(o_orderkey::VARCHAR) BETWEEN lo AND hi")
def asof_ranges_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.unhex(F.md5(F.col("o_orderkey").cast("string"))).alias("address"))
    return r.asof_join(o, "address", byte_blocks(spark, sf_dir), "lo", "hi", "value", "none").select("o_orderkey", "value")

"""Readers of the text formats. Every one takes a path, a list of paths or a glob, and leaves splitting and pushdown to Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Paths = str | Sequence[str]

SUMMARY = "registry string, key_type int, key string, count long"
METRIC = "metric string, date string, version string, key string, value double"
SUM3 = "address cc city date hour duration queries nx_domain useful useless dga others local localhost rfc6761 home lan internal ip localdomain corp mail other_names jumbo".split()
COUNTS = "ip asn frq total dga nx_domain arpa com tld tld_min_delay nb_slices org local home lan users min_slices nb_addresses".split()
ADDRESS = "address string, tld string, nx_domain int, name_type string, min_delay long, count long, flags long"


def parse_int(text: Column) -> Column:
    """A number with thousand separators, blanks or quotes; null if it is none."""
    return F.regexp_replace(text, r'[,\s"]', "").try_cast("long")


def parse_double(text: Column) -> Column:
    return F.regexp_replace(text, r'[,\s"]', "").try_cast("double")


def lines(spark: SparkSession, path: Paths) -> DataFrame:
    """value and path of every line; gz and bz2 are read as they are."""
    return spark.read.option("recursiveFileLookup", "true").text(path if isinstance(path, str) else list(path)).select("value", F.col("_metadata.file_path").alias("path"))


def cells(spark: SparkSession, path: Paths, n: int) -> DataFrame:
    """c0 .. c(n-1) as trimmed text, and path; quotes are understood, missing cells are null."""
    schema = ", ".join(f"c{i} string" for i in range(n))
    own = spark.read.schema(schema).option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true").option("mode", "PERMISSIVE").option("escape", '"').csv(path if isinstance(path, str) else list(path))
    return own.select("*", F.col("_metadata.file_path").alias("path"))


def read_summary(spark: SparkSession, path: Paths) -> DataFrame:
    """Counters without the version lines: registry, key_type (0 number, 1 text), key, count, path."""
    c = cells(spark, path, 5)
    own = c.select(F.col("c0").alias("registry"), F.col("c1").try_cast("int").alias("key_type"), F.col("c2").alias("key"), F.col("c3").try_cast("long").alias("count"), "path")
    return own.where(~F.col("registry").rlike("_VERSION$") & F.col("count").isNotNull())


def versions(spark: SparkSession, path: Paths) -> DataFrame:
    c = cells(spark, path, 5)
    return c.where(F.col("c0").rlike("_VERSION$")).select(F.col("c3").try_cast("long").alias("version"), "path")


def read_metrics(spark: SparkSession, path: Paths, latest: bool = True) -> DataFrame:
    """Metric rows of files Mx-yyyy-mm-dd.csv; with latest, of each metric's month the file of its last day only. A date that can't be is null."""
    c = cells(spark, path, 6)
    own = c.select(F.col("c0").alias("metric"), F.try_to_date("c1", "yyyy-MM-dd").alias("date"), F.col("c2").alias("version"), F.coalesce("c3", F.lit("")).alias("key"), parse_double(F.col("c4")).alias("value"), "path").where("metric IS NOT NULL AND value IS NOT NULL")
    name = lambda i: F.regexp_extract("path", r"(M\d+)-(\d{4}-\d{2})-(\d{2})[^/]*$", i)
    own = own.withColumns({"family": name(1), "month": name(2), "day": name(3)})
    if not latest:
        return own
    last = own.groupBy("family", "month").agg(F.max("day").alias("day"))
    return own.join(last, ["family", "month", "day"])


def read_compliance(spark: SparkSession, path: Paths) -> DataFrame:
    """Registrar complaints. Title and header rows have no id; rows with a month column before the count are shifted."""
    c = cells(spark, path, 13)
    n = lambda i: parse_int(F.col(f"c{i}"))
    shifted = n(4).isNull() & n(5).isNotNull()
    names = ("domain_count", "complaints", "first_notices", "third_notices", "breaches", "suspensions", "terminations", "non_renewals")
    counts = [F.coalesce(F.when(shifted, n(i + 1)).otherwise(n(i)), F.lit(0)).alias(k) for i, k in enumerate(names, 4)]
    return c.select(F.col("c1").alias("registrar"), n(2).alias("iana_id"), F.col("c3").alias("complaint_type"), *counts, "path").where("iana_id > 0")


# fixed values: reserved registrar ids
RESERVED_REGISTRARS = (1, 3, 8, 119, 376, 2482, 9995, 9996, 9997, 9998, 9999, 10009, 4000001, 8888888)


def read_abuse(spark: SparkSession, path: Paths, layout: str, reserved: Sequence[int] = RESERVED_REGISTRARS) -> DataFrame:
    """Abuse counts in one of the layouts tlds, registrars or old_tlds: name, kind, iana_id, domains, abusive, score, phishing, malware, spam, botnet, path. Rows without a name or domains and reserved registrars are left out."""
    first = {"tlds": 2, "registrars": 2, "old_tlds": 1}[layout]
    c = cells(spark, path, 13)
    n = lambda i: parse_int(F.col(f"c{i}"))
    none = F.lit(None)
    kind = F.col("c1") if layout == "tlds" else none.cast("string")
    iana = n(1) if layout == "registrars" else none.cast("long")
    counts = [F.coalesce(n(first + i), F.lit(0)).alias(k) for i, k in ((0, "domains"), (1, "abusive"))] + [parse_double(F.col(f"c{first + 2}")).alias("score")] + [F.coalesce(n(first + i), F.lit(0)).alias(k) for i, k in enumerate(("phishing", "malware", "spam", "botnet"), 3)]
    own = c.select(F.regexp_replace("c0", r"^\.", "").alias("name"), kind.alias("kind"), iana.alias("iana_id"), *counts, "path").where("name <> '' AND domains <> 0")
    return own.where(~F.col("iana_id").isin(*reserved) & (F.col("iana_id") > 0)) if layout == "registrars" else own


def read_zone(spark: SparkSession, path: Paths) -> DataFrame:
    """(tld, algorithm): a row for each NS (algorithm null) and DS record of top-level names; other lines are left out."""
    pattern = r"^([A-Za-z0-9-]+)\.\s+\d+\s+IN\s+(NS|DS)\s+(?:\d+\s+(\d+)\s)?"
    own = lines(spark, path).where(F.col("value").rlike(pattern))
    part = lambda i: F.regexp_extract("value", pattern, i)
    return own.select(F.upper(part(1)).alias("tld"), F.when(part(2) == "DS", part(3).try_cast("int")).alias("algorithm"))


def read_m5(spark: SparkSession, path: Paths) -> DataFrame:
    """(key, value) of survey files: an array of objects with keys M5.x.y; nulls are skipped. Of a broken file what can be read is kept."""
    text = spark.read.text(path if isinstance(path, str) else list(path), wholetext=True)
    parsed = F.from_json("value", "array<map<string,string>>")
    cell = r'"(M5\.[0-9.]+)"\s*:\s*"?(-?[0-9.]+)'
    pieces = F.transform(F.filter(F.split("value", "[{}]"), lambda x: x.rlike(cell)), lambda v: F.transform(F.regexp_extract_all(v, F.lit(cell), F.lit(0)), lambda x: F.struct(F.regexp_extract(x, cell, 1).alias("key"), F.regexp_extract(x, cell, 2).alias("v"))))
    whole = F.flatten(F.transform(parsed, lambda m: F.transform(F.map_entries(m), lambda x: F.struct(x["key"].alias("key"), x["value"].alias("v")))))
    broken = parsed.isNull() | F.exists(parsed, lambda m: m.isNull())
    return text.select(F.inline(F.when(broken, F.flatten(pieces)).otherwise(whole))).where("key LIKE 'M5.%'").select("key", F.col("v").try_cast("double").alias("value")).where("value IS NOT NULL")


def read_address(spark: SparkSession, path: Paths) -> DataFrame:
    """Address lists with the slice's metadata from the file name."""
    from idhealth.functions.slices import parse_slice_name

    c = cells(spark, path, 7)
    own = c.select(F.col("c0").alias("address"), F.col("c1").alias("tld"), F.col("c2").try_cast("int").alias("nx_domain"), F.col("c3").alias("name_type"), F.col("c4").try_cast("long").alias("min_delay"), F.col("c5").try_cast("long").alias("count"), F.col("c6").try_cast("long").alias("flags"), parse_slice_name(F.col("path")).alias("slice"))
    return own.where("count IS NOT NULL")


def read_counts(spark: SparkSession, path: Paths) -> DataFrame:
    """Count-by-address files of 11 or 18 columns; columns that a file lacks are 0."""
    c = cells(spark, path, len(COUNTS))
    return c.where(parse_int(F.col("c3")).isNotNull()).select(F.col("c0").alias("ip"), *[F.coalesce(parse_int(F.col(f"c{i}")), F.lit(0)).alias(k) for i, k in enumerate(COUNTS) if i])


def read_sum3(spark: SparkSession, path: Paths) -> DataFrame:
    """Slice summaries of 23 or 24 columns (jumbo 0 if absent), without header lines."""
    c = cells(spark, path, len(SUM3)).where("c0 <> 'address'")
    text = [F.col(f"c{i}").alias(k) for i, k in enumerate(SUM3[:5])]
    return c.select(*text, *[F.coalesce(parse_int(F.col(f"c{i}")), F.lit(0)).alias(k) for i, k in enumerate(SUM3) if i >= 5])


def read_resolver_list(spark: SparkSession, path: Paths) -> DataFrame:
    """ip, asn, cc, validates, and the last count as users, of 12-column resolver lists."""
    c = cells(spark, path, 12)
    return c.select(F.col("c0").alias("ip"), parse_int(F.regexp_replace("c1", "^AS", "")).alias("asn"), F.col("c2").alias("cc"), (F.lower("c3") == "yes").alias("validates"), parse_int(F.col("c11")).alias("users")).where("users IS NOT NULL")


def read_ip2as(spark: SparkSession, path: Paths) -> DataFrame:
    """first, last, asn of range files, cells parted by commas or tabs."""
    p = F.split("value", r"\s*[,\t]\s*")
    g = lambda i: F.get(p, F.lit(i))
    return lines(spark, path).select(g(0).alias("first"), g(1).alias("last"), parse_int(g(2)).alias("asn")).where("asn IS NOT NULL")


def read_bgp(spark: SparkSession, path: Paths) -> DataFrame:
    """prefix and origin AS of best routes (marked >): the last AS of the path, or the one before a set in braces."""
    own = lines(spark, path).where(F.col("value").rlike(r"^\*?>?\*?>"))
    asn = F.regexp_extract("value", r"(\d+)(?:\s+\{[^}]*\})?\s*[ie?]?\s*$", 1)
    return own.select(F.regexp_extract("value", r"([0-9a-fA-F.:]+/\d+)", 1).alias("prefix"), asn.try_cast("long").alias("asn")).where("prefix <> '' AND asn IS NOT NULL")


def read_asnames(spark: SparkSession, path: Paths) -> DataFrame:
    """asn, name, cc of `AS<number> <name>, <cc>` lines, in HTML or plain."""
    plain = F.regexp_replace("value", "<[^>]*>", "")
    pattern = r"^\s*AS(\d+)\s+(.*?)(?:,\s*([A-Z]{2}))?\s*$"
    own = lines(spark, path).select(plain.alias("v")).where(F.col("v").rlike(pattern))
    return own.select(F.regexp_extract("v", pattern, 1).cast("long").alias("asn"), F.regexp_extract("v", pattern, 2).alias("name"), F.coalesce(F.nullif(F.regexp_extract("v", pattern, 3), F.lit("")), F.lit("ZZ")).alias("cc"))


def read_registry(spark: SparkSession, path: Paths, table_id: str, key_column: int = 0) -> DataFrame:
    """table_id, key of a parameter registry; ranges a-b give all their keys, other rows are left out."""
    c = F.col(f"c{key_column}")
    low, high = F.regexp_extract(c, r"^(\d+)(?:-(\d+))?$", 1).try_cast("long"), F.regexp_extract(c, r"^(\d+)(?:-(\d+))?$", 2).try_cast("long")
    return cells(spark, path, key_column + 2).where(low.isNotNull()).select(F.lit(table_id).alias("table_id"), F.explode(F.sequence(low, F.coalesce(high, low))).alias("key"))


def read_addresses(spark: SparkSession, path: Paths) -> DataFrame:
    """Addresses of a list, one a line, # starts a comment."""
    return lines(spark, path).select(F.trim(F.regexp_replace("value", "#.*", "")).alias("address")).where("address <> ''").distinct()


def read_rsv_log(spark: SparkSession, path: Paths) -> DataFrame:
    from idhealth.operators.rsvlog import parse

    return parse(lines(spark, path))


def tlsa_counters(df: DataFrame, usage: str, selector: str, matching: str, count: str) -> DataFrame:
    """Summary rows of a TLSA survey: three parameter registries and the total of record type 52."""
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("registry"), c.cast("string").alias("key")) for k, c in (("TLSA Certificate Usages", F.col(usage)), ("TLSA Selectors", F.col(selector)), ("TLSA Matching Types", F.col(matching)), ("RR Type", F.lit("52")))]))
    return df.select(count, rows.alias("x")).groupBy("x.registry", "x.key").agg(F.sum(count).alias("count"))


def upgrade_metric_rows(rows: DataFrame, date: str, version: str, column: str = "value") -> DataFrame:
    """Old lines `name, value` or `name, key, value` to five cells; newer lines stay."""
    p = F.transform(F.split(F.regexp_replace(column, r"\s*,\s*$", ""), r"\s*,\s*"), lambda x: F.trim(x))
    g = lambda i: F.get(p, F.lit(i))
    n = F.size(p)
    return rows.select(g(0).alias("metric"), F.when(n >= 5, g(1)).otherwise(F.lit(date)).alias("date"), F.when(n >= 5, g(2)).otherwise(F.lit(version)).alias("version"), F.when(n >= 5, g(3)).when(n >= 3, g(1)).otherwise(F.lit("")).alias("key"), F.try_element_at(p, F.lit(-1)).try_cast("double").alias("value")).where("value IS NOT NULL")


#: Vectors of a wide address record in file order, with their lengths; scalars have length 0.
RECORD = (
    ("ip", 0), ("queries", 0), ("hourly", 24), ("daily", 31), ("arpa", 0), ("no_such", 4), ("tlds", 8), ("n_tlds", 0), ("tld_registers", 16),
    ("slds", 8), ("n_slds", 0), ("sld_registers", 16), ("name_parts", 8), ("rr_types", 8), ("locales", 8), ("users", 0), ("servers", 0),
)


def read_records(spark: SparkSession, path: Paths, merge: bool = True) -> DataFrame:
    """Wide address records as arrays; users and servers are 0 where a file lacks them. With merge, rows of one address are added up (registers by maximum)."""
    from idhealth.operators.ipstats import merge_vectors

    n = sum(max(1, k) for _, k in RECORD)
    c = cells(spark, path, n)
    at, cols = 0, []
    for name, k in RECORD:
        value = lambda i: F.coalesce(F.regexp_replace(F.col(f"c{i}"), r"\.\d*$", "").try_cast("long"), F.lit(0))
        cols.append((F.col(f"c{at}") if name == "ip" else F.array(*[value(at + j) for j in range(k)]) if k else value(at)).alias(name))
        at += max(1, k)
    own = c.select(*cols).where("ip IS NOT NULL")
    if not merge:
        return own
    scalars = [name for name, k in RECORD if not k and name not in ("ip", "n_tlds", "n_slds")]
    packed = own.withColumn("scalars_", F.array(*[F.col(s) for s in scalars]))
    maxima = {"tld_registers": 16, "sld_registers": 16}
    m = merge_vectors(packed, ["ip"], {name: k for name, k in RECORD if k and name not in maxima} | {"scalars_": len(scalars)}, maxima)
    return m.select("ip", *[F.get("scalars_", F.lit(i)).alias(s) for i, s in enumerate(scalars)], *[name for name, k in RECORD if k])

"""Root and user branches of responses: which names leak, under which class, and how much traffic there is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idhealth.functions import names as n
from idhealth.functions.addresses import is_v4, replaced_v6

from .counters import top_with_rest

NOERROR, NXDOMAIN = 0, 3


def is_root(df: DataFrame, server: str, roots: DataFrame) -> DataFrame:
    """Adds is_root. roots has one column named like server; Spark broadcasts it if its size allows."""
    return df.join(roots.select(server).distinct().withColumn("is_root", F.lit(True)), server, "left").withColumn("is_root", F.coalesce("is_root", F.lit(False)))


def is_valid(opcode: Column, rcode: Column, error: Column) -> Column:
    """A query opcode without parse error, answered or not found."""
    return (opcode == 0) & ~F.coalesce(error, F.lit(False)) & rcode.isin(NOERROR, NXDOMAIN)


def fix_arpa(rcode: Column, tld: Column) -> Column:
    """NXDOMAIN under ARPA counts as found."""
    return F.when((rcode == NXDOMAIN) & (n.canonic(tld) == "ARPA"), NOERROR).otherwise(rcode)


def branch(rcode: Column, name: Column, qclass: Column, n_records: Column, frequent: Sequence[str] = ()) -> Column:
    """Label of a root response: a leak class for NXDOMAIN; root, chaos or tld for answers with records; null for the rest."""
    found = F.when(qclass == 3, "chaos").when(n.n_labels(name) == 0, "root").otherwise("tld")
    return F.when(rcode == NXDOMAIN, n.leak_type(name, frequent)).when((rcode == NOERROR) & (n_records > 0), found)


def tld_usage(df: DataFrame, name: str, registered: DataFrame, frequent: Sequence[str] = ()) -> DataFrame:
    """(registry, key, count) of user traffic: delegated (1) or not (0), and for those not the special-use name, the frequent name, or a class.

    registered has one column `tld` in upper case.
    """
    t = n.tld(F.col(name))
    own = df.select(F.col(name).alias("name"), n.canonic(t).alias("tld")).join(registered.select("tld").distinct().withColumn("known", F.lit(True)), "tld", "left")
    known = F.coalesce("known", F.lit(False)) | F.coalesce(F.col("tld") == "", F.lit(True))
    kind = n.leak_type(F.col("name"), frequent)
    label = F.when(kind == "binary", "-- BINARY --").when(kind == "bad_syntax", "-- SYNTAX --").when(kind == "ipv4", "-- IPV4 --").when(kind == "numeric", "-- NUMBER --").otherwise(F.col("tld"))
    registry = F.when(kind == "rfc6761", "RFC6761Usage").otherwise("Frequent-TLD-usage")
    cells = F.array_compact(F.array(F.struct(F.lit("TLD-Usage-Count").alias("registry"), known.cast("int").cast("string").alias("key")), F.when(~known, F.struct(registry.alias("registry"), label.alias("key")))))
    return own.select(F.explode(cells).alias("x")).groupBy("x.registry", "x.key").agg(F.count("*").alias("count"))


def sld_leaks(df: DataFrame, name: str, top: int = 128) -> DataFrame:
    """(key, count) of the labels before leaking top-level names: -- NONE -- for one-label names, -- NUMBER -- for numbers, -- OTHERS -- beyond the `top` greatest."""
    s = n.sld(F.col(name))
    label = F.when(s.isNull(), "-- NONE --").when(n.is_numeric(s), "-- NUMBER --").otherwise(n.canonic(s))
    counted = df.groupBy(F.lit("Leaked2ndLD").alias("registry"), label.alias("key")).agg(F.count("*").alias("count"))
    marks = F.col("key").startswith("-- ")
    ranked = top_with_rest(counted.where(~marks), ["registry"], "key", "count", top)
    return ranked.unionByName(counted.where(marks)).groupBy("registry", "key").agg(F.sum("count").alias("count"))


def zone_usage(df: DataFrame, name: str, signed: str, rules: DataFrame) -> DataFrame:
    """(signed, zones): registrable zones by whether any of their answers is signed. The answers are reduced to names first."""
    by_name = df.groupBy(name).agg(F.bool_or(signed).alias("signed"))
    zones = n.zone(by_name, name, rules).where("zone IS NOT NULL").groupBy("zone").agg(F.bool_or("signed").alias("signed"))
    return zones.groupBy("signed").agg(F.count("*").alias("zones"))


def volumes(df: DataFrame, port: str, size: str, us: str) -> DataFrame:
    """(port, packets, bytes, share, duration_us): traffic by port, and first to last packet of all."""
    by = df.groupBy(port).agg(F.count("*").alias("packets"), F.sum(size).alias("bytes"))
    span = df.agg((F.max(us) - F.min(us)).alias("duration_us"))
    everything = Window.partitionBy()
    return by.withColumn("share", F.col("bytes") / F.sum("bytes").over(everything)).crossJoin(F.broadcast(span))  # a row per port; one row


# fixed values: ports of DNS over UDP and TCP, TLS and HTTPS, and the keys that their volumes and connections have
DNS_PORT, TLS_PORT, HTTPS_PORT = 53, 853, 443
TLS_SYN_KEY = 583
SYN, TCP, UDP = 2, 6, 17


def protocol_volumes(packets: DataFrame) -> DataFrame:
    """(registry, key, count) of traffic rows: bytes by protocol (0: DNS over UDP, 53, 853, 443: over TCP), clients that opened TLS or HTTPS connections, clients in all of these.

    packets: protocol, source, source_port, target_port, size, tcp_flags. One scan; a client counts once for each kind of connection.
    """
    c = F.col
    on = lambda port: (c("source_port") == port) | (c("target_port") == port)
    port = F.when((c("protocol") == UDP) & on(DNS_PORT), 0).when(c("protocol") == TCP, F.when(on(DNS_PORT), DNS_PORT).when(on(TLS_PORT), TLS_PORT).when(on(HTTPS_PORT), HTTPS_PORT))
    opens = F.when((c("protocol") == TCP) & (c("tcp_flags") == SYN), F.when(port == TLS_PORT, TLS_SYN_KEY).when(port == HTTPS_PORT, HTTPS_PORT))
    row = lambda registry, key, who, count: F.struct(F.lit(registry).alias("registry"), key.alias("key"), who.cast("string").alias("who"), count.cast("long").alias("count"))
    cells = F.array_compact(F.array(
        F.when(port.isNotNull(), row("VOLUME_PER_PROTO", port, F.lit(None), c("size"))), F.when(opens.isNotNull(), row("TCPSYN_PER_PROTO", opens, c("source"), F.lit(1))), F.when(opens.isNotNull(), row("TCPSYN_PER_PROTO", F.lit(0), c("source"), F.lit(1))),
    ))
    summed = packets.select(F.explode(cells).alias("x")).groupBy("x.registry", "x.key", "x.who").agg(F.sum("x.count").alias("count"))
    count = F.sum(F.when(c("who").isNull(), c("count")).otherwise(1))
    return summed.groupBy("registry", c("key").cast("string").alias("key")).agg(count.alias("count"))


def name_report(df: DataFrame, name: str, us: str, kind: str) -> DataFrame:
    """(name, count, first kind, parts): every name with the class of its first message."""
    return df.groupBy(F.col(name).alias("name")).agg(F.count("*").alias("count"), F.min_by(kind, F.struct(us, kind)).alias("kind")).withColumn("parts", n.n_labels(F.col("name")))


def presence(df: DataFrame, partner: str, month: str, now: str, before: str) -> DataFrame:
    """(partner, mask): bit 0 if the partner sent something this month, bit 1 if in the month before."""
    bit = F.when(F.col(month) == now, 1).when(F.col(month) == before, 2).otherwise(0)
    return df.groupBy(partner).agg(F.bit_or(bit).alias("mask"))


def backfill_probe_share(metrics: DataFrame, since: str) -> DataFrame:
    """(date, value): per file the sum of length_7 to length_15, less the mean of that sum over files from `since` on; 0 at least."""
    length = F.regexp_extract("key", r"^length_(\d+)$", 1).try_cast("int")
    by = metrics.groupBy("date").agg(F.coalesce(F.sum(F.when(length.between(7, 15), F.col("value"))), F.lit(0.0)).alias("sum"))
    base = by.agg(F.coalesce(F.avg(F.when(F.col("date") >= since, F.col("sum"))), F.lit(0.0)).alias("base"))
    return by.crossJoin(F.broadcast(base)).select("date", F.greatest(F.lit(0.0), F.col("sum") - F.col("base")).alias("value"))  # one row


def filled_series(df: DataFrame, key: str, month: str, num: str, den: str) -> DataFrame:
    """(key, month, percent, mean): 100 * num / den of every key in every month (0 if absent), and the month's mean over keys."""
    grid = df.select(key).distinct().crossJoin(df.select(month).distinct())  # keys by months: the result's own size
    summed = df.groupBy(key, month).agg(F.sum(num).alias("a"), F.sum(den).alias("b"))
    percent = F.coalesce(F.try_divide(100.0 * F.col("a"), F.col("b")), F.lit(0.0))
    full = grid.join(summed, [key, month], "left").select(key, month, percent.alias("percent"))
    return full.join(full.groupBy(month).agg(F.avg("percent").alias("mean")), month)


def extract_names(df: DataFrame, name: str, kind: str | Sequence[str], least_labels: int = 1, frequent: Sequence[str] = ()) -> DataFrame:
    """Rows whose name is of one leak type (see names.leak_type), or of one of several, and has least_labels labels or more."""
    kinds = (kind,) if isinstance(kind, str) else kind
    return df.where(n.leak_type(F.col(name), tuple(frequent)).isin(*kinds) & (n.n_labels(F.col(name)) >= least_labels))


def normalize_suffixes(lines: DataFrame, column: str = "value") -> DataFrame:
    """(suffix, kind) of a public-suffix list: comments and blanks are dropped, ! is an exception, *. a wildcard; names in ASCII upper case, each once."""
    from pyspark.sql import types as T

    @F.pandas_udf(T.StringType())
    def ascii_form(s):
        def one(x):
            try:
                return x.encode("idna").decode()
            except UnicodeError:
                return None

        return s.map(one)

    v = F.split_part(F.trim(column), F.lit(" "), F.lit(1))
    own = lines.select(v.alias("v")).where("v <> '' AND NOT startswith(v, '//')")
    kind = F.when(F.col("v").startswith("!"), "exception").when(F.col("v").startswith("*."), "wildcard").otherwise("std")
    plain = F.regexp_replace("v", r"^(!|\*\.)", "")
    return own.select(F.upper(ascii_form(plain)).alias("suffix"), kind.alias("kind")).where("suffix IS NOT NULL").distinct()


def anonymize_ip(text: Column, key: str, kept: Sequence[str] = ()) -> Column:
    """Keyed replacement of addresses; a text that is none gives null.

    IPv4: listed ones and special ones (0, 127, from 224 on) stay, private ones keep two octets, others one. IPv6, in
    canonical form: the first group stays, as do groups of 0, 1 and ffff; an IPv4 tail is replaced as such.
    """
    v6 = replaced_v6(key, kept)(text)
    return F.when(is_v4(text), anonymize_v4(text, key, kept)).otherwise(v6)


def anonymize_v4(text: Column, key: str, kept: Sequence[str]) -> Column:
    p = F.split(text, r"\.")
    o = lambda i: F.get(p, F.lit(i))
    first, second = o(0).try_cast("int"), o(1).try_cast("int")
    digest = F.sha2(F.concat(F.lit(key), F.replace(text, F.lit("."), F.lit("")), F.lit(key)), 256)
    made = lambda i: F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10)
    two = ((first == 172) & second.between(16, 31)) | ((first == 192) & (second == 168)) | ((first == 169) & (second == 254))
    whole = text.isin(*kept) if kept else F.lit(False)
    whole = whole | first.isin(0, 127) | (first >= 224)
    return F.when(whole, text).otherwise(F.concat_ws(".", o(0), F.when(two, o(1)).otherwise(made(1)), made(2), made(3)))

"""Resolver query logs: parsing without Python, filtering, resolver tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idhealth.functions.addresses import ip_bin

from .ranges import most_specific_bytes

LINE = r"^(\d+)(?:\.(\d+))? client (?:@\S+ )?([0-9A-Fa-f.:]+)#(\d+)(?: \([^)]*\))?: query: (\S+) IN (\S+)(?: (.*))?$"


def parse(lines: DataFrame, column: str = "value", codes: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """One row per line that is a query: us, resolver, port, name, type, flags, and the fields in the name's first label (see name_fields). Others are left out. Before them stand the columns in keep."""
    # the line is matched once: its parts, put between marks that no line holds, are split again; explode keeps Spark from copying the match, and what makes the line, into every field
    marked = F.regexp_replace(column, LINE, "\u0001" + "\u0001".join(f"${i}" for i in range(1, 8)))
    ok = lines.select(*keep, F.explode(F.array(F.split(marked, "\u0001"))).alias("p")).where("size(p) = 8 AND p[0] = ''")
    part = lambda i: F.get(F.col("p"), F.lit(i))
    us = part(1).cast("long") * 1_000_000 + F.rpad(F.substring(part(2), 1, 6), 6, "0").cast("long")
    own = ok.select(*keep, us.alias("us"), part(3).alias("resolver"), part(4).cast("int").alias("port"), part(5).alias("name"), part(6).alias("type"), F.coalesce(part(7), F.lit("")).alias("flags"))
    return own.select("*", name_fields(F.col("name"), codes).alias("f")).select(*keep, "us", "resolver", "port", "name", "type", "flags", "f.*")


def name_fields(name: Column, codes: Sequence[str] = ()) -> Column:
    """Fields of a measurement name `<prefix>[-results]-<user>-c<country>-a<hex AS>-s<epoch>-i<hex IPv4>-0.<experiment>…`.

    shape: params, anomalous (000-000-000…: five parts of the prefix, user, country, AS, time, address), sentinel
    (root-key-sentinel…), star (fewer parts under starnxdomain.net) or short (fewer parts elsewhere; its first label is
    `invalid`). server: the last three labels. Country numbers count from 1 in codes; others stay as they are. Null where
    a field is absent or broken.
    """
    labels = F.filter(F.split(F.trim(name), r"\."), lambda x: x != "")
    label = F.coalesce(F.get(labels, F.lit(0)), F.lit(""))
    server = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3), ".")
    parts = F.split(label, "-")
    odd, sentinel = label.startswith("000-000-000"), label.startswith("root-key-sentinel")
    few = F.size(parts) < 6
    star = F.concat(F.lit("."), server).endswith(".starnxdomain.net")
    shape = F.when(odd, "anomalous").when(sentinel, "sentinel").when(few & star, "star").when(few, "short").otherwise("params")
    results = F.get(parts, F.lit(1)) == "results"
    own = F.when(results, F.array_remove(parts, "results")).otherwise(parts)
    no_as = ~F.coalesce(F.get(own, F.lit(3)).startswith("a"), F.lit(False))  # without an AS the later parts move up
    at = lambda i: F.when(shape == "params", F.get(own, F.when(no_as & F.lit(i > 3), i - 1).otherwise(i)))
    whole = lambda i: F.when(odd, F.get(parts, F.lit(i)))
    hexed = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    number = hexed(F.coalesce(at(2), F.concat(F.lit("c"), whole(6))), r"^c(\d+)$").try_cast("int")
    known = F.get(F.array(*[F.lit(x) for x in codes]), number - 1) if codes else F.lit(None).cast("string")
    hex_as = F.coalesce(hexed(at(3), r"^a([0-9A-Fa-f]{1,8})$"), hexed(whole(7), r"^a([0-9A-Fa-f]{1,8})$"))
    hex_ip = F.lpad(F.coalesce(hexed(at(5), r"^i([0-9A-Fa-f]{1,8})$"), hexed(whole(9), r"^([0-9A-Fa-f]{1,8})$")), 8, "0")
    octet = lambda i: F.conv(F.substring(hex_ip, i, 2), 16, 10)
    prefix = F.when(shape == "params", F.get(parts, F.lit(0))).when(odd, F.array_join(F.slice(parts, 1, 5), "-")).when(sentinel, F.lit("root-key-sentinel"))
    return F.struct(
        shape.alias("shape"),
        prefix.alias("prefix"),
        F.get(labels, F.lit(1)).alias("experiment"),
        F.coalesce(results & (shape == "params"), F.lit(False)).alias("is_results"),
        F.coalesce(at(1), whole(5)).alias("user"),
        F.coalesce(known, at(2), F.concat(F.lit("c"), whole(6))).alias("cc"),
        F.when(hex_as.isNotNull(), F.conv(hex_as, 16, 10).cast("long")).when(shape == "params", F.lit(0).cast("long")).alias("asn"),
        F.coalesce(hexed(at(4), r"^s(\d+)$"), hexed(whole(8), r"^(\d+)$")).try_cast("long").alias("ad_time"),
        F.when(hex_ip.isNotNull(), F.concat_ws(".", octet(1), octet(3), octet(5), octet(7))).alias("client"),
        server.alias("server"),
        F.when(shape == "short", label).alias("invalid"),
    )


def filter_events(events: DataFrame, delay_s: float, experiments: Sequence[str], types: Sequence[str], results: bool = True, asns: DataFrame | None = None) -> DataFrame:
    """Events of these experiments and types not later than delay_s after the advertisement; without results if so told, of asns (asn) only if given."""
    out = events.where(F.col("experiment").isin(*experiments) & F.col("type").isin(*types) & (F.col("us") - F.col("ad_time") * 1_000_000 <= int(delay_s * 1_000_000)))
    out = out if results else out.where("NOT is_results")
    return out if asns is None else out.join(asns.select("asn").distinct(), "asn", "left_semi")


def tagged(events: DataFrame, by_as: DataFrame, networks: DataFrame, asn: str = "resolver_asn", address: str = "resolver") -> DataFrame:
    """Adds `tag`: the open resolver of the AS (by_as: asn, tag), else of the most specific network around the address (networks: first, last as 16 bytes, tag), else null."""
    found = events.join(by_as.select(F.col("asn").alias(asn), F.col("tag").alias("as_tag_")), asn, "left").withColumn("key_", ip_bin(F.col(address)))
    found = most_specific_bytes(found, "key_", networks.select("first", "last", F.col("tag").alias("net_tag_")), "first", "last", "net_tag_")
    return found.withColumn("tag", F.coalesce("as_tag_", "net_tag_")).drop("key_", "as_tag_", "net_tag_")


def resolver_tag(by_as: Column, by_net: Column, same_as: Column, same_cc: Column) -> Column:
    """The open resolver by AS, else by network, else Same_AS, Same_CC, Others."""
    return F.coalesce(by_as, by_net, F.when(same_as, F.lit("Same_AS")), F.when(same_cc, F.lit("Same_CC")), F.lit("Others"))

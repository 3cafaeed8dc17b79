"""All registries of a summary from one scan of nested DNS messages.

A message gives cells: (registry, key) for plain counters, and (state, key, who) where something counts once for each
client, client and name, or zone. Cells are exploded and summed in the tasks, so one shuffle carries counters and states;
a second, far smaller one turns the states into counters. Only then are the long lists cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idhealth.functions import dns
from idhealth.functions import names as n
from idhealth.sources.shared import stored

from .counters import top_marked
from .leaks import NOERROR, NXDOMAIN, fix_arpa

# fixed values: record types and the class CHAOS
TXT, OPT, DS, RRSIG, NSEC, DNSKEY, NSEC3, TLSA = 16, 41, 43, 46, 47, 48, 50, 52
CHAOS = 3
# fixed values: numbers of the header flags RD and TC, lowest bit 0
RD, TC = 4, 5
#: Bits of a client's state.
DO, EDNS, NOT_MINIMIZED, RECURSIVE = 1, 2, 4, 8
#: Keys that the lists of leaking names keep; what of them seldom occurs and looks like a browser's probe is counted by length.
LISTED, SELDOM = 128, 3

CELL = "array<struct<registry:string,key:string,who:string,bits:int,mark:bigint>>"


def cell(registry: str, key: Column, when: Column | None = None, who: Column | None = None, bits: Column | None = None, mark: Column | None = None) -> Column:
    """One cell, null where `when` does not hold or the key is null."""
    s = F.struct(
        F.lit(registry).alias("registry"), key.cast("string").alias("key"), (who.cast("string") if who is not None else F.lit(None).cast("string")).alias("who"),
        (bits.cast("int") if bits is not None else F.lit(0)).alias("bits"), (mark.cast("long") if mark is not None else F.lit(None).cast("long")).alias("mark"),
    )
    ok = key.isNotNull() if when is None else when & key.isNotNull()
    return F.when(ok, s)


def none() -> Column:
    return F.array().cast(CELL)


def many(registry: str, keys: Column) -> Column:
    """A cell for each element of an array."""
    return F.coalesce(F.transform(keys, lambda k: cell(registry, k)), none())


def record_cells(rr: Column, is_response: Column, is_signed: Column, count_queries: bool) -> Column:
    """Cells of one resource record: class and type, EDNS, DNSSEC algorithms and primes, TLSA fields. Records without data count as OPT only."""
    kind, data, size = rr["type"], rr["rdata"], F.coalesce(F.octet_length(rr["rdata"]), F.lit(0))
    full = size > 0
    out = [cell("CLASS", rr["class"], full & (kind != OPT) & is_response), cell("RR Type", kind, (full | (kind == OPT)) & is_response)]
    if count_queries:
        out += [cell("Q-CLASS", rr["class"], full & (kind != OPT) & ~is_response), cell("Q-RR Type", kind, (full | (kind == OPT)) & ~is_response)]
    # what only some types have is not looked at in others
    p = dns.dnssec_params(kind, data)
    pair = lambda at: F.conv(F.substring(F.hex(data), 2 * at + 1, 4), 16, 10).try_cast("int")
    signs = ((kind == DNSKEY) & (size > 8)) | ((kind == RRSIG) & (size > 18)) | ((kind == DS) & (size > 4))
    prime = (kind == DNSKEY) & (p["algorithm"] == 2) & (pair(4) < 16)
    dnssec = F.array(cell("DNSSEC Algorithm Numbers", p["algorithm"]), cell("DNSSEC KEY Prime Lengths", pair(4), prime), cell("DNSSEC Well Known Primes", pair(6), prime & pair(4).isin(1, 2)))
    dane = F.array(cell("DANE_CertUsage", p["usage"]), cell("DANE_TlsaSelector", p["selector"]), cell("DANE_TlsaMatchingType", p["matching"]))
    flags = rr["ttl"].bitwiseAND(F.lit(0xFFFF)).bitwiseOR(F.when(is_signed, F.lit(0x8000)).otherwise(F.lit(0)).cast("long"))
    edns = F.concat(F.array(cell("EDNS Version number", F.shiftright(rr["ttl"], 16).bitwiseAND(F.lit(255)))), many("EDNS Header_Flags", set_flags(flags, 16)), F.when(full, many("EDNS OPT CODE", dns.option_codes(data))).otherwise(none()))
    return F.concat(F.array(*out), F.when(signs, dnssec).when((kind == TLSA) & (size >= 3), dane).when(kind == OPT, edns).otherwise(none()))


def set_flags(bits: Column, width: int) -> Column:
    """Numbers of the flags set, 0 the highest; nearly always none or the first."""
    return F.when(bits == 0, F.array().cast("array<int>")).when(bits == 1 << (width - 1), F.array(F.lit(0))).otherwise(dns.flag_numbers(bits, width))


def opened(messages: DataFrame) -> DataFrame:
    """Adds what several cells need, so that it is computed once a message: name parts and class, records, EDNS."""
    c = F.col
    own = messages.withColumns({
        "x_rrs": F.coalesce(F.filter("rrs", lambda r: r["type"].isNotNull()), F.filter("rrs", lambda _: F.lit(False))), "x_tld": n.canonic(F.coalesce(n.tld(c("qname")), F.lit(""))),
        "x_parts": n.n_labels(c("qname")), "x_kind": n.leak_type(c("qname")), "x_second": n.sld(c("qname")), "x_good": (c("opcode") == 0) & (c("rcode") == NOERROR) & ~F.coalesce(c("error"), F.lit(False)),
    })
    own = own.withColumns({
        "x_signed": F.get(F.filter("x_rrs", lambda r: r["type"].isin(DNSKEY, RRSIG, NSEC, NSEC3, DS) & (F.octet_length(r["rdata"]) > 0)), F.lit(0))["name"], "x_opt": F.get(F.filter("x_rrs", lambda r: r["type"] == OPT), F.lit(0)),
        "x_owner": F.get(F.filter("x_rrs", lambda r: r["section"].isin("answer", "authority")), F.lit(0))["name"],
    })
    uses_do = c("x_opt").isNotNull() & (c("x_signed").isNotNull() | (c("x_opt.ttl").bitwiseAND(F.lit(0x8000)) != 0))
    return own.withColumns({"x_do": uses_do, "x_codes": F.when(~c("is_response"), dns.option_codes(c("x_opt.rdata")))})


def message_cells(nx_usage: bool = False, count_queries: bool = False, sizes: bool = False, underscores: bool = False) -> Column:
    """All cells of an opened message (nulls among them) with the columns of a capture, n_questions, is_root and is_registered (of its top-level name)."""
    c = F.col
    is_response, rrs, opt, tld, parts, kind, good, uses_do = c("is_response"), c("x_rrs"), c("x_opt"), c("x_tld"), c("x_parts"), c("x_kind"), c("x_good"), c("x_do")
    is_signed, uses_edns = c("x_signed").isNotNull(), opt.isNotNull()
    extended = F.coalesce(F.shiftright(opt["ttl"], 24).bitwiseAND(F.lit(255)), F.lit(0))
    room = F.coalesce(opt["class"], F.lit(512))
    clean = ~F.coalesce(c("error"), F.lit(False))
    asked = c("qname").isNotNull()
    plain = c("opcode") == 0
    # root servers' answers
    at_root = is_response & plain & c("is_root")
    rcode = fix_arpa(c("rcode"), tld)
    nx, found = at_root & asked & (rcode == NXDOMAIN), at_root & asked & (rcode == NOERROR) & (c("n_answer") + c("n_authority") > 0)
    listed = nx & ~kind.isin("binary", "bad_syntax", "ipv4", "numeric", "rfc6761")
    second = c("x_second")
    second = F.when(parts <= 1, "-- NONE --").when(n.is_numeric(second), "-- NUMBER --").otherwise(n.canonic(second))
    used = (found | nx) if nx_usage else found
    # other servers' answers
    user = is_response & plain & ~c("is_root") & asked
    known = c("is_registered") | (tld == "")
    label = F.when(kind == "binary", "-- BINARY --").when(kind == "bad_syntax", "-- SYNTAX --").when(kind == "ipv4", "-- IPV4 --").when(kind == "numeric", "-- NUMBER --").otherwise(tld)
    # clients
    minimized = n.is_qname_minimized(c("qname"), c("qtype"), c("qclass"), c("n_questions"), F.when(c("n_answer") + c("n_authority") > 0, c("x_owner")))
    recursive = F.shiftright(c("flags"), RD).bitwiseAND(F.lit(1)) == 1
    on = lambda x, bit: F.when(x, F.lit(bit)).otherwise(F.lit(0))
    state = on(uses_do, DO) + on(uses_edns, EDNS) + on(~F.coalesce(minimized, F.lit(False)), NOT_MINIMIZED) + on(recursive, RECURSIVE)
    asks = ~is_response & good & c("is_registered") & ~kind.isin("binary", "bad_syntax")
    rcodes = F.lit(0) + c("rcode").bitwiseOR(F.shiftleft(extended, 4).cast("int"))
    out = [
        cell("OpCode", c("opcode")), cell("RCODE", rcodes), cell("Z-Error Flags", on(~clean, 1)),
        cell("root-QR", c("rcode"), at_root), cell("LeakedTLD_BINARY", F.lit(0), nx & (kind == "binary")), cell("LeakedTLD_SYNTAX", F.lit(0), nx & (kind == "bad_syntax")),
        cell("LeakedTLD_IPV4", F.lit(0), nx & (kind == "ipv4")), cell("LeakedTLD_NUMERIC", F.lit(0), nx & (kind == "numeric")), cell("RFC6761-TLD", tld, nx & (kind == "rfc6761")),
        cell("LeakedTLD", tld, listed, bits=on(parts != 1, 1)), cell("Leaked2ndLD", second, listed), cell("NAME_PARTS_COUNT", parts, found | nx),
        cell("_usage", tld, used, who=c("client"), mark=c("us") * 2 + on(nx, 1)),
        cell("TLD-Usage-Count", on(known, 1), user), cell("RFC6761Usage", tld, user & ~known & (kind == "rfc6761")), cell("Frequent-TLD-usage", label, user & ~known & (kind != "rfc6761")),
        cell("_client", F.lit(""), is_response & good, who=c("client"), bits=state), cell("_asks", F.lit(""), asks, who=c("client")),
        cell("_name", F.nullif(F.coalesce("x_signed", "qname"), F.lit("")), is_response & good & uses_do, bits=on(is_signed, 1)),
    ]
    if sizes:
        out += [cell("Response Size", c("size"), is_response), cell("TC Length", room, is_response & (F.shiftright(c("flags"), TC).bitwiseAND(F.lit(1)) == 1)), cell("Query Size", c("size"), ~is_response), cell("EDNS Packet Size", room, ~is_response)]
    if count_queries:
        out += [cell("Q-CLASS", c("qclass")), cell("Q-RR Type", c("qtype"))]
    if underscores:
        out.append(cell("Underlined part", F.lit("TXT"), c("qtype") == TXT))
    out += [cell("Header Flags", F.lit(i), F.shiftright(c("flags"), i).bitwiseAND(F.lit(1)) == 1) for i in range(7)]
    options = F.transform(F.array_distinct(F.when(asks & uses_edns, c("x_codes"))), lambda o: cell("_option", o, who=c("client")))
    lists = [F.flatten(F.transform(rrs, lambda r: record_cells(r, is_response, is_signed, count_queries))), F.coalesce(options, none())]
    if underscores:
        lists.append(F.when(c("qtype") == TXT, many("Underlined part", n.underscore_labels(c("qname")))).otherwise(none()))
    return F.concat(F.array(*out), *lists)


def message_registries(messages: DataFrame, roots: DataFrame, registered: DataFrame, zones: DataFrame | None = None, listed: int = LISTED, **options: bool) -> DataFrame:
    """The summary (registry, key, count) of messages with the columns of a capture. The messages are read once.

    roots (server) and registered (tld, upper case) are joined before the messages are opened; zones are public-suffix
    rules (suffix, kind) for DNSSEC_Zone_Usage, which is left out without them. Options: nx_usage (repeats of names not
    found too), count_queries, sizes, underscores. Counts are exact: no table is full, no name is dropped.
    """
    own = messages if "n_questions" in messages.columns else messages.withColumn("n_questions", F.when(F.col("qname").isNotNull(), 1).otherwise(0))
    own = own.withColumn("tld_", n.canonic(n.tld(F.col("qname"))))
    own = own.join(roots.select("server").distinct().withColumn("is_root", F.lit(True)), "server", "left").withColumn("is_root", F.coalesce("is_root", F.lit(False)))
    own = own.join(registered.select(F.col("tld").alias("tld_")).distinct().withColumn("is_registered", F.lit(True)), "tld_", "left").withColumn("is_registered", F.coalesce("is_registered", F.lit(False)))
    # a column first: Spark compiles a projection and shares its parts, but interprets a generator with lambdas; outer, as for others it makes the cells a second time in a filter for empty arrays
    spread = opened(own).select(message_cells(**options).alias("cells")).select(F.explode_outer("cells").alias("c")).where("c IS NOT NULL")
    summed = spread.groupBy("c.registry", "c.key", "c.who").agg(F.count("*").alias("n"), F.bit_or("c.bits").alias("bits"), F.min("c.mark").alias("mark"))
    summed = stored(summed, "registry-states") if zones is not None else summed
    counted = _state_counts(summed)
    if zones is not None:
        by_zone = n.zone(summed.where("registry = '_name'").groupBy("key").agg(F.bit_or("bits").alias("bits")), "key", zones).where("zone IS NOT NULL").groupBy("zone").agg(F.bit_or("bits").alias("bits"))
        by_zone = by_zone.groupBy(F.lit("DNSSEC_Zone_Usage").alias("registry"), F.col("bits").cast("string").alias("key")).agg(F.count("*").alias("count"), F.lit(0).alias("bits"))
        counted = counted.unionByName(by_zone)
    return stored(_cut_lists(stored(counted, "registry-counts"), listed), "registries")


def _state_counts(summed: DataFrame) -> DataFrame:
    """States of clients, names and pairs become counters: (registry, key, count, bits)."""
    c = F.col
    row = lambda registry, key, count: F.struct(F.lit(registry).alias("registry"), key.cast("string").alias("key"), count.cast("long").alias("count"), F.lit(0).alias("bits"))
    has = lambda bit: c("bits").bitwiseAND(F.lit(bit)) != 0
    one, is_nx = F.lit(1), c("mark").bitwiseAND(F.lit(1)) == 1
    client = F.array(
        row("DNSSEC_Client_Usage", has(DO).cast("int"), one), row("EDNS_CLIENT_USAGE", has(EDNS).cast("int"), one), row("SENDING_RECURSIVE_SET", has(RECURSIVE).cast("int"), one),
        row("QNAME_MINIMIZATION_USAGE", (~has(NOT_MINIMIZED) & ~has(RECURSIVE)).cast("int"), one),
    )
    usage = F.array(row("UsefulQueries", F.when(is_nx, 2).otherwise(1), one), row("UsefulQueries", F.when(is_nx, 3).otherwise(0), c("n") - 1))
    # what a leak is by, and how many answers root servers gave in all, is counted beside
    plain = F.struct("registry", "key", c("n").alias("count"), "bits")
    reference = F.when((c("registry") == "root-QR") & c("key").isin("0", "3"), row("CHROMIUM_LEAK_REF", F.lit(0), c("n")))
    rows = (
        F.when(c("registry") == "_usage", usage).when(c("registry") == "_client", client).when(c("registry") == "_asks", F.array(row("EDNS_OPTIONS_TOTAL_QUERIES", F.lit(0), one)))
        .when(c("registry") == "_option", F.array(row("EDNS_OPTIONS_USAGE", c("key"), one))).when(c("registry") == "_name", F.array().cast("array<struct<registry:string,key:string,count:bigint,bits:int>>"))
        .otherwise(F.array_compact(F.array(plain, reference)))
    )
    return summed.select(F.explode(rows).alias("r")).groupBy("r.registry", "r.key").agg(F.sum("r.count").alias("count"), F.bit_or("r.bits").alias("bits"))


def _cut_lists(counted: DataFrame, listed: int) -> DataFrame:
    """Leaking names: the `listed` most frequent stay, probes and others are counted by length; second labels: the rest is -- OTHERS --."""
    leak = F.col("registry") == "LeakedTLD"
    probe = leak & (F.col("bits") == 0) & n.is_chromium(F.col("key"))
    marked = counted.withColumn("probe_", probe)
    cut = F.col("registry").isin("LeakedTLD", "Leaked2ndLD") & ~(F.col("probe_") & (F.col("count") < SELDOM))
    ranked = top_marked(marked.where(cut), ["registry"], "key", "count", listed)
    whole = marked.where(~cut).withColumn("top_", ~leak)
    all_ = ranked.unionByName(whole)
    length = F.char_length("key").cast("string")
    registry = F.when(F.col("top_") | ~leak, F.col("registry")).when(F.col("probe_"), "CHROMIUM_PROBES").otherwise("LeakByLength")
    key = F.when(F.col("top_"), F.col("key")).when(leak, length).otherwise("-- OTHERS --")
    return all_.groupBy(registry.alias("registry"), key.alias("key")).agg(F.sum("count").alias("count"))

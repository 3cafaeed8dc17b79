"""The registries of a message table, and the metrics of a summary against known values."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Row

from idhealth.operators import registries
from idhealth.operators.registries import message_registries
from idhealth.plans import metrics

MESSAGE = (
    "client string, server string, us long, is_response boolean, opcode int, rcode int, flags int, qname string, qtype int, qclass int, n_questions int, n_answer int, n_authority int, "
    "rrs array<struct<section:string,name:string,type:int,class:int,ttl:long,rdata:binary>>, error boolean, size int"
)


def message(client="c", server="root", response=True, rcode=0, qname="a.com", qtype=1, qclass=1, rrs=(), flags=0, opcode=0, error=False, us=0, questions=1, size=50):
    sections = [r[0] for r in rrs]
    return (client, server, us, response, opcode, rcode, flags, qname, qtype, qclass, questions, sections.count("answer"), sections.count("authority"), list(rrs), error, size)


def summary(spark, rows, zones=None, **options):
    roots, registered = spark.createDataFrame([("root",)], "server string"), spark.createDataFrame([("COM",)], "tld string")
    out = message_registries(spark.createDataFrame(rows, MESSAGE), roots, registered, zones, **options).collect()
    return {(r["registry"], r["key"]): r["count"] for r in out}


def test_records(spark):
    rr = lambda section, kind, data, ttl=0, klass=1: (section, "z.com", kind, klass, ttl, bytearray(bytes.fromhex(data)))
    rrs = [
        rr("answer", 48, "0100" + "03" + "02" + "0001" + "0002" + "FF"), rr("answer", 48, "01000302000100"),  # DNSKEY with a well-known prime; one too short
        rr("answer", 46, "0001" + "08" + "00" * 17), rr("answer", 43, "1234" + "0D" + "02" + "AA"), rr("answer", 52, "030101AA"), rr("answer", 1, ""),  # a record without data counts nowhere
        rr("additional", 41, "00080002AABB" + "000A0000" + "00", ttl=(1 << 24) | (2 << 16) | 1, klass=1232),
    ]
    s = summary(spark, [message(rrs=rrs, rcode=1, flags=1 << 5 | 1 << 4), message(response=False, rrs=rrs[-1:], opcode=5, error=True, qtype=16, qname="_a._tcp.x.com")], sizes=True, count_queries=True, underscores=True)
    # an extended code is put above the header's four bits
    assert (s["RCODE", "17"], s["RCODE", "16"], s["OpCode", "0"], s["OpCode", "5"], s["Z-Error Flags", "1"]) == (1, 1, 1, 1, 1)
    assert (s["CLASS", "1"], s["RR Type", "48"], s["RR Type", "41"], s["Q-RR Type", "41"], s["Q-CLASS", "1"]) == (5, 2, 1, 1, 2)
    assert ("RR Type", "1") not in s
    assert (s["DNSSEC Algorithm Numbers", "2"], s["DNSSEC Algorithm Numbers", "8"], s["DNSSEC Algorithm Numbers", "13"], s["DNSSEC KEY Prime Lengths", "1"], s["DNSSEC Well Known Primes", "2"]) == (1, 1, 1, 1, 1)
    assert (s["DANE_CertUsage", "3"], s["DANE_TlsaSelector", "1"], s["DANE_TlsaMatchingType", "1"]) == (1, 1, 1)
    # DO (flag 0) is on by the signature in the first message only; flag 15 is the lowest bit
    assert (s["EDNS Header_Flags", "0"], s["EDNS Header_Flags", "15"], s["EDNS Version number", "2"], s["EDNS OPT CODE", "8"], s["EDNS OPT CODE", "10"]) == (1, 2, 2, 2, 2)
    assert (s["Header Flags", "5"], s["Header Flags", "4"], s["TC Length", "1232"], s["EDNS Packet Size", "1232"], s["Response Size", "50"], s["Query Size", "50"]) == (1, 1, 1, 1, 1, 1)
    assert (s["Underlined part", "TXT"], s["Underlined part", "_a"], s["Underlined part", "_tcp"]) == (1, 1, 1)


def test_root_branch(spark):
    leaks = [("PROBEABCD", 1), ("PROBEABCE", 2), ("probeabcf", 3), ("home", 9), ("lan", 5), ("quitealongername1", 1), ("x.quitealongername1", 1), ("7.7", 1), ("1.2.3.4", 2), ("a.b_c", 1), ("host.local", 4), ("gone.arpa", 2)]
    rows = [message(rcode=3, qname=q, us=i) for q, n in leaks for i in range(n)]
    rows += [message(qname="www.com", rrs=[("answer", "www.com", 1, 1, 0, bytearray(b"\x01"))], us=u, client=c) for c, u in (("a", 1), ("a", 2), ("a", 3), ("b", 1))]
    rows += [message(qname="www.com"), message(rcode=2), message(qname=None, qtype=None, qclass=None, questions=0, rcode=3)]  # an empty answer, a failure, no question
    s = summary(spark, rows, listed=3, nx_usage=True)
    assert (s["root-QR", "3"], s["root-QR", "0"], s["root-QR", "2"], s["CHROMIUM_LEAK_REF", "0"]) == (33, 5, 1, 38)
    # three names stay; seldom probes and, beyond the list, others go by length
    assert {k: v for k, v in s.items() if k[0] in ("LeakedTLD", "CHROMIUM_PROBES", "LeakByLength")} == {("LeakedTLD", "HOME"): 9, ("LeakedTLD", "LAN"): 5, ("LeakedTLD", "PROBEABCF"): 3, ("CHROMIUM_PROBES", "9"): 3, ("LeakByLength", "17"): 2}
    assert (s["Leaked2ndLD", "-- NONE --"], s["Leaked2ndLD", "X"], s["LeakedTLD_NUMERIC", "0"], s["LeakedTLD_IPV4", "0"], s["LeakedTLD_SYNTAX", "0"], s["RFC6761-TLD", "LOCAL"]) == (21, 1, 1, 2, 1, 4)
    # pairs of client and name: a and b with COM; not found: each name once
    assert (s["UsefulQueries", "1"], s["UsefulQueries", "0"], s["UsefulQueries", "2"]) == (2, 2, 10)
    assert s["NAME_PARTS_COUNT", "2"] == 1 + 1 + 1 + 4 + 4  # the names under ARPA have no records and are neither


def test_clients_and_zones(spark):
    opt = lambda ttl, data="": ("additional", "", 41, 512, ttl, bytearray(bytes.fromhex(data)))
    answer = lambda owner: ("answer", owner, 1, 1, 0, bytearray(b"\x01"))
    rows = [
        message("mini", "s", qname="x.com", rrs=[answer("X.com")]), message("mini", "s", qname="y.com"), message("full", "s", qname="x.com", rrs=[answer("y.com")]),
        message("recursive", "s", flags=16, rrs=[answer("a.com")]), message("do", "s", qname="www.signed.com", rrs=[answer("b.com"), ("answer", "www.signed.com", 46, 1, 0, bytearray(b"\x01" * 19)), opt(0)]), message("do", "s", qname="plain.com", rrs=[opt(0x8000)]),
        message("failed", "s", rcode=2), message("ask", "s", response=False, rrs=[opt(0, "000A0000")]), message("ask", "s", response=False, rrs=[opt(0, "000A000000080000")]), message("leak", "s", response=False, qname="x.home", rrs=[opt(0, "000A0000")]),
    ]
    zones = spark.createDataFrame([("com", "std")], "suffix string, kind string")
    s = summary(spark, rows, zones)
    assert {k: v for k, v in s.items() if "USAGE" in k[0].upper() or k[0] in ("SENDING_RECURSIVE_SET", "EDNS_OPTIONS_TOTAL_QUERIES")} == {
        ("DNSSEC_Client_Usage", "0"): 3, ("DNSSEC_Client_Usage", "1"): 1, ("EDNS_CLIENT_USAGE", "0"): 3, ("EDNS_CLIENT_USAGE", "1"): 1, ("SENDING_RECURSIVE_SET", "0"): 3, ("SENDING_RECURSIVE_SET", "1"): 1,
        ("QNAME_MINIMIZATION_USAGE", "1"): 1, ("QNAME_MINIMIZATION_USAGE", "0"): 3, ("EDNS_OPTIONS_TOTAL_QUERIES", "0"): 1, ("EDNS_OPTIONS_USAGE", "10"): 1, ("EDNS_OPTIONS_USAGE", "8"): 1,
        ("DNSSEC_Zone_Usage", "1"): 1, ("DNSSEC_Zone_Usage", "0"): 1, ("TLD-Usage-Count", "1"): 7,
    }


def test_cells_are_compiled_and_made_once(spark, monkeypatch):
    """A generator that makes the cells itself is interpreted, and one that isn't outer gets a filter that makes them a second time."""
    plans, stored = [], registries.stored
    monkeypatch.setattr(registries, "stored", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stored(df, name))
    summary(spark, [message()], spark.createDataFrame([("com", "std")], "suffix string, kind string"))
    assert re.findall(r"Generate (\w+)\(cells#\d+\)", plans[0]) == ["explode"]
    assert plans[0].count("LeakedTLD_SYNTAX") == 1


def test_no_messages(spark):
    assert summary(spark, []) == {}
    assert summary(spark, [message(qname=None, qtype=None, qclass=None, rrs=[(None, None, None, None, None, None)], flags=None, rcode=None, questions=None)])[("OpCode", "0")] == 1


# fixed values: a published summary of a small capture, without the long lists' tails, and the metrics published for it
SUMMARY = {
    "root-QR": {"0": 1952, "1": 2, "3": 2438}, "UsefulQueries": {"0": 927, "1": 944}, "RCODE": {"0": 7037, "1": 2, "2": 2, "3": 2735, "5": 1}, "RFC6761-TLD": {"INVALID": 13, "LOCAL": 96, "LOCALHOST": 11, "TEST": 1},
    "EDNS_CLIENT_USAGE": {"0": 238, "1": 566}, "DNSSEC_Client_Usage": {"0": 277, "1": 527}, "QNAME_MINIMIZATION_USAGE": {"0": 686, "1": 118}, "SENDING_RECURSIVE_SET": {"0": 724, "1": 80}, "CHROMIUM_LEAK_REF": {"0": 4390},
    "CHROMIUM_PROBES": {"7": 153, "8": 148, "9": 128, "10": 162, "11": 133, "12": 124, "13": 128, "14": 134, "15": 134}, "EDNS_OPTIONS_TOTAL_QUERIES": {"0": 741}, "EDNS_OPTIONS_USAGE": {"8": 5, "10": 1},
    "NAME_PARTS_COUNT": {"0": 184, "1": 1362, "2": 442, "3": 1171, "4": 803, "5": 133, "6": 120, "7": 53, "8": 27, "9": 8, "10": 1, "11": 2, "12": 2, "34": 1}, "TLD-Usage-Count": {"0": 297, "1": 170},
    "RFC6761Usage": {"INVALID": 3, "LOCAL": 51, "LOCALHOST": 3}, "CLASS": {"1": 65659, "3": 16}, "OpCode": {"0": 9775, "5": 2},
}
PUBLISHED = {
    ("M3.1", ""): 0.555353, ("M3.2", ""): 0.495457, ("M3.3.1", "LOCAL"): 0.021868, ("M3.3.1", "INVALID"): 0.002961, ("M3.3.1", "LOCALHOST"): 0.002506, ("M3.3.1", "TEST"): 0.000228, ("M3.3.3", "chr_10"): 0.036902, ("M3.3.3", "chr_7"): 0.034852,
    ("M3.4.1", ""): 0.703980, ("M3.4.2", "8"): 0.006748, ("M3.4.2", "10"): 0.001350, ("M3.5", ""): 0.655473, ("M3.6", ""): 0.146766, ("M3.8", ""): 0.099502, ("M3.9", ""): 0.283371, ("M3.10", "0"): 0.042701, ("M3.10", "1"): 0.316083,
    ("M3.10", "12"): 0.000464, ("M3.10", "13"): 0.0, ("M3.10", "34"): 0.000232, ("M4.1", ""): 0.364026, ("M4.2", "LOCAL"): 0.109208, ("M4.2", "INVALID"): 0.006424, ("M4.5", ""): 0.655473,
    ("M8.1", ""): 0.559763, ("M8.2.1", ""): 0.703980, ("M8.2.2", "8"): 0.006748, ("M8.2.2", "10"): 0.001350, ("M8.3", ""): 0.655473, ("M8.4", ""): 0.146766, ("M6.DNS.01.1", ""): 0.333333, ("M6.DNS.01.2", ""): 0.0, ("M6.DNS.01.3", "1"): 65659.0, ("M6.DNS.01.3", "3"): 16.0, ("M6.DNS.03.1", ""): 0.4,
}


def test_published_metrics(spark):
    s = spark.createDataFrame([Row(registry=r, key=k, count=n) for r, keys in SUMMARY.items() for k, n in keys.items()])
    tables = spark.createDataFrame([("DNS.01", "CLASS"), ("DNS.03", "OpCode")], "table_id string, registry string")
    # six classes and five operation codes are registered
    registered = spark.createDataFrame([("DNS.01", str(k)) for k in (0, 1, 3, 4, 254, 255)] + [("DNS.03", str(k)) for k in (0, 1, 2, 4, 5)], "table_id string, key string")
    found = {}
    for df in (metrics.m3(s), metrics.m4(s), metrics.m8(s), metrics.m6(s.join(tables, "registry"), registered)):
        found |= {(r["metric"], r["key"]): r["value"] for r in df.collect()}
    assert {k: round(found[k], 6) for k in PUBLISHED} == pytest.approx(PUBLISHED, abs=1e-6)
    assert found["M3.3.4", ""] == pytest.approx(0.555353 - sum(v for k, v in found.items() if k[0] in ("M3.3.1", "M3.3.3")), abs=1e-6)

from __future__ import annotations

from pyspark.sql import functions as F

from idhealth.functions.addresses import cidr_range
from idhealth.operators import leaks
from idhealth.operators.ipstats import count_above, fix_day31, log_feature, safe_ratio
from idhealth.operators.rsvlog import filter_events, parse, resolver_tag, tagged
from idhealth.sources import readers, sinks


def test_branch_labels(spark):
    rows = [(3, "a.home", 1, 0), (3, "x.arpa", 1, 0), (0, "a.com", 1, 2), (0, "", 1, 2), (0, "a", 3, 1), (0, "a.com", 1, 0), (2, "a", 1, 1)]
    df = spark.createDataFrame(rows, "rcode int, name string, qclass int, n int").withColumn("i", F.monotonically_increasing_id())
    fixed = leaks.fix_arpa(F.col("rcode"), F.substring_index("name", ".", -1))
    got = [r[0] for r in df.orderBy("i").select(leaks.branch(fixed, F.col("name"), F.col("qclass"), F.col("n"), ("HOME",))).collect()]
    assert got == ["frequent", None, "tld", "root", "chaos", None, None]


def test_roots(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, server string")
    got = leaks.is_root(df, "server", spark.createDataFrame([("a",), ("a",)], "server string"))
    assert {(r.i, r.is_root) for r in got.collect()} == {(1, True), (2, False), (3, False)}


def test_suffix_list(spark):
    df = spark.createDataFrame([("// x",), ("",), ("com",), ("COM ",), ("*.ck",), ("!www.ck // y",), ("bücher.example",)], "value string")
    assert {tuple(r) for r in leaks.normalize_suffixes(df).collect()} == {("COM", "std"), ("CK", "wildcard"), ("WWW.CK", "exception"), ("XN--BCHER-KVA.EXAMPLE", "std")}


def test_anonymized_addresses(spark):
    given = ["8.8.8.8", "192.168.1.2", "127.0.0.1", "10.2.3.4", "240.1.1.1", "172.20.1.1", "::1"]
    df = spark.createDataFrame([(g,) for g in given], "x string")
    got = {r.x: r.y for r in df.select("x", leaks.anonymize_ip(F.col("x"), "k", ("8.8.8.8",)).alias("y")).collect()}
    assert got["8.8.8.8"] == "8.8.8.8" and got["127.0.0.1"] == "127.0.0.1" and got["240.1.1.1"] == "240.1.1.1" and got["::1"] == "::1"
    assert got["192.168.1.2"].startswith("192.168.") and got["172.20.1.1"].startswith("172.20.") and got["10.2.3.4"].startswith("10.") and got["10.2.3.4"] != "10.2.3.4"


def test_no_address_leaves_in_clear(spark):
    given = ["2001:db8:1:ffff:0:abcd::9", "2001:DB8:0:0:0:0:0:77", "fe80::1234:5678", "::ffff:8.9.10.11", "no address", "1.2.3", "2001:db8::zz", None, " 2001:db8::5 "]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, x string")
    got = [r.y for r in df.select("i", leaks.anonymize_ip(F.col("x"), "k").alias("y")).orderBy("i").collect()]
    assert got[4:8] == [None] * 4
    for i, shape in ((0, "2001:xxx:1:ffff:0:xxxx:0:x"), (1, "2001:xxx::xx"), (2, "fe80::xxxx:xxxx"), (8, "2001:xxx::x")):
        assert got[i] not in given and [len(t) for t in got[i].split(":")] == [len(t) for t in shape.split(":")]
        assert all(a == b for a, b in zip(got[i].split(":"), shape.split(":")) if "x" not in b)
    assert got[3].startswith("::ffff:8.") and got[3] != given[3]
    assert got == [r.y for r in df.select("i", leaks.anonymize_ip(F.col("x"), "k").alias("y")).orderBy("i").collect()]
    assert got[0] != df.select(leaks.anonymize_ip(F.col("x"), "other").alias("y")).first().y


def test_features(spark):
    df = spark.createDataFrame([(100, [2] * 30 + [99], 50, 4.0, 0.0)], "q long, days array<long>, arpa long, a double, b double")
    d31, arpa = fix_day31(F.col("q"), F.col("days"), F.col("arpa"))
    r = df.select(d31, arpa, safe_ratio(F.col("a"), F.col("b")), log_feature(F.col("a")), count_above(["a", "b"], 0.5)).first()
    assert tuple(r)[:3] == (40, 10, 0.0) and abs(r[3] - 0.9542425) < 1e-6 and r[4] == 1


def test_shapes_of_measurement_names(spark):
    """Known lines with their known fields: prefix, user, country, AS, time, client, server, results, shape, invalid label."""
    lines = [
        ("0di-u19783a8a-c233-a1ef2-s1730423099-i00000000-0.am.dotnxdomain.net.", ("0di", "u19783a8a", "US", 7922, 1730423099, "0.0.0.0", "am.dotnxdomain.net", False, "params", None)),
        ("0du-results-u4d03cba4-c233-a58f5-s1730423089-i00000000-0.am.dotnxdomain.net.", ("0du", "u4d03cba4", "US", 22773, 1730423089, "0.0.0.0", "am.dotnxdomain.net", True, "params", None)),
        ("firmware.am.dotnxdomain.net.", (None, None, None, None, None, None, "am.dotnxdomain.net", False, "short", "firmware")),
        ("0di-u5cbd23ce-c238-a409b4-s1730422799-ibe78f991-0.la.dotnxdomain.net.", ("0di", "u5cbd23ce", "VE", 264628, 1730422799, "190.120.249.145", "la.dotnxdomain.net", False, "params", None)),
        ("0du-uf8c0aa51-c185-a40625-s1730422799-iaa54ac12-0.la.dotnxdomain.net.", ("0du", "uf8c0aa51", "PY", 263717, 1730422799, "170.84.172.18", "la.dotnxdomain.net", False, "params", None)),
        ("000-000-000a-0000-0006-e7b5bab7-233-a55A8-1736378116-ac380eb6-0.am2.dotnxdomain.net.", ("000-000-000a-0000-0006", "e7b5bab7", "US", 21928, 1736378116, "172.56.14.182", "am2.dotnxdomain.net", False, "anomalous", None)),
        ("invalid4.starnxdomain.net.", (None, None, None, None, None, None, "invalid4.starnxdomain.net", False, "star", None)),
        ("root-key-sentinel-is-ta-20326.0ds-uec321a73-c233-s1536509491-icff1e56f-2.am.dotnxdomain.net.", ("root-key-sentinel", None, None, None, None, None, "am.dotnxdomain.net", False, "sentinel", None)),
        ("0di-u1-c300-s1730423099-i00000001-0.am.dotnxdomain.net", ("0di", "u1", "c300", 0, 1730423099, "0.0.0.1", "am.dotnxdomain.net", False, "params", None)),
    ]
    codes = ["--"] * 249
    codes[232], codes[237], codes[184] = "US", "VE", "PY"
    df = spark.createDataFrame([(i, f"1730423099.986047 client 2001:558:fe13:d::147#20318: query: {x} IN DS -ED (C) -1293065646 0") for i, (x, _) in enumerate(lines)], "i int, value string")
    got = {r.port: r for r in parse(df.limit(1), codes=codes).collect()}[20318]
    assert (got.us, got.resolver, got.type, got.flags) == (1730423099986047, "2001:558:fe13:d::147", "DS", "-ED (C) -1293065646 0")
    for line, want in lines:
        r = parse(spark.createDataFrame([(f"1730423099.986047 client 1.2.3.4#20318: query: {line} IN DS -ED",)], "value string"), codes=codes).first()
        assert (r.prefix, r.user, r.cc, r.asn, r.ad_time, r.client, r.server, r.is_results, r.shape, r.invalid) == want, line


def test_tags_by_as_and_network(spark):
    nets = spark.createDataFrame([("8.8.8.0/24", "a"), ("8.0.0.0/8", "b"), ("2001:db8::/32", "c"), ("2001:db8:1::/48", "d")], "net string, tag string").select(cidr_range("net").alias("r"), "tag").select("r.first", "r.last", "tag")
    df = spark.createDataFrame([("8.8.8.8", 1), ("8.9.9.9", 1), ("9.9.9.9", 1), ("9.9.9.9", 7), ("2001:db8:1::5", 1), ("2001:db8:2::5", 1), ("x", 1)], "resolver string, resolver_asn long")
    got = {(r.resolver, r.resolver_asn): r.tag for r in tagged(df, spark.createDataFrame([(7, "as")], "asn long, tag string"), nets).collect()}
    assert got == {("8.8.8.8", 1): "a", ("8.9.9.9", 1): "b", ("9.9.9.9", 1): None, ("9.9.9.9", 7): "as", ("2001:db8:1::5", 1): "d", ("2001:db8:2::5", 1): "c", ("x", 1): None}


def test_log_lines(spark):
    lines = ["1500000000.25 client 1.2.3.4#53: query: 0du-u1-c13-a3b-s1499999999-i01020304-0.exp.x IN A -E", "bad", "1500000000 client ::1#5: query: 000-000-000-0000.exp.x IN AAAA", "1500000000 client ::1#5: query: root-key-sentinel-is-ta.x IN A +"]
    got = {r.shape: r for r in parse(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    p = got["params"]
    assert (p.us, p.resolver, p.asn, p.ad_time, p.client, p.experiment, p.user) == (1_500_000_000_250_000, "1.2.3.4", 59, 1499999999, "1.2.3.4", "exp", "u1")
    assert set(got) == {"params", "anomalous", "sentinel"}
    kept = filter_events(parse(spark.createDataFrame([(x,) for x in lines], "value string")), 10, ["exp"], ["A"])
    assert kept.count() == 1
    tags = spark.createDataFrame([("g", None, True, True), (None, "q", True, True), (None, None, True, True), (None, None, False, True), (None, None, False, False)], "a string, n string, s boolean, c boolean")
    assert [r[0] for r in tags.select(resolver_tag(F.col("a"), F.col("n"), F.col("s"), F.col("c"))).collect()] == ["g", "q", "Same_AS", "Same_CC", "Others"]


def test_wide_records(spark, tmp_path):
    n = sum(max(1, k) for _, k in readers.RECORD) - 2
    row = lambda ip: ",".join([ip, "7", *["1"] * (n - 2)])
    (tmp_path / "r.csv").write_text("\n".join([row("10.0.0.1"), row("10.0.0.1"), row("2.2.2.2")]) + "\n")
    got = {r.ip: r for r in readers.read_records(spark, str(tmp_path / "r.csv")).collect()}
    assert got["10.0.0.1"].queries == 14 and got["10.0.0.1"].hourly == [2] * 24 and got["10.0.0.1"].tld_registers == [1] * 16 and got["2.2.2.2"].users == 0
    sinks.write_records(readers.read_records(spark, str(tmp_path / "r.csv")).select("ip", "queries", "hourly"), str(tmp_path / "o"), "ip")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "o")).collect())[0].startswith("10.0.0.1,14,2,2")

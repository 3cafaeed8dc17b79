from __future__ import annotations

import hashlib
import ipaddress
import math
import random

from pyspark.sql import functions as F

from idhealth.functions import addresses, dns, names, sketches, slices, sqlfuncs


def column(spark, values, expr, name="x", kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col(name))).collect()]


def test_leak_classes(spark):
    given = ["a.b\x01", "x.b_d", "1.2.3.4", "a.77", "www.Local", "home", "abcdefgh", "a." + "x" * 16, "a.short", ""]
    want = ["binary", "bad_syntax", "ipv4", "numeric", "rfc6761", "frequent", "dga", "jumbo", "other", "bad_syntax"]
    assert column(spark, given, lambda c: names.leak_type(c, ("HOME",))) == want


def test_ipv4_names(spark):
    given = ["1.2.3.4", "x.1.2.3.4", "256.2.3.4", "1.2.3", "255.255.255.255", "01.2.3.4", "a1.2.3.4"]
    assert column(spark, given, names.is_ipv4_name) == [True, True, False, False, True, False, False]


def test_labels_and_tld(spark):
    assert column(spark, ["a.b.c.", "a", "", None], names.n_labels) == [3, 1, 0, 0]
    assert column(spark, ["a.b.c.", "a"], names.sld) == ["b", None]


def slow_metrics(x):
    n, low = len(x), x.lower()
    kl = lambda counts, prior, total, model: sum((c + w) / total * math.log((c + w) / total / m) for c, w, m in zip(counts, prior, model))
    groups = [sum(names.LETTER_GROUP[ord(c) - 97] == g for c in low) for g in range(5)]
    kinds = "".join("v" if c in "aeiou" else "c" for c in low)
    steps = [sum(kinds[i : i + 2] == k for i in range(n - 1)) for k in ("vv", "vc", "cv", "cc")]
    uniform = [w / 26 for w in names.GROUP_LETTERS]
    p = 1.0
    for c in low:
        p *= 26 * names.LETTER_SHARE[ord(c) - 97]
    return {"p": p, "c_u": kl(groups, uniform, n + 1, uniform), "c_a": kl(groups, uniform, n + 1, names.GROUP_SHARE), "t_u": kl(steps, names.STEP_UNIFORM, n, names.STEP_UNIFORM), "t_a": kl(steps, names.STEP_UNIFORM, n, names.STEP_SHARE)}


def test_random_metrics_match_direct_sums(spark):
    rng = random.Random(3)
    given = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzAEIOQ") for _ in range(rng.randint(2, 16))) for _ in range(60)]
    df = spark.createDataFrame([(g,) for g in given], "x string")
    for r in df.select("x", F.struct(*[c.alias(k) for k, c in names.random_metrics(F.col("x")).items()]).alias("m")).collect():
        for k, v in slow_metrics(r.x).items():
            assert abs(r.m[k] - v) < 1e-9, (r.x, k)


def test_patterns(spark):
    given = ["xn--abcd", "12", "-2", "12345", "museum", "qzxkvjwq", "hello-x", "a1b2"]
    got = column(spark, given, names.name_pattern)
    assert got[:4] == ["idn_7_64", "num_1_3", "num_1_3", "num_4_8"] and got[4] == "alpha_6_7" and got[5] == "dga_alpha_8" and got[6:] == [None, None]


def test_zone_rules(spark):
    rules = spark.createDataFrame([("com", "std"), ("ck", "wildcard"), ("www.ck", "exception"), ("co.uk", "std")], "suffix string, kind string")
    given = ["a.b.com", "com", "x.y.z.ck", "www.ck", "a.www.ck", "p.q.co.uk", "one", "a.b.c"]
    df = names.zone(spark.createDataFrame([(g,) for g in given], "n string"), "n", rules)
    assert {r.n: r.zone for r in df.collect()} == {"a.b.com": "B.COM", "com": None, "x.y.z.ck": "Y.Z.CK", "www.ck": "WWW.CK", "a.www.ck": "WWW.CK", "p.q.co.uk": "Q.CO.UK", "one": "ONE", "a.b.c": "B.C"}


def test_anonymize_keeps_shape(spark):
    def slow(label, key):
        d = hashlib.sha256((key + label.lower() + key).encode()).digest()
        x = [d[i % 32] * 256 + d[(i + 8) % 32] for i in range(len(label))]
        return "".join(chr(65 + v % 26) if c.isalpha() else str(v % 10) if c.isdigit() else c for c, v in zip(label, x))

    got = column(spark, ["abc-12.example.com", "local.Xy.org"], lambda c: names.anonymize_name(c, "k", 1))
    assert got == [f"{slow('abc-12', 'k')}.example.com", f"local.{slow('Xy', 'k')}.org"]


def test_fnv_vectors(spark):
    got = column(spark, ["", "a", "AAA", "COM"], lambda c: F.concat(F.lpad(F.hex(sketches.fnv64(c)["hi"]), 8, "0"), F.lpad(F.hex(sketches.fnv64(c)["lo"]), 8, "0")))
    assert got == ["CBF29CE484222325", "AF63DC4C8601EC8C", "FA2BFC19A0708642", "0BA0F219AA5D69FE"]


def test_sketch_merge_is_sketch_of_union(spark):
    df = spark.range(3000).selectExpr("id % 2 AS part", "cast(id as string) AS v", "1 AS one")
    a = sketches.merge_registers(sketches.registers(df, ["part", "one"], "v"), ["one"]).collect()
    b = sketches.registers(df, ["one"], "v")
    assert a == b.collect()
    assert 0.6 * 3000 < b.select(sketches.estimate(F.col("registers"))).first()[0] < 1.4 * 3000


def test_addresses(spark):
    given = ["10.1.2.3", "2001:db8::1", "nonsense", None]
    got = column(spark, given, addresses.ip_bin)
    assert bytes(got[1]) == ipaddress.ip_address("2001:db8::1").packed and bytes(got[0])[-4:] == bytes([10, 1, 2, 3]) and got[2] is None and got[3] is None
    assert column(spark, given[:2], addresses.network) == ["10.1.2.0/24", "20010db80000/48"]
    r = column(spark, ["10.1.2.0/23"], addresses.cidr_range)[0]
    assert bytes(r["last"])[-4:] == bytes([10, 1, 3, 255]) and r["prefix"] == 23


def test_edns_and_dnssec(spark):
    df = spark.createDataFrame([(0x01008000, 3, [3, 10])], "ttl long, rcode int, o array<int>")
    e = df.select(dns.edns(F.col("ttl"), F.col("rcode"), F.col("o")).alias("e")).first()["e"]
    assert (e["do"], e["version"], e["flags"], e["rcode"], e["options"]) == (True, 0, [0], 19, [3, 10])
    df = spark.createDataFrame([(48, b"\x01\x01\x03\x08"), (52, b"\x03\x01\x01"), (1, b"\x7f\0\0\1")], "t int, d binary")
    got = [r["p"] for r in df.select(dns.dnssec_params(F.col("t"), F.col("d")).alias("p")).collect()]
    assert got[0]["algorithm"] == 8 and (got[1]["usage"], got[1]["selector"], got[1]["matching"]) == (3, 1, 1) and got[2]["algorithm"] is None


def test_slice_names(spark):
    got = column(spark, ["/d/us-lax/20190102-030405_300_node1.csv", "x/20190102-030405_300_n_fr-par.csv", "bad"], slices.parse_slice_name)
    assert (str(got[0]["date"]), got[0]["time"], got[0]["duration_s"], got[0]["node"], got[0]["cc"], got[0]["city"]) == ("2019-01-02", "030405", 300, "node1", "us", "lax")
    assert (got[1]["cc"], got[1]["city"]) == ("fr", "par") and got[2]["date"] is None
    assert column(spark, ["c121", "FR", "c0102"], slices.cc_from_number) == ["AU", "FR", "AB"]


def test_safe_text_and_sql_functions(spark):
    assert column(spark, ["=a,b", " x  y ", "é", ""], names.safe_text) == ["\\061a\\044b", "\\032x \\032y\\032", "\\195\\169", ""]
    sqlfuncs.register(spark)
    assert spark.sql("SELECT id_tld('a.b.'), id_sld('a.b'), id_labels('a.b.c'), id_is_probe('abcdefgh'), id_parse_int('1,234')").first()[:] == ("b", "a", 3, True, 1234)

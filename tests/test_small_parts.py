"""Small readers, writers, columns and stages, each against values worked out by hand."""

from __future__ import annotations

import datetime
import gzip
import json

from pyspark.sql import functions as F

from idhealth.functions import dns, names
from idhealth.operators import counters, ipstats, leaks, populations, ranges
from idhealth.sources import readers, sinks
from idhealth.streaming import stages


def put(path, text):
    path.write_text(text)
    return str(path)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_lists_of_resolvers_and_ranges(spark, tmp_path):
    p = put(tmp_path / "r.csv", "1.2.3.4,AS12,FR,yes,1,1,1,1,1,1,1,70\nbad,line\n")
    assert [tuple(r) for r in readers.read_resolver_list(spark, p).collect()] == [("1.2.3.4", 12, "FR", True, 70)]
    p = put(tmp_path / "a.csv", "1.0.0.0,1.0.0.255,13335,\n2.0.0.0\t2.0.0.9\t7\nip_first,ip_last,as\n")
    assert sorted(tuple(r) for r in readers.read_ip2as(spark, p).collect()) == [("1.0.0.0", "1.0.0.255", 13335), ("2.0.0.0", "2.0.0.9", 7)]


def test_name_columns(spark):
    assert one(spark, names.underscore_labels(F.lit("_443._tcp.Example.org"))) == ["_443", "_tcp"]
    q = lambda *x: one(spark, names.is_qname_minimized(*[F.lit(v) for v in x[:4]], F.lit(x[4]).cast("string")))
    assert q("A.org", 2, 1, 1, "a.ORG") and q("a.org", 1, 1, 1, None)
    assert not q("a.org", 1, 1, 1, "b.a.org") and not q("a.org", 16, 1, 1, "a.org") and not q("a.org", 1, 3, 1, "a.org") and not q("a.org", 1, 1, 2, "a.org")


def test_option_hash_folds_to_six_bits(spark):
    for code in (0, 8, 63, 64, 4097, 65535):
        assert one(spark, dns.option_hash(F.lit(code))) == (code ^ code >> 6 ^ code >> 12) & 63


def test_presence_and_levels(spark):
    assert one(spark, ipstats.presence_count(F.array(*[F.lit(i) for i in (3, 0, 1)]), F.lit(2.9), 1)) == 4
    assert one(spark, ipstats.presence_count(F.array(F.lit(0)), F.lit(0.0), 1)) == 1
    df = spark.createDataFrame([("a", 1, [1, 2]), ("a", 1, [3, 4]), ("a", 2, [5, 6]), ("b", 1, [7, 8])], "ip string, day int, v array<long>")
    fine, coarse = ipstats.merge_levels(df, [["ip", "day"], ["ip"]], {"v": 2})
    assert {(r.ip, r.day): r.v for r in fine.collect()} == {("a", 1): [4, 6], ("a", 2): [5, 6], ("b", 1): [7, 8]}
    assert {r.ip: r.v for r in coarse.collect()} == {"a": [9, 12], "b": [7, 8]}


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("2020-01-01", "n1", 3), ("2020-01-02", "n2", 4)], "date string, address string, queries long")
    for _ in range(2):
        sinks.write_sum3(df, str(tmp_path / "sum3"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "sum3"))
    assert sorted((str(r.date), r.address, r.queries) for r in back.collect()) == sorted([("2020-01-01", "n1", "3"), ("2020-01-02", "n2", "4")] * 2)
    sinks.write_partitioned(df, str(tmp_path / "parts"), "address", ["queries"])
    assert sorted(x.name for x in (tmp_path / "parts").iterdir() if x.is_dir()) == ["address=n1", "address=n2"]
    sinks.write_report(df.coalesce(1), str(tmp_path / "report"), [F.col("queries").desc()])
    text = "".join(gzip.open(x, "rt").read() for x in sorted((tmp_path / "report").glob("*.gz")))
    assert [x for x in text.split() if not x.startswith("date")] == ["2020-01-02,n2,4", "2020-01-01,n1,3"]
    sinks.publish(spark.createDataFrame([("M1", [0.5, None])], "m string, v array<double>"), str(tmp_path / "json"), "m", "v")
    lines = [json.loads(x) for f in (tmp_path / "json").glob("*.txt") for x in f.read_text().splitlines()]
    assert lines[0]["metric"] == "M1" and lines[0]["values"][0] == 0.5


def test_top_lists_of_large_groups(spark):
    rows = [("a", f"k{i:04}", i % 50) for i in range(900)] + [("b", "x", 1), ("b", "y", 1), ("b", "z", 1)]
    df = spark.createDataFrame(rows, "g string, k string, c long").repartition(5)
    got = {(r.g, r.k): r.c for r in counters.top_with_rest(df, ["g"], "k", "c", 40).collect()}
    best = sorted([r for r in rows if r[0] == "a"], key=lambda r: (-r[2], r[1]))
    want = {("a", k): c for _, k, c in best[:40]} | {("a", "-- OTHERS --"): sum(r[2] for r in best[40:])} | {("b", k): 1 for k in "xyz"}
    assert got == want
    assert {(r.g, r.k): r.c for r in counters.top_with_rest(df, ["g"], "k", "c", 2).where("g = 'b'").collect()} == {("b", "x"): 1, ("b", "y"): 1, ("b", "-- OTHERS --"): 1}


def test_running_sums_over_bands(spark):
    values = [0, 0, 1, 1, 2, 7, 7, 8, 1000, 10**9, 10**9, 123_456_789, -5, -1]
    df = spark.createDataFrame([(g, v) for g in ("x", None) for v in values], "g string, v long")
    got = {(r.g, r.v): (r.n_, r.before_, r.ahead_) for r in populations.runs(df, "v", ["g"]).collect()}
    for g in ("x", None):
        for v in set(values):
            assert got[g, v] == (values.count(v), sum(u for u in values if u > v), sum(u > v for u in values))
    assert len(got) == 2 * len(set(values))


def test_flattened_ranges_over_many_buckets(spark):
    rows = [(0, 5_000_000, 1), (100, 200, 2), (4_000_000, 4_000_000, 3), (5_000_001, 5_000_010, 1), (10**12, 10**12 + 70_000, 4)]
    got = sorted(tuple(r) for r in ranges.flatten_ranges(spark.createDataFrame(rows, "lo long, hi long, value long"), bits=12).collect())
    assert got == [(0, 99, 1), (100, 200, 2), (201, 3_999_999, 1), (4_000_000, 4_000_000, 3), (4_000_001, 5_000_010, 1), (10**12, 10**12 + 70_000, 4)]


def test_ranges_of_bytes(spark):
    b = lambda x: bytes.fromhex(x.ljust(32, "0"))
    e = lambda x: bytes.fromhex(x.ljust(32, "f"))
    r = spark.createDataFrame([(b("20"), e("2f"), "wide"), (b("2a01"), e("2a02"), "odd"), (b("2a01"), b("2a01"), "point"), (b("7fff"), e("8000"), "across")], "lo binary, hi binary, v string")
    keys = {"2a01": "point", "2a0105": "odd", "2a03": "wide", "8000ff": "across", "7fff": "across", "9": None}
    df = spark.createDataFrame([(k, bytearray(b(k))) for k in keys] + [("null", None)], "k string, a binary")
    got = {x.k: x.v for x in ranges.most_specific_bytes(df, "a", r, "lo", "hi", "v").collect()}
    assert got == keys | {"null": None}
    apart = ranges.interval_join_bytes(df, "a", r.where("v IN ('odd', 'across')"), "lo", "hi", "v", "-")
    assert {x.k: x.v for x in apart.collect()} == {"2a01": "odd", "2a0105": "odd", "2a03": "-", "8000ff": "across", "7fff": "across", "9": "-", "null": "-"}


def test_names_by_type(spark):
    df = spark.createDataFrame([("10.1.2.3",), ("www.local",), ("a.b.local",), ("x",)], "name string")
    assert {r.name for r in leaks.extract_names(df, "name", "rfc6761", 3).collect()} == {"a.b.local"}


def streamed(spark, tmp_path, rows, make):
    t0 = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([(n, c, t0 + datetime.timedelta(hours=h)) for n, c, h in rows], "node string, cc string, t timestamp")
    df.write.parquet(str(tmp_path / "in"))
    out = make(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    stages.run_once(out, str(tmp_path / "out"), str(tmp_path / "state"))
    return spark.read.schema(out.schema).parquet(str(tmp_path / "out"))


def test_messages_once(spark, tmp_path):
    rows = [("a", "fr", 1), ("a", "fr", 1), ("b", "fr", 2)]
    assert streamed(spark, tmp_path, rows, lambda s: stages.distinct_messages(s, "t", ["node", "t"])).count() == 2


def test_days_of_a_pattern(spark, tmp_path):
    rows = [("a", "fr", 1), ("b", "fr", 2), ("c", "us", 3), ("a", "fr", 30), ("a", "fr", 200)]
    got = {str(r.day): (r.slices, r.nodes) for r in streamed(spark, tmp_path, rows, lambda s: stages.pattern_days(s, "t", "fr", None)).collect()}
    assert got == {"2024-01-01": (2, ["a", "b"]), "2024-01-02": (1, ["a"])}


def test_capped_rows_are_the_first_ones(spark, tmp_path):
    rows = [("a", str(i), 1 + i / 100) for i in range(5)] + [("a", "x", 2), ("b", "y", 1)]
    got = sorted((r.node, r.cc) for r in streamed(spark, tmp_path, rows, lambda s: stages.capped_rows(s, "node", "t", 2)).collect())
    assert got == [("a", "0"), ("a", "1"), ("a", "x"), ("b", "y")]

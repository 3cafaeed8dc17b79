from __future__ import annotations

import gzip
import struct

import pytest
from pyspark.sql import functions as F

from idhealth.plans import metrics
from idhealth.sources import pcap, readers, sinks


def put(path, text):
    path.write_text(text)
    return str(path)


def test_summary_round_trip(spark, tmp_path):
    p = put(tmp_path / "s.csv", 'X_VERSION,0,0,7,\nCLASS,0,1,25,\n"LeakedTLD",1,HOME,3,\n')
    df = readers.read_summary(spark, p)
    assert {tuple(r)[:4] for r in df.collect()} == {("CLASS", 0, "1", 25), ("LeakedTLD", 1, "HOME", 3)}
    assert readers.versions(spark, p).first()["version"] == 7
    sinks.write_summary(df.coalesce(1), str(tmp_path / "out"), 7, "X_VERSION")
    assert {tuple(r)[:4] for r in readers.read_summary(spark, str(tmp_path / "out")).collect()} == {("CLASS", 0, "1", 25), ("LeakedTLD", 1, "HOME", 3)}


def test_broken_survey_file(spark, tmp_path):
    put(tmp_path / "good.json", '[{"Date": "x", "M5.1.1": 3, "M5.1.2": null}, {"M5.1.1": 4}]')
    put(tmp_path / "bad.json", '[{"M5.7.1": 12, "M5.7.2": null, "M5.7.10": 2}, {"M5.7.1": 13, "M5.')
    got = sorted((r.key, r.value) for r in readers.read_m5(spark, [str(tmp_path / "good.json"), str(tmp_path / "bad.json")]).collect())
    assert got == [("M5.1.1", 3.0), ("M5.1.1", 4.0), ("M5.7.1", 12.0), ("M5.7.1", 13.0), ("M5.7.10", 2.0)]


def test_metrics_latest_day_and_bad_dates(spark, tmp_path):
    put(tmp_path / "M7-2017-02-27.csv", "M7.1,2017-02-27,v2, , 0.5,\n")
    put(tmp_path / "M7-2017-02-28.csv", 'M7.1,2017-02-31,v2, , 0.25,\n"M7.3",2017-02-28,v2,8,0.75,\n\n')
    got = readers.read_metrics(spark, str(tmp_path)).collect()
    assert {(r.metric, str(r.date), r.key, r.value) for r in got} == {("M7.1", "None", "", 0.25), ("M7.3", "2017-02-28", "8", 0.75)}
    sinks.write_metrics(readers.read_metrics(spark, str(tmp_path)).where("date IS NOT NULL"), str(tmp_path / "o"))
    assert "M7.3,2017-02-28,v2, 8, 0.750000," in [r.value for r in spark.read.text(str(tmp_path / "o")).collect()]


def test_compliance_and_m1(spark, tmp_path):
    head = "title\n, , \nCategory, registrar_name, iana_id, Type, Domain Count, a, b, c, d, e, f, g\n"
    p = put(tmp_path / "c.csv", head + 'BULK, "A, LLC", 20, W, "1,000", 3, 8, 0, 0, 0, 0, 0\n, "B", 21, W, 2017-01, "3,000", 1, 2, 0, 0, 0, 0, 0\n')
    df = readers.read_compliance(spark, p)
    assert {(r.registrar, r.domain_count, r.first_notices) for r in df.collect()} == {("A, LLC", 1000, 8), ("B", 3000, 2)}
    assert {(r.metric, r.value) for r in metrics.m1(df).collect()} == {("M1.1", 2500.0), ("M1.2", 1.0), ("M1.3", 2.0), ("M1.4", 2.0)}


def test_abuse_layouts(spark, tmp_path):
    tlds = put(tmp_path / "t.csv", 'As of x\nTLD,TLD Type,Domains\n.FGH,gTLD,"6,789","21",0.32,2,3,4,5,1,1,0.1,9\n')
    regs = put(tmp_path / "r.csv", 'As of x\nRegistrar,IANA ID,Domains\n"A, LLC",146,"6,789","21",0.32,2,3,4,5,1,1,0.1,9\nRes,9999,10,1,0.1,1,1,1,1,1,1,0.1,9\n')
    old = put(tmp_path / "o.csv", "TLD,Domains\n\nABCD,678,21,0.32,2,3,4,5,1,1,0.1\n")
    assert [(r.name, r.kind, r.domains, r.botnet) for r in readers.read_abuse(spark, tlds, "tlds").collect()] == [("FGH", "gTLD", 6789, 5)]
    assert [(r.name, r.iana_id, r.spam) for r in readers.read_abuse(spark, regs, "registrars").collect()] == [("A, LLC", 146, 4)]
    assert [(r.name, r.domains, r.malware) for r in readers.read_abuse(spark, old, "old_tlds").collect()] == [("ABCD", 678, 3)]


def test_zone_and_m7(spark, tmp_path):
    p = put(tmp_path / "root.zone", "aaa. 172800 IN NS ns4.x.\naaa. 86400 IN DS 21707 8 2 AB\naaa. 86400 IN DS 1 13 2 AB\nfr. 172800 IN NS a.\n  continuation AB==\nx.fr. 1 IN NS a.\n")
    got = {(r.metric, r.key): r.value for r in metrics.m7(readers.read_zone(spark, p)).collect()}
    assert got == {("M7.1", ""): 0.5, ("M7.2", ""): 0.0, ("M7.3", "8"): 0.25, ("M7.3", "13"): 0.25}


def test_small_readers(spark, tmp_path):
    with gzip.open(tmp_path / "20190102-030405_300_n.csv.gz", "wt") as f:
        f.write("Address, TLD, nx_domain, name_type, min_delay, count, flags\n10.0.0.1,COM,0,tld,5,7,0\n")
    r = readers.read_address(spark, str(tmp_path / "20190102-030405_300_n.csv.gz")).first()
    assert (r.address, r["count"], str(r.slice.date)) == ("10.0.0.1", 7, "2019-01-02")
    p = put(tmp_path / "c", "ip,asn,frq,total\n1.1.1.1,5,0,9,1,2,3,4,5,6,7\n")
    assert [(r.ip, r.total, r.users) for r in readers.read_counts(spark, p).collect()] == [("1.1.1.1", 9, 0)]
    p = put(tmp_path / "s3", "address,cc\nn1,us,lax,2019-01-02,3,300,100,50,40,10,5," + ",".join("1" * 11) + ",9\n")
    assert [(r.address, r.queries, r.jumbo, r.other_names) for r in readers.read_sum3(spark, p).collect()] == [("n1", 100, 0, 9)]
    p = put(tmp_path / "bgp", "   x\n*> 1.0.0.0/24   1.2.3.4  0 100 200 13335 i\n*> 2.0.0.0/8 9.9.9.9 0 7 {8,9} i\n*  3.0.0.0/8 9.9.9.9 0 7 i\n")
    assert {tuple(r) for r in readers.read_bgp(spark, p).collect()} == {("1.0.0.0/24", 13335), ("2.0.0.0/8", 7)}
    p = put(tmp_path / "as", '<a href="/x">AS1   </a> LVLT-1, US\n<a>AS2</a> UDEL-DCN\n')
    assert {tuple(r) for r in readers.read_asnames(spark, p).collect()} == {(1, "LVLT-1", "US"), (2, "UDEL-DCN", "ZZ")}
    p = put(tmp_path / "reg", "Value,Name\n0,a\n5-7,b\nx,c\n")
    assert [r.key for r in readers.read_registry(spark, p, "t").orderBy("key").collect()] == [0, 5, 6, 7]
    p = put(tmp_path / "m5.json", '[{"Date": "x", "M5.1.1": 4, "M5.1.2": null},\n {"M5.1.1": 6}]')
    keys = spark.createDataFrame([("M5.1.1",), ("M5.1.2",)], "key string")
    assert {(r.metric, r.value) for r in metrics.m5(readers.read_m5(spark, p), keys).collect()} == {("M5.1.1", 5.0), ("M5.1.2", 0.0)}
    p = put(tmp_path / "addr", "# c\n10.0.0.1 # x\n\n")
    assert [r.address for r in readers.read_addresses(spark, p).collect()] == ["10.0.0.1"]
    old = spark.createDataFrame([("M1.1, 5,",), ("M3.1,COM,0.5",), ("M4.1,2018-01-31,v2, K, 0.25,",)], "value string")
    got = {tuple(r) for r in readers.upgrade_metric_rows(old, "2017-01-31", "v1").collect()}
    assert got == {("M1.1", "2017-01-31", "v1", "", 5.0), ("M3.1", "2017-01-31", "v1", "COM", 0.5), ("M4.1", "2018-01-31", "v2", "K", 0.25)}


def name(x):
    return b"".join(bytes([len(p)]) + p.encode() for p in x.split(".")) + b"\0"


def test_pcap(spark, tmp_path):
    question = name("www.Test") + struct.pack(">HH", 1, 1)
    answer = b"\xc0\x0c" + struct.pack(">HHIH", 1, 1, 60, 4) + b"\x01\x02\x03\x04"
    dns = struct.pack(">HHHHHH", 9, 0x8583, 1, 1, 0, 0) + question + answer
    broken = struct.pack(">HHHHHH", 9, 0x0100, 1, 0, 0, 0) + b"\x3fabc"
    out = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
    for i, (data, ports) in enumerate(((dns, (53, 4000)), (broken, (4000, 53)), (dns, (80, 4000)))):
        udp = struct.pack(">HHHH", *ports, 8 + len(data), 0) + data
        ip = struct.pack(">BBHHHBBH4s4s", 0x45, 0, 20 + len(udp), 0, 0, 64, 17, 0, bytes([10, 0, 0, 1]), bytes([10, 0, 0, 2])) + udp
        frame = b"\0" * 12 + b"\x08\0" + ip
        out += struct.pack("<IIII", 100 + i, 5, len(frame), len(frame)) + frame
    (tmp_path / "a.pcap").write_bytes(out)
    got = pcap.read_pcap(spark, str(tmp_path / "a.pcap")).orderBy("msg_no").collect()
    assert [(r.us, r.client, r.is_response, r.rcode, r.qname, r.n_answer, r.error) for r in got] == [(100_000_005, "10.0.0.2", True, 3, "www.Test", 1, False), (101_000_005, "10.0.0.1", False, 0, None, 0, True)]
    r = pcap.explode_records(pcap.read_pcap(spark, str(tmp_path / "a.pcap"))).select("name", "type", F.hex("rdata")).collect()
    assert [tuple(x) for x in r] == [("www.Test", 1, "01020304")]


def frame(data, ports, protocol=17, flags=0, source=1, six=False, fragment=0):
    body = struct.pack(">HHHH", *ports, 8 + len(data), 0) + data if protocol == 17 else struct.pack(">HHIIBBHHH", *ports, 0, 0, 5 << 4, flags, 0, 0, 0) + data
    if six:
        ip = struct.pack(">IHBB", 6 << 28, len(body), protocol, 64) + bytes(15) + bytes([source]) + bytes(15) + b"\2" + body
    else:
        ip = struct.pack(">BBHHHBBH4s4s", 0x45, 0, 20 + len(body), 0, fragment, 64, protocol, 0, bytes([10, 0, 0, source]), bytes([10, 0, 0, 99])) + body
    return b"\0" * 12 + (b"\x86\xdd" if six else b"\x08\0") + ip


def capture(frames, order="<"):
    out = struct.pack(order + "IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
    for i, f in enumerate(frames):
        out += struct.pack(order + "IIII", 1_700_000_000 + i, i % 1_000_000, len(f), len(f)) + f
    return out


@pytest.mark.parametrize("order", ["<", ">"])
def test_split_capture(spark, tmp_path, order):
    """A capture read in byte ranges gives the rows of the whole one, whatever the ranges cut; payloads that look like captures mislead nobody."""
    import random

    rng = random.Random(1)
    dns = lambda i: struct.pack(">HHHHHH", i & 0xFFFF, 0x8180, 1, 0, 0, 0) + name(f"n{i}.test") + struct.pack(">HH", 1, 1)
    inner = capture([frame(b"x" * 40, (1, 2)) for _ in range(10)], order)  # fewer heads than a chain has
    frames = []
    for i in range(3000):
        kind = rng.randrange(5)
        if kind < 3:
            frames.append(frame(dns(i), (53, 1000 + i % 7), six=kind == 2))
        else:
            frames.append(frame(inner if i % 500 == 3 else bytes(rng.randrange(256) for _ in range(rng.randrange(300))), (443, 2000), 6))
    (tmp_path / "c.pcap").write_bytes(capture(frames, order) + b"\1\2\3")  # a packet that is cut off
    path = str(tmp_path / "c.pcap")
    whole = sorted(tuple(r) for r in pcap.read_traffic(spark, path).collect())
    assert len(whole) == 3000
    for split in (7_001, 50_000, 1 << 20):
        df = pcap.read_traffic(spark, path, split)
        assert sorted(tuple(r) for r in df.collect()) == whole
        assert df.rdd.getNumPartitions() > 1 or split == 1 << 20
    messages = sorted((r.msg_no, r.qname, r.client) for r in pcap.read_pcap(spark, path).collect())
    assert sorted((r.msg_no, r.qname, r.client) for r in pcap.read_pcap(spark, path, split_bytes=9_999).collect()) == messages and len(messages) > 1500


def test_protocol_volumes(spark, tmp_path):
    from idhealth.operators.leaks import protocol_volumes

    frames = [frame(b"q" * 30, (4000, 53)), frame(b"t" * 11, (4000, 53), 6), frame(b"", (4000, 853), 6, 2), frame(b"", (4001, 853), 6, 2), frame(b"", (4000, 443), 6, 2, source=7), frame(b"d" * 9, (4000, 443), 6, 16, source=8), frame(b"e" * 5, (853, 9), 6, 18, source=9), frame(b"z", (1, 2), 6, 2), frame(b"f" * 8, (53, 5), fragment=0x2000), frame(b"g" * 8, (53, 5), fragment=5)]
    (tmp_path / "v.pcap").write_bytes(capture(frames))
    got = {(r["registry"], r["key"]): r["count"] for r in protocol_volumes(pcap.read_traffic(spark, str(tmp_path / "v.pcap"))).collect()}
    assert got == {("VOLUME_PER_PROTO", "0"): 38, ("VOLUME_PER_PROTO", "53"): 11, ("VOLUME_PER_PROTO", "853"): 5, ("VOLUME_PER_PROTO", "443"): 9, ("TCPSYN_PER_PROTO", "583"): 1, ("TCPSYN_PER_PROTO", "443"): 1, ("TCPSYN_PER_PROTO", "0"): 2}

from __future__ import annotations

import pytest
from .conftest import rows

from idhealth.sources import filelists, readers


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return f"file://{path}"


def test_lists_of_lists_in_three_layouts(spark, tmp_path):
    one = put(tmp_path / "in/a.csv", "CLASS,0,1,25,\n")
    two = put(tmp_path / "in/deep er/b.csv", "CLASS,0,1,5,\nRCODE,0,3,2,\n")
    zone = put(tmp_path / "in/root.zone", "aaa. 172800 IN NS ns4.x.\naaa. 86400 IN DS 21707 8 2 AB\n")
    resolvers = put(tmp_path / "in/x.addresses", "10.0.0.1\n# none\n")
    top = put(tmp_path / "top.txt", f"{one}\n\n  in/l1.txt \t\r\n{str(tmp_path)}/in/../in/./l2.txt\nempty.txt\n")
    put(tmp_path / "in/l1.txt", "deep er/b.csv\nl2.txt\n../top.txt\nl1.txt\n")  # names itself and the first list
    put(tmp_path / "in/l2.txt", "deep er/c.txt\n./root.zone\na.csv\n")
    put(tmp_path / "in/deep er/c.txt", "../x.addresses\n../a.csv\n../a.csv\n")
    put(tmp_path / "empty.txt", "\n \n")
    files = filelists.listed_files(spark, top)
    name = lambda p: p.removeprefix(f"file://{tmp_path}/")
    assert {(name(r.file), name(r.list), r.level) for r in files.collect()} == {
        ("in/a.csv", "top.txt", 0), ("in/deep er/b.csv", "in/l1.txt", 1), ("in/root.zone", "in/l2.txt", 1), ("in/a.csv", "in/l2.txt", 1), ("in/x.addresses", "in/deep er/c.txt", 2), ("in/a.csv", "in/deep er/c.txt", 2),
    }
    assert {two, zone, resolvers} <= {r.file for r in files.collect()}
    layouts = {"summary": (r"\.csv$", readers.read_summary), "zone": (r"\.zone$", readers.read_zone), "addresses": (r"\.addresses$", readers.read_addresses)}
    got = filelists.read_listed(spark, files, layouts)
    assert rows(got["summary"].groupBy("registry", "key").sum("count")) == [("CLASS", "1", 30), ("RCODE", "3", 2)]  # each file once
    assert rows(got["zone"]) == [("AAA", 8), ("AAA", None)] and rows(got["addresses"]) == [("10.0.0.1",)]
    with pytest.raises(ValueError, match="no layout"):
        filelists.read_listed(spark, files, {"zone": layouts["zone"]})


def test_resolved_names(spark):
    given = [("a", "hdfs://n:80/x/l.txt"), ("/a/../b", "hdfs://n:80/x/l.txt"), ("../../../a", "file:///x/l.txt"), ("s3a://k/a//b", "file:///x/l.txt"), ("file:/a", "hdfs://n/l.txt")]
    df = spark.createDataFrame(given, "name string, origin string")
    got = [r[0] for r in df.select(filelists.resolved(df.name, df.origin)).collect()]
    assert got == ["hdfs://n:80/x/a", "hdfs://n:80/b", "file:///a", "s3a://k/a/b", "file:///a"]


def test_abuse_names(spark):
    names = ["/x/2017-01-31_tlds.csv", "2017-02-28_registrars.csv", "/x/2017-feb-tlds.csv", "/x/2020-feb-tlds.csv", "/x/2018-dec-tlds.csv", "/x/2017-13-01_tlds.csv", "/x/2017-01-31-tlds.csv", "/x/other.csv", "/x/2017-02-30_tlds.csv"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    layout, date = filelists.abuse_name(df.path)
    got = [(a, str(b)) for a, b in df.select(layout, date).collect()]
    none = (None, "None")
    assert got == [("tlds", "2017-01-31"), ("registrars", "2017-02-28"), ("old_tlds", "2017-02-28"), ("old_tlds", "2020-02-28"), ("old_tlds", "2018-12-31"), none, none, none, none]


def test_abuse_files_of_all_layouts_in_one_scan(spark, tmp_path):
    put(tmp_path / "2017-01-31_tlds.csv", 'As of x\nTLD,TLD Type,Domains\n.FGH,gTLD,"6,789","21",0.32,2,3,4,5,1,1,0.1,9\n,gTLD,5,1,0.1,1,1,1,1,1,1,0.1,9\n')
    put(tmp_path / "2017-01-31_registrars.csv", 'As of x\nRegistrar,IANA ID,Domains\n"A, LLC",146,"6,789","21",0.32,2,3,4,5,1,1,0.1,9\nRes,9999,10,1,0.1,1,1,1,1,1,1,0.1,9\nNone,0,10,1,0.1,1,1,1,1,1,1,0.1,9\n')
    put(tmp_path / "2017-feb-tlds.csv", "TLD,Domains\n\nABCD,678,21,0.32,2,3,4,5,1,1,0.1\n")
    got = filelists.read_abuse_files(spark, str(tmp_path))
    assert rows(got.selectExpr("layout", "string(date)", "name", "kind", "iana_id", "domains", "phishing", "botnet")) == [
        ("old_tlds", "2017-02-28", "ABCD", None, None, 678, 2, 5), ("registrars", "2017-01-31", "A, LLC", None, 146, 6789, 2, 5), ("tlds", "2017-01-31", "FGH", "gTLD", None, 6789, 2, 5),
    ]
    for layout, file in (("tlds", "2017-01-31_tlds.csv"), ("registrars", "2017-01-31_registrars.csv"), ("old_tlds", "2017-feb-tlds.csv")):
        alone = readers.read_abuse(spark, str(tmp_path / file), layout)
        assert rows(alone) == rows(got.where(got.layout == layout).select(alone.columns))
    put(tmp_path / "other.csv", "x\n")
    with pytest.raises(Exception, match="no layout"):
        filelists.read_abuse_files(spark, str(tmp_path)).collect()

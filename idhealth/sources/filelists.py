"""Inputs named by lists: nested lists to a fixpoint, and files whose names tell layout and date."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import RESERVED_REGISTRARS, Paths, cells, lines, parse_double, parse_int
from .shared import stored

#: Names that are lists of names themselves.
LIST = r"\.txt$"

# fixed values: months in the names of old files
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


def resolved(name: Column, origin: Column) -> Column:
    """A name in a list as a full path: with a scheme as it is, from the root of the list's file system, or from the list's folder; . and .. are worked off."""
    root = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)"
    full = F.when(name.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:/"), name).when(name.startswith("/"), F.concat(F.regexp_extract(origin, root, 1), name)).otherwise(F.concat(F.regexp_replace(origin, "[^/]*$", ""), name))
    full = F.regexp_replace(full, r"^([A-Za-z][A-Za-z0-9+.-]*):/(?!/)", "$1:///")
    steps = F.split(F.regexp_replace(full, root, ""), "/")
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda a, x: F.when(x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).when(x.isin("", "."), a).otherwise(F.array_append(a, x)))
    return F.concat(F.regexp_extract(full, root, 1), F.lit("/"), F.array_join(kept, "/"))


def decoded(path: Column) -> Column:
    """The path that Spark tells of a row's file, as a name that it can be read by."""
    path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return resolved(path, path)


def listed_files(spark: SparkSession, path: Paths, lists: str = LIST) -> DataFrame:
    """(file, list, level): every input that a list names, or a list that such a list names, to any depth, with the list that names it.

    A line is a name; blank lines and white space at its ends don't count. Names are told apart as full paths; what matches
    `lists` is read as a list itself, once, so lists that name each other come to an end. A file that several lists name has
    a row for each, at the least level where a list does. Each level is one scan of its lists, kept as a table. Only the
    names of the lists themselves go through the driver, which hands them to Spark's reader.
    """
    frontier = [path] if isinstance(path, str) else list(path)
    named, seen, level = None, None, 0
    while frontier:
        own = lines(spark, frontier).select(F.trim(F.regexp_replace("value", r"[\t\r]", " ")).alias("name"), decoded(F.col("path")).alias("list")).where("name <> ''")
        own = stored(own.select(resolved(F.col("name"), F.col("list")).alias("file"), "list", F.lit(level).alias("level")).distinct(), "named")
        named = own if named is None else named.unionByName(own)
        # lists are given by name or folder at first, so those met already are known by their own lines
        met = own.select(F.col("list").alias("file")).union(own.where(F.col("file").rlike(lists)).select("file")).distinct()
        before = own.select(F.col("list").alias("file")) if seen is None else seen.union(own.select(F.col("list").alias("file")))
        frontier = [r.file for r in met.join(before.distinct(), "file", "left_anti").collect()]
        seen = stored(met if seen is None else seen.union(met).distinct(), "lists")
        level += 1
    return named.where(~F.col("file").rlike(lists)).groupBy("file", "list").agg(F.min("level").alias("level"))


def read_listed(spark: SparkSession, files: DataFrame, layouts: Mapping[str, tuple[str, Callable[[SparkSession, list[str]], DataFrame]]]) -> dict[str, DataFrame]:
    """Layout to the rows of its files: each layout is (pattern of names, reader) and reads all its files, each once, in one scan.

    The first pattern that fits counts. A name that none fits is an error, not left out; layouts without a file are absent.
    """
    layout = F.coalesce(*[F.when(F.col("file").rlike(pattern), F.lit(name)) for name, (pattern, _) in layouts.items()])
    by: dict[str, list[str]] = {}
    for r in files.select("file", layout.alias("layout")).distinct().orderBy("file").toLocalIterator():  # Spark's reader takes the names of its inputs from the driver
        if r.layout is None:
            raise ValueError(f"no layout for {r.file}")
        by.setdefault(r.layout, []).append(r.file)
    return {name: layouts[name][1](spark, names) for name, names in by.items()}


def abuse_name(path: Column) -> tuple[Column, Column]:
    """Layout and date that the name of an abuse file tells: yyyy-mm-dd_tlds.csv, yyyy-mm-dd_registrars.csv, or of old yyyy-mon-tlds.csv, which stands for the last day of its month (28 in February). Null for other names and days that can't be."""
    new, old = r"(?:^|/)(\d{4}-\d{2}-\d{2})_(tlds|registrars)\.csv$", rf"(?:^|/)(\d{{4}})-({'|'.join(MONTHS)})-tlds\.csv$"
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.regexp_extract(path, old, 2))
    first = F.try_to_date(F.concat_ws("-", F.regexp_extract(path, old, 1), month.cast("string"), F.lit("1")), "yyyy-M-d")
    last = F.when(month == 2, F.date_add(first, 27)).otherwise(F.last_day(first))
    date = F.when(path.rlike(new), F.try_to_date(F.nullif(F.regexp_extract(path, new, 1), F.lit("")), "yyyy-MM-dd")).when(path.rlike(old), last)
    layout = F.when(path.rlike(new), F.regexp_extract(path, new, 2)).when(path.rlike(old), F.lit("old_tlds"))
    return F.when(date.isNotNull(), layout), date


def read_abuse_files(spark: SparkSession, path: Paths) -> DataFrame:
    """Abuse counts of files of all layouts in one scan, by their names: layout, date, name, kind, iana_id, domains, abusive, score, phishing, malware, spam, botnet, path.

    Rows without a name or domains are left out, reserved registrars and those without an id too. A file whose name tells no layout is an error.
    """
    c = cells(spark, path, 13)
    layout, date = abuse_name(F.col("path"))
    c = c.withColumns({"date": date, "layout": F.coalesce(layout, F.raise_error(F.concat(F.lit("no layout in the name "), "path")))})
    old, registrar = F.col("layout") == "old_tlds", F.col("layout") == "registrars"
    at = lambda i: F.when(old, F.col(f"c{i + 1}")).otherwise(F.col(f"c{i + 2}"))
    names = ("domains", "abusive", "score", "phishing", "malware", "spam", "botnet")
    values = [(parse_double(at(i)) if k == "score" else F.coalesce(parse_int(at(i)), F.lit(0))).alias(k) for i, k in enumerate(names)]
    own = c.select("layout", "date", F.regexp_replace("c0", r"^\.", "").alias("name"), F.when(F.col("layout") == "tlds", F.col("c1")).alias("kind"), F.when(registrar, parse_int(F.col("c1"))).alias("iana_id"), *values, "path")
    return own.where((F.col("name") != "") & (F.col("domains") != 0) & (~registrar | (F.col("iana_id") > 0) & ~F.col("iana_id").isin(*RESERVED_REGISTRARS)))

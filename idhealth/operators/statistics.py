"""Descriptive statistics, regression, variance of ratios, histograms, segmentation, log studies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idhealth.sources.shared import stored

from .quantiles import with_order_statistics


def describe_by(df: DataFrame, segment: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(segment…, column, count, mean, std, min, q1, median, q3, max), quartiles exact and interpolated; null and NaN don't count.

    One pass sums up; the quartiles are found by refined histograms, so a segment with most rows is in no one's memory.
    """
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("x")
    values = df.select(*segment, long).select(*segment, "x.column", F.when(~F.isnan("x.v"), F.col("x.v")).alias("v"))
    summary = stored(values.groupBy(*segment, "column").agg(F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")), "described")
    at = lambda p: F.when(F.col("count") > 0, (F.col("count") - 1) * p)
    out = with_order_statistics(summary, values.where("v IS NOT NULL"), [*segment, "column"], {"q1": at(0.25), "median": at(0.5), "q3": at(0.75)})
    return out.select(*segment, "column", "count", "mean", "std", "min", "q1", "median", "q3", "max")


def corr_matrix(df: DataFrame, cols: Sequence[str], segment: Sequence[str] = ()) -> DataFrame:
    """(segment…, a, b, corr) for every pair of columns, in one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    wide = df.groupBy(*segment).agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    long = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])).alias("x")
    return wide.select(*segment, long).select(*segment, "x.*")


def linear_fit(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Adds prediction and residual of a least-squares fit. The normal equations are summed in one distributed pass; only len(xs)**2 sums go to the driver."""
    import numpy as np

    cols = [F.lit(1.0), *[F.col(x).cast("double") for x in xs]]
    k = len(cols)
    sums = df.agg(*[F.sum(cols[i] * cols[j]).alias(f"a{i}_{j}") for i in range(k) for j in range(i, k)], *[F.sum(cols[i] * F.col(y).cast("double")).alias(f"b{i}") for i in range(k)]).first()
    if sums["b0"] is None:
        return df.withColumns({"prediction": F.lit(None).cast("double"), "residual": F.lit(None).cast("double")})
    a = np.array([[sums[f"a{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], float)
    beta = np.linalg.lstsq(a, np.array([sums[f"b{i}"] for i in range(k)], float), rcond=None)[0]
    guess = sum((c * F.lit(float(b)) for c, b in zip(cols[1:], beta[1:], strict=True)), F.lit(float(beta[0])))
    return df.withColumn("prediction", guess).withColumn("residual", F.col(y) - F.col("prediction"))


def principal_components(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(component, variance_share, one loading per column) of the correlation matrix, whose entries are all that goes to the driver."""
    import numpy as np

    k = len(cols)
    row = df.agg(*[F.corr(cols[i], cols[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i + 1, k)]).first()
    m = np.eye(k)
    for i in range(k):
        for j in range(i + 1, k):
            m[i, j] = m[j, i] = row[f"c{i}_{j}"] or 0.0
    values, vectors = np.linalg.eigh(m)
    rows = []
    for n, i in enumerate(np.argsort(-values)):
        v = vectors[:, i] * (1 if vectors[np.argmax(np.abs(vectors[:, i])), i] >= 0 else -1)
        rows.append((n, float(values[i] / k), *map(float, v)))
    return df.sparkSession.createDataFrame(rows, "component int, variance_share double, " + ", ".join(f"`{c}` double" for c in cols))


def ratio_variance(df: DataFrame, group: Sequence[str], x: str, y: str) -> DataFrame:
    """Per group: ratio of means y/x, mean of ratios, and the variance of the ratio estimator by linearisation."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    s = df.groupBy(*group).agg(F.count("*").alias("n"), F.sum(a).alias("sx"), F.sum(b).alias("sy"), F.sum(a * a).alias("sxx"), F.sum(a * b).alias("sxy"), F.sum(b * b).alias("syy"), F.avg(F.try_divide(b, a)).alias("mean_of_ratios"))
    r = F.col("sy") / F.col("sx")
    rss = F.col("syy") - 2 * r * F.col("sxy") + r * r * F.col("sxx")
    mean = F.col("sx") / F.col("n")
    return s.select(*group, "n", r.alias("ratio_of_means"), "mean_of_ratios", (rss / (F.col("n") - 1) / F.col("n") / (mean * mean)).alias("variance"))


def log_bins(df: DataFrame, value: str, by: Sequence[str], bins: int = 20) -> DataFrame:
    """(by…, bin, count): positive values in `bins` bins of equal width in log10 between the least and greatest of all."""
    own = df.where(F.col(value) > 0).withColumn("log_", F.log10(value))
    span = own.agg(F.min("log_").alias("a"), F.max("log_").alias("b"))
    cell = F.when(F.col("b") > F.col("a"), F.floor((F.col("log_") - F.col("a")) / (F.col("b") - F.col("a")) * bins)).otherwise(0)
    return own.crossJoin(F.broadcast(span)).groupBy(*by, F.least(cell, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("count"))  # one row


def segment(df: DataFrame, rules: Mapping[str, Column], default: str) -> DataFrame:
    """Adds `segment`: the name of the first rule that holds."""
    name = F.lit(default)
    for k, c in reversed(rules.items()):
        name = F.when(c, F.lit(k)).otherwise(name)
    return df.withColumn("segment", name)


def mean_by_key(df: DataFrame, key: str, value: str, keys: DataFrame) -> DataFrame:
    """(key, mean): null values are skipped; keys without any have 0."""
    return keys.join(df.groupBy(key).agg(F.avg(value).alias("mean")), key, "left").fillna({"mean": 0.0})


def min_average_max(df: DataFrame, node: str, weight: str, parts: Sequence[str]) -> DataFrame:
    """(node, part, least, average, greatest) of part / weight; the average is weighted."""
    long = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("v")) for p in parts])).alias("x")
    ratio = F.try_divide(F.col("x.v").cast("double"), F.col(weight).cast("double"))
    return df.select(node, weight, long).groupBy(node, F.col("x.part").alias("part")).agg(F.min(ratio).alias("least"), F.try_divide(F.sum("x.v").cast("double"), F.sum(weight).cast("double")).alias("average"), F.max(ratio).alias("greatest"))


def good_slices(df: DataFrame, node: str, queries: str, duration: str, rate: float, total: float) -> DataFrame:
    """Slices with queries, at `rate` a second or more, of nodes with more than `total` queries in such slices."""
    ok = df.where((F.col(queries) > 0) & (F.col(queries) / F.col(duration) >= rate))
    return ok.withColumn("sum_", F.sum(queries).over(Window.partitionBy(node))).where(F.col("sum_") > total).drop("sum_")


def resolver_pivot(events: DataFrame, keys: Sequence[str], user: str, us: str, tag: str, isp: Sequence[str], delta_us: int = 500_000) -> DataFrame:
    """One row per keys and user: first_us, first_tag, near (tags seen within delta_us of the first time, sorted), has_isp, has_public."""
    by_tag = events.groupBy(*keys, user, tag).agg(F.min(us).alias("t"))
    by = by_tag.groupBy(*keys, user).agg(F.min("t").alias("first_us"), F.min(F.struct("t", F.col(tag).alias("tag"))).alias("f"), F.collect_list(F.struct("t", F.col(tag).alias("tag"))).alias("all"))
    near = F.array_sort(F.transform(F.filter("all", lambda x: x["t"] - F.col("first_us") <= delta_us), lambda x: x["tag"]))
    known = F.array(*[F.lit(x) for x in isp])
    return by.withColumn("near", near).select(*keys, user, "first_us", F.col("f.tag").alias("first_tag"), "near", F.arrays_overlap("near", known).alias("has_isp"), (F.size(F.array_except("near", known)) > 0).alias("has_public"))


def resolver_summary(pivot: DataFrame, keys: Sequence[str], tags: Sequence[str]) -> DataFrame:
    """Per keys: users, isp only, public only, both, and users by tag."""
    n = lambda c: F.sum(c.cast("long"))
    i, p = F.col("has_isp"), F.col("has_public")
    return pivot.groupBy(*keys).agg(F.count("*").alias("total"), n(i & ~p).alias("isp"), n(p & ~i).alias("public"), n(i & p).alias("both"), *[n(F.array_contains("near", t)).alias(t) for t in tags])


def attach_totals(df: DataFrame, outer: str, inner: str, count: str, top: int) -> DataFrame:
    """The rows of the `top` greatest outer keys and in each the `top` greatest inner keys, with both totals attached; one row per pair, that with the greatest count."""
    summed = df.groupBy(outer, inner).agg(F.sum(count).alias("inner_total"), F.max(count).alias("most"))
    totals = summed.groupBy(outer).agg(F.sum("inner_total").alias("outer_total"))
    best = totals.orderBy(F.col("outer_total").desc(), outer).limit(top)
    r = F.row_number().over(Window.partitionBy(outer).orderBy(F.col("inner_total").desc(), inner))
    return summed.join(F.broadcast(best), outer).withColumn("r_", r).where(F.col("r_") <= top).drop("r_")  # `top` rows


def zone_dnssec(records: DataFrame, zone: str, algo: str, is_short: Column) -> DataFrame:
    """(metric, key, value): share of zones with a DS record, of short ones, and each algorithm's share, where a zone's share is split among its algorithms."""
    by = records.groupBy(zone, is_short.alias("short_")).agg(F.count(algo).alias("n"))
    overall = by.agg(F.avg((F.col("n") > 0).cast("double")).alias("all"), F.avg(F.when(F.col("short_"), (F.col("n") > 0).cast("double"))).alias("short"), F.count("*").alias("zones"))
    rows = overall.select(F.explode(F.array(F.struct(F.lit("signed").alias("metric"), F.lit("all").alias("key"), F.col("all").alias("value")), F.struct(F.lit("signed").alias("metric"), F.lit("short").alias("key"), F.col("short").alias("value")))).alias("x")).select("x.*")
    split = records.where(F.col(algo).isNotNull()).groupBy(zone, algo).agg(F.count("*").alias("c")).join(by.select(zone, "n"), zone)
    algos = split.groupBy(F.col(algo).cast("string").alias("key")).agg(F.sum(F.col("c") / F.col("n")).alias("v")).crossJoin(F.broadcast(overall.select("zones")))  # one row
    return rows.unionByName(algos.select(F.lit("algorithm").alias("metric"), "key", (F.col("v") / F.col("zones")).alias("value")))

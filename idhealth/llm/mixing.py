"""Mixing sources to target weights by hash-threshold histograms (operator 8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import packed, read, small_side, split_words, written

#: Bits of a document's hash, and how many each histogram level resolves.
HASH_BITS, LEVEL_BITS = 52, 13


def doc_hash(doc_id: Column) -> Column:
    """52 bits of the MD5 of the id as text; stable between runs and engines."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 13), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """Adds `weight` and `target` to one row per source (source, source_size).

    Sources in code-point order, null last, get the weights in turn and share the sum of all sizes. A target
    stops at max_repeats times its source's size; the excess is reshared by weight until none is above. With
    r = cap / weight in rising order, the sources before the first one whose share of what is left fits are full.
    The windows run over one row per source, not over documents.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    s = sizes.withColumn("weight", F.get(cycle, rank % len(weights)).cast("long")).withColumn("cap", F.col("source_size") * max_repeats)
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, W.unboundedFollowing)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumns({"total": F.sum("source_size").over(everything), "full_cap": F.coalesce(F.sum("cap").over(before), F.lit(0)), "open_weight": F.sum("weight").over(after)})
    s = s.withColumn("level", (F.col("total") - F.col("full_cap")).cast("double") / F.col("open_weight"))
    fits = F.col("cap").cast("double") / F.col("weight") >= F.col("level")
    s = s.withColumn("open_level", F.min(F.when(fits, F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.coalesce(F.col("open_level"), F.lit(float("inf"))))
    return s.withColumn("target", target).select("source", "source_size", "weight", "target")


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the hash below which its documents sum up nearest to its budget.

    docs: source_key, h, size. budgets: source_key, rest (double). Each level sums by source and the next bits of the
    hash, keeps whole buckets while they fit, and goes on inside the one boundary bucket only. Documents of one hash
    stay together; the last such group is taken if the sum comes nearer to the budget with it than without.
    """
    state = budgets.withColumns({"low": F.lit(0).cast("long")})
    left = HASH_BITS
    while left > 0:
        take = min(LEVEL_BITS, left)
        left -= take
        width = 1 << left
        own = docs.join(state.select("source_key", "low", "rest"), "source_key")
        own = own.where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + F.lit(width << take)))
        bins = own.groupBy("source_key", F.shiftright("h", left).alias("bin")).agg(F.sum("size").alias("bin_size"), F.first("rest").alias("rest"))
        upto = F.sum("bin_size").over(W.partitionBy("source_key").orderBy("bin"))
        bins = bins.withColumn("upto", upto).where(F.col("upto") > F.col("rest"))
        edge = bins.groupBy("source_key").agg(F.min_by(F.struct("bin", "bin_size", "upto", "rest"), "bin").alias("e"))
        # a source that fits as a whole has no edge: its threshold is past every hash
        state = state.join(edge, "source_key", "left")
        before = F.col("e.upto") - F.col("e.bin_size")
        if left:
            low = F.when(F.col("e").isNull(), F.lit(1 << HASH_BITS)).otherwise(F.col("e.bin") * width)
        else:
            nearer = F.col("e.upto") - F.col("rest") < F.col("rest") - before
            low = F.when(F.col("e").isNull(), F.lit(1 << HASH_BITS)).otherwise(F.col("e.bin") + nearer.cast("long"))
        state = written(state.select("source_key", low.cast("long").alias("low"), F.when(F.col("e").isNull(), F.lit(0.0)).otherwise(F.col("rest") - before).alias("rest")), "mix-level")
    return state.select("source_key", F.col("low").alias("threshold"))


def word_count(text: Column) -> Column:
    """Runs of other than white space; null has none."""
    return F.size(split_words(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")).cast("long")


def source_key(source: Column) -> Column:
    """The source as a key without nulls."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))


def mix_plan(rows: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """One row per source of rows (source, source_key, size, h): source_key, source_size, target, epochs, threshold."""
    sizes = rows.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes, weights, max_repeats).withColumn("source_key", source_key(F.col("source")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = written(goal.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")
    limit = thresholds(rows.select("source_key", "h", "size"), goal.select("source_key", "rest"))
    return goal.join(limit, "source_key").select("source_key", "source_size", "target", "epochs", "threshold")


def taken() -> Column:
    """Words taken of a row with size, h and its source's plan."""
    return F.col("size") * (F.col("epochs") + (F.col("h") < F.col("threshold")).cast("long"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    A document's size is its number of runs of other than white space (null: 0). A source whose target is e whole
    sizes and a rest takes every document e times, and those below its hash threshold once more. No document is taken
    more than max_repeats times. The hash depends on the id only: reruns agree, and rows that share an id are taken
    alike. Empty table: no rows. A source without words has target 0. Columns besides these three are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), source_key(F.col(source)).alias("source_key"), word_count(F.col(text)).alias("size"), doc_hash(F.col(doc_id)).alias("h"))
    rows = written(rows, "mix-sizes")
    out = rows.join(small_side(written(mix_plan(rows, weights, max_repeats), "mix-plan")), "source_key")
    return out.select("doc_id", "source", "size", "source_size", "target", taken().alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """The rows of docs (doc_id, text, source and any other columns) that the mix takes, with mix_size and mix_taken (words, repeats counted).

    Columns of docs with these two names are replaced; nulls, repeats and an empty table as in mix.
    """
    cols = {"source_key": source_key(F.col("source")), "size": word_count(F.col("text")), "h": doc_hash(F.col("doc_id"))}
    rows = written(docs.select("source", *[c.alias(n) for n, c in cols.items()]), "mix-sizes")
    plan = small_side(written(mix_plan(rows, weights, max_repeats), "mix-plan"))
    d = packed(docs.drop("mix_size", "mix_taken"), **cols)
    return d.join(plan, "source_key").where(taken() > 0).select("row.*", F.col("size").alias("mix_size"), taken().alias("mix_taken"))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::BIGINT AS weight
  FROM d GROUP BY source),
c AS (
  SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / weight AS ratio FROM s),
l AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c),
t AS (
  SELECT source, source_size,
         least(cap::DOUBLE, weight * coalesce((SELECT arg_min(level, ratio) FROM l WHERE ratio >= level), 'inf'::DOUBLE)) AS target
  FROM l),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
b AS (
  SELECT d.source, d.h, sum(d.size)::BIGINT AS part FROM d GROUP BY ALL),
u AS (
  SELECT *, sum(part) OVER (PARTITION BY source ORDER BY h)::BIGINT AS upto FROM b),
k AS (
  SELECT u.source, u.h, upto <= target - epochs * source_size
         OR (upto - part <= target - epochs * source_size
             AND upto - (target - epochs * source_size) < target - epochs * source_size - (upto - part)) AS once_more
  FROM u JOIN g ON u.source IS NOT DISTINCT FROM g.source)
SELECT d.doc_id, d.size, g.source_size, g.target, (d.size * (g.epochs + k.once_more::BIGINT))::BIGINT AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
       JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.h = k.h
"""

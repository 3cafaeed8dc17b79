"""Benchmark decontamination by a prefix-filtered set join (operator 5). Native functions only.

A window is a set of word shingles. Containment of a whole window needs all its shingles, so the prefix that must be
joined is one shingle: the rarest in the corpus, which a count of the benchmark's shingles tells first. Its offset in the
window and the window's length bound where a document can hold the window. What is left is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import LOWER, SEPARATORS, UPPER, few_bytes, packed, read, small_side, split_words, text_key, text_of, unpacked, written

#: Words of a shingle; shorter windows have one shingle of all their words.
SHINGLE = 3
#: Benchmark shingles that may be broadcast (about 16 bytes each); more go by a shuffle join.
BROADCAST_SHINGLES = 1_000_000


def words(text: Column) -> Column:
    """Words after lower-casing A-Z only."""
    return split_words(F.translate(text, UPPER, LOWER), SEPARATORS)


def shingles(own: DataFrame, keep: Iterable[str], sizes: Iterable[int]) -> DataFrame:
    """keep, n (words of w), pos, k, g for each k consecutive words of w: array of words."""
    at = own.select(*keep, F.size("w").alias("n"), "w", F.posexplode_outer("w").alias("pos", "first")).where("pos IS NOT NULL")
    each = [F.when(F.col("pos") + k <= F.col("n"), F.struct(F.lit(k).alias("k"), F.xxhash64("first", *[F.get("w", F.col("pos") + j) for j in range(1, k)]).alias("g"))) for k in sizes]
    if len(each) == 1:
        return at.select(*keep, "n", "pos", each[0].alias("s")).where("s IS NOT NULL").select(*keep, "n", "pos", "s.k", "s.g")
    return at.select(*keep, "n", "pos", F.explode(F.array(*each)).alias("s")).where("s IS NOT NULL").select(*keep, "n", "pos", "s.k", "s.g")


def bench_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct windows: window_id, w (their words), n_w, items (ids as text)."""
    w = items.select(F.col(item_id).cast("string").alias("item_id"), words(text_of(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    each = w.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, window))).alias("w"))
    grouped = each.groupBy("w").agg(F.collect_set(F.coalesce("item_id", F.lit(""))).alias("items"))
    return grouped.select(F.xxhash64("w").alias("window_id"), "w", F.size("w").alias("n_w"), "items")


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and tkey (text_key of the text).

    n_hit counts the document's words inside any occurrence of a window of an item (window consecutive words; an item
    of fewer words, but not none, is one window). Null texts and texts without words have no hits, as has everything if
    there are no items. Rows equal in id and text are one case and get equal results; a null id is a value like others.
    An item id that is null counts as the empty string. Columns besides id and text are not read.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("tkey"), text_of(text).alias("text"))
    win = written(bench_windows(items, item_id, item_text, window).withColumn("k", F.least(F.lit(SHINGLE), F.col("n_w"))), "bench-windows")
    sizes = sorted(r["k"] for r in win.select("k").distinct().collect())  # SHINGLE rows at most
    wanted = written(shingles(win.withColumnRenamed("k", "size"), ["window_id", "n_w", "size"], sizes or [SHINGLE]).where("k = size").select("window_id", "n_w", "k", "g", F.col("pos").alias("j")), "bench-shingles")
    keys = written(wanted.select("k", "g").distinct(), "bench-keys")
    split = own.select("doc_id", "tkey", words(F.col("text")).alias("w"))
    seen = shingles(split, [], sizes or [SHINGLE]).select("k", "g").join(small_side(keys, BROADCAST_SHINGLES), ["k", "g"])
    rarity = written(seen.groupBy("k", "g").agg(F.count("*").alias("df")), "bench-rarity")
    # a window with a shingle that no document has occurs nowhere
    ranked = wanted.join(rarity, ["k", "g"], "left").withColumn("df", F.coalesce("df", F.lit(0)))
    prefix = ranked.groupBy("window_id", "n_w", "k").agg(F.min(F.struct("df", "g", "j")).alias("p")).where("p.df > 0")
    prefix = written(prefix.select("window_id", "n_w", "k", "p.g", "p.j"), "bench-prefixes")
    start = F.col("pos") - F.col("j")
    found = shingles(split, ["doc_id", "tkey"], sizes or [SHINGLE]).join(small_side(prefix, BROADCAST_SHINGLES), ["k", "g"])
    found = found.where((start >= 0) & (start + F.col("n_w") <= F.col("n"))).select("doc_id", "tkey", start.alias("s"), "window_id")
    found = written(found.distinct(), "bench-found")
    # Rows equal in id and text meet the same candidates: one of them is compared.
    asked = small_side(written(found.select(F.col("doc_id").alias("hit_id"), F.col("tkey").alias("hit_key")).distinct(), "bench-asked"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("tkey") == F.col("hit_key"))
    texts = own.join(asked, same, "left_semi").select("doc_id", "tkey", words(F.col("text")).alias("dw")).dropDuplicates(["doc_id", "tkey"])
    each = found.join(few_bytes(win.select("window_id", "w", "n_w", "items"), F.lit(16) * (F.size("w") + F.size("items"))), "window_id")
    each = each.groupBy(F.col("doc_id").alias("hit_id"), F.col("tkey").alias("hit_key")).agg(F.array_sort(F.collect_list(F.struct("s", "n_w", "w", "items"))).alias("c"))
    sure = texts.join(each, same).select("hit_id", "hit_key", F.filter("c", lambda x: F.slice(F.col("dw"), x["s"] + 1, x["n_w"]) == x["w"]).alias("c")).where(F.size("c") > 0)
    covered = F.aggregate(
        "c",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["s"] + x["n_w"] - F.greatest(a["end"], x["s"]))).alias("n"), F.greatest(a["end"], x["s"] + x["n_w"]).alias("end")),
        lambda a: a["n"],
    )
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform("c", lambda x: x["items"]))))
    sure = written(sure.select("hit_id", "hit_key", covered.alias("n_hit"), ids.alias("ids")), "bench-hits")
    sure = few_bytes(sure, F.lit(40) + F.lit(16) * F.size("ids"))
    full = own.select("doc_id", "tkey", F.size(words(F.col("text"))).cast("long").alias("n_words")).join(sure, same, "left")
    n_hit, ids = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("ids", F.array().cast("array<string>"))
    return full.select("doc_id", "tkey", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.encode(F.array_join(ids, ","), "UTF-8"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text and any other columns) in which no window of an item occurs; nulls, repeats and an empty table as in decontaminate."""
    hit = decontaminate(docs, items).where("contaminated").select(F.col("doc_id").alias("hit_id"), F.col("tkey").alias("hit_key")).distinct()
    hit = small_side(written(hit, "bench-hit"))
    rows = packed(docs, doc_id=F.col("doc_id"), tkey=text_key("text"))
    return unpacked(rows.join(hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("tkey") == F.col("hit_key")), "left_anti"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.drop("tkey")


OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
x AS (
  SELECT DISTINCT item_id, least(len(w), 10)::BIGINT AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT n FROM x),
p AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, n WHERE len(w) >= n)),
h AS (SELECT p.r, p.i, p.n, x.item_id FROM p JOIN x ON p.n = x.n AND p.g = x.g),
k AS (SELECT r, count(DISTINCT q)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS q FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
t AS (SELECT r, count(*)::BIGINT AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, '') AS item_id FROM h) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(k.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(k.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k ON d.r = k.r LEFT JOIN t ON d.r = t.r
"""

"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification (operator 6).

A band's bucket is compared with a leader; the few members unlike it with all others. Texts of buckets that hold many
unlike ones meet by their rarest shingles instead (prefix filtering), which is exact, and common base text costs nothing.

ProbMinHash (Ertl, "ProbMinHash - A Class of Locality-Sensitive Hash Algorithms for the (Probability) Jaccard
Similarity"): each weighted shingle starts a Poisson process of its weight's rate; each arrival falls on a signature
component; a component keeps its earliest arrival. A shingle stops as soon as its next arrival is later than all
components' earliest ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textflat as tf
from .base import distinct_texts, packed, read, small_side, text_of, unpacked, written
from .components import components

#: Words of a shingle and least similarity; bands and signature components in each (at 0.8, all bands miss 2 in 100,000).
SHINGLE, SIMILAR, BANDS, ROWS = 5, 0.8, 20, 4
#: Texts unlike the rest of a group up to which they meet all of it at once, and by how much that grows from round to round.
LOOSE, GROWTH = 8, 8


def weighted_shingles(column: pa.Array, by_count: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, distinct shingle hashes and their weights, by row.

    Every weight is 1, by which the probability Jaccard is the set Jaccard that links are judged by: a line that one of two
    texts repeats must not keep them from sharing a band. by_count weighs a shingle by 1 + ln of its count.
    """
    data, offsets = tf.flat(column)
    row, _, _, h = tf.words(data, offsets)
    g, grow = tf.shingles(h, row, len(column), SHINGLE)
    order = np.lexsort((g, grow))
    g, grow = g[order], grow[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (grow[1:] != grow[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(g)))
    return grow[at], g[at], 1 + np.log(count) if by_count else np.ones(len(at))


def prob_min_hash(row: np.ndarray, g: np.ndarray, weight: np.ndarray, rows: int, m: int) -> np.ndarray:
    """Signatures, rows x m: the shingle of each component's earliest arrival; 0 for rows without shingles."""
    earliest, who = np.full(rows * m, np.inf), np.zeros(rows * m, tf.U64)
    live, x, arrival = np.arange(len(g)), np.zeros(len(g)), 0
    has = np.bincount(row, minlength=rows) > 0
    while len(live):
        r = tf.mix(g[live] + tf.U64((arrival * 2 + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        x = x - np.log(((r >> tf.U64(11)).astype(np.float64) + 0.5) / (1 << 53)) / weight[live]
        cell = row[live] * m + (tf.mix(r + tf.U64(0x632BE59BD9B4E019)) % tf.U64(m)).astype(np.int64)
        np.minimum.at(earliest, cell, x)
        won = earliest[cell] == x
        who[cell[won]] = g[live[won]]
        latest = earliest.reshape(rows, m).max(axis=1)
        stay = x < latest[row[live]]
        live, x, arrival = live[stay], x[stay], arrival + 1
    out = who.reshape(rows, m)
    out[~has] = 0
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = signatures.reshape(len(signatures), bands, rows)
    key = np.zeros(parts.shape[:2], tf.U64) + np.arange(bands, dtype=tf.U64) * tf.U64(0x9E3779B97F4A7C15)
    for j in range(rows):
        key = tf.mix(key * tf.U64(0x2545F4914F6CDD1D) + parts[:, :, j])
    return key


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for c in tf.chunks(batch, "text"):
            n = c.num_rows
            row, g, w = weighted_shingles(c.column("text"))
            keys = band_keys(prob_min_hash(row, g, w, n, BANDS * ROWS), BANDS, ROWS)
            size = np.bincount(row, minlength=n)
            offsets = np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]).astype(np.int32)
            values = keys[size > 0].ravel().view(np.int64)
            yield pa.record_batch([c.column("doc_id"), c.column("digest"), pa.array(size.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["doc_id", "digest", "n", "bands"])


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for c in tf.chunks(batch, "text"):
            row, g, _ = weighted_shingles(c.column("text"))
            offsets = np.searchsorted(row, np.arange(c.num_rows + 1)).astype(np.int32)
            yield pa.record_batch([c.column("tid"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(g.view(np.int64)))], ["tid", "g"])


def similar(pairs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs (a, b, ga, gb) whose distinct shingles have a Jaccard similarity of SIMILAR or more."""
    for p in pairs:
        na, nb = (np.diff(tf_offsets(p.column(c))) for c in ("ga", "gb"))
        va, vb = (p.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("ga", "gb"))
        v = np.concatenate([va, vb])
        pair = np.concatenate([np.repeat(np.arange(p.num_rows), na), np.repeat(np.arange(p.num_rows), nb)])
        order = np.lexsort((v, pair))
        v, pair = v[order], pair[order]
        twice = (v[1:] == v[:-1]) & (pair[1:] == pair[:-1])
        common = np.bincount(pair[1:][twice], minlength=p.num_rows)
        ok = common >= SIMILAR * (na + nb - common) - 1e-9
        yield pa.record_batch([p.column("a").filter(pa.array(ok)), p.column("b").filter(pa.array(ok))], ["a", "b"])


def tf_offsets(column: pa.ListArray) -> np.ndarray:
    return column.offsets.to_numpy()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar. A much-used leader's rows are split by Spark's skew join."""
    both = pairs.join(sets.select(F.col("tid").alias("a"), F.col("g").alias("ga")), "a").join(sets.select(F.col("tid").alias("b"), F.col("g").alias("gb")), "b")
    return written(both.select("a", "b", "ga", "gb").mapInArrow(similar, "a long, b long"), "near-links")


def alike_sizes(n: str, m: str) -> Column:
    """Numbers of shingles that allow the similarity."""
    return F.least(n, m) >= SIMILAR * F.greatest(n, m) - 1e-9


def pair(x: str, y: str) -> list[Column]:
    return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]


def leader_links(cells: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For cells (cell, tid, n, pop): links with the buckets' leaders, pairs tried, and led (cell, tid, n, b: leader, same: linked to it or it)."""
    # the member that stands in most and largest buckets; of equal ones the least id
    lead = cells.groupBy("cell").agg(F.max(F.struct("pop", (-F.col("tid")).alias("b"), "n")).alias("top"))
    lead = written(lead.select("cell", (-F.col("top.b")).alias("b"), F.col("top.n").alias("bn")), "near-leaders")
    led = written(cells.join(small_side(lead), "cell").select("cell", "tid", "n", "b", "bn"), "near-led")
    tried = written(led.where((F.col("tid") != F.col("b")) & alike_sizes("n", "bn")).select(*pair("tid", "b")).distinct(), "near-tried")
    links = verified(tried, sets)
    linked = links.withColumn("linked", F.lit(True))
    marked = led.select("cell", "tid", "n", "b", *pair("tid", "b")[:1], F.least("tid", "b").alias("low")).join(linked.withColumnRenamed("b", "low"), ["a", "low"], "left")
    return links, tried, written(marked.select("cell", "tid", "n", "b", ((F.col("tid") == F.col("b")) | F.coalesce("linked", F.lit(False))).alias("same")), "near-marked")


def loose_links(led: DataFrame, tried: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of members unlike their leader with all others of their bucket, if they are few; the texts of the other buckets (tid)."""
    split = written(led.where("NOT same").groupBy("cell").agg(F.count("*").alias("loose")), "near-split")
    few, many = split.where(F.col("loose") <= LOOSE), split.where(F.col("loose") > LOOSE)
    loose = written(led.where("NOT same").join(small_side(few), "cell").select("cell", F.col("tid").alias("other"), F.col("n").alias("m")), "near-loose")  # LOOSE for a cell at most
    new = led.select("cell", "tid", "n").join(small_side(loose), "cell").where((F.col("tid") != F.col("other")) & alike_sizes("n", "m"))
    new = new.select(*pair("tid", "other")).distinct().join(tried, ["a", "b"], "left_anti")
    return verified(new, sets), written(led.join(small_side(many), "cell").select("tid").distinct(), "near-open")


def prefix_rows(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, tid, n, pos, short) for the rarest shingles of the texts (tid).

    Shingles are ordered by how many of the texts have them. A text x and one y that isn't shorter, similar by t, share a
    shingle among x's first |x| - ceil(2t / (1 + t) |x|) + 1 (short) and y's first |y| - ceil(t |y|) + 1 (Xiao et al.,
    "Efficient Similarity Joins for Near Duplicate Detection"). Shingles of one text only have their places, but no rows.
    """
    own = sets.join(small_side(texts), "tid", "left_semi").select("tid", F.size("g").alias("n"), F.explode("g").alias("g"))
    common = written(own.groupBy("g").agg(F.count("*").alias("df")).where("df > 1"), "near-common")
    lists = own.join(small_side(common), "g").groupBy("tid", "n").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("g"))
    long_, short = (F.col("n") - F.ceil(x * F.col("n") - 1e-9) + 1 for x in (SIMILAR, 2 * SIMILAR / (1 + SIMILAR)))
    lists = lists.withColumn("rare", F.col("n") - F.size("g")).withColumn("most", long_ - F.col("rare")).where("most > 0")
    rows = lists.select("tid", "n", "rare", short.alias("upto"), F.posexplode(F.slice("g", F.lit(1), F.col("most").cast("int"))).alias("i", "g"))
    pos = F.col("rare") + F.col("i")
    return written(rows.select(F.col("g.g").alias("key"), "tid", "n", pos.cast("int").alias("pos"), (pos < F.col("upto")).alias("short")), "near-prefixes")


def prefix_links(texts: DataFrame, tried: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """All links between different classes of the texts, besides the known ones.

    Texts that share a prefix shingle make a group. Where all of a group belongs to one class already, nothing is to be
    done. Else the members outside its largest class meet all others whose sizes and places allow the similarity: LOOSE
    of them at first; the links found merge classes, and what is then still apart goes on with GROWTH times as many,
    until no group is left.
    """
    rows, limit = prefix_rows(texts, sets), LOOSE
    while True:
        roots = components(links).withColumnRenamed("id", "tid")
        now = written(rows.join(roots, "tid", "left").withColumn("root", F.coalesce("root", "tid")), "near-rows")
        mixed = now.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.min(F.when(F.col("short"), F.col("n"))).alias("least")).where("r <> s AND least IS NOT NULL")
        mixed = written(mixed.select("key", "least"), "near-mixed")
        # a text whose first common shingle stands so far behind is like shorter ones only
        fits = F.col("short") | ((1 + 1 / SIMILAR) * (F.col("n") - F.col("pos")) - F.col("n") >= F.col("least") - 1e-6)
        now = written(now.join(small_side(mixed), "key").where(fits).drop("least"), "near-rows")
        by_class = now.groupBy("key", "root").agg(F.count("*").alias("c"))
        groups = by_class.groupBy("key").agg(F.sum("c").alias("all"), F.max(F.struct("c", "root")).alias("top"))
        groups = written(groups.select("key", F.col("top.root").alias("main"), (F.col("all") - F.col("top.c")).alias("others")).where("others > 0"), "near-groups")
        dealt = F.pmod(F.xxhash64("tid", F.lit(limit)), F.col("others")) < limit
        chosen = now.join(small_side(groups), "key").where((F.col("root") != F.col("main")) & dealt)
        chosen = written(chosen.select("key", *[F.col(c).alias(f"o_{c}") for c in ("tid", "n", "pos", "short", "root")]), "near-chosen")
        first, second = F.col("n") <= F.col("o_n"), F.col("n") >= F.col("o_n")  # which of the two is the one that isn't longer
        places = F.least(F.col("n") - F.col("pos"), F.col("o_n") - F.col("o_pos")) * (1 + SIMILAR) >= SIMILAR * (F.col("n") + F.col("o_n")) - 1e-6
        meet = (F.col("root") != F.col("o_root")) & alike_sizes("n", "o_n") & places & (first & F.col("short") | second & F.col("o_short"))
        new = now.join(small_side(chosen), "key").where(meet).select(*pair("tid", "o_tid")).distinct().join(tried, ["a", "b"], "left_anti")
        new = written(new, "near-tried")
        links, tried = links.union(verified(new, sets)), tried.union(new)
        left = written(groups.where(F.col("others") > limit).select("key"), "near-left")
        if not left.take(1):
            return links
        rows, limit = rows.join(small_side(left), "key", "left_semi"), limit * GROWTH


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, class_id (least doc_id of its class), is_kept, digest (MD5 of the text).

    Two texts are linked if they are equal or their sets of five-word shingles have a Jaccard similarity of 0.8 or more
    and a band of their signatures in common; a text of one to four words has one shingle, one without words equals only
    equal texts. Classes are the connected components of the links. A null text is empty. Ids are integers below 2**62; a
    null id makes a row of its own class (class_id null, kept). Rows that repeat an id are one document: of its texts each
    is compared, one row of the class's least id is kept (of its texts the one with the least digest, of rows equal in
    both any one). Empty table: no rows. Columns besides id and text are not read.

    Equal texts are reduced to one representative first. A bucket's members are compared with the one that stands in most
    and largest buckets (of equal ones the least id), and where up to LOOSE members are unlike it, these with all of them.
    Texts of other buckets go through prefix_links, which finds all links between their classes.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")).withColumn("digest", F.md5(F.encode("text", "UTF-8")))
    sig = written(base.where("doc_id IS NOT NULL").select("doc_id", "digest", "text").mapInArrow(signatures, "doc_id long, digest string, n int, bands array<long>"), "near-signatures")
    known = written(distinct_texts(sig), "near-known")
    cells = known.where("doc_id = rep").select("tid", "n", F.explode(F.array_distinct("bands")).alias("cell"))
    sizes = written(cells.groupBy("cell").agg(F.count("*").alias("members")).where("members > 1"), "near-sizes")
    cells = written(cells.join(small_side(sizes), "cell"), "near-cells")
    weight = written(cells.groupBy("tid").agg(F.sum("members").alias("pop")), "near-weights")
    cells = cells.select("cell", "tid", "n").join(small_side(weight), "tid")
    asked = known.where("doc_id = rep").join(small_side(weight), "tid", "left_semi").select("tid", "doc_id", "digest").dropDuplicates(["tid"])
    asked = small_side(written(asked, "near-asked"))
    sets = base.join(asked, ["doc_id", "digest"]).select("tid", "text").mapInArrow(shingle_sets, "tid long, g array<long>")
    sets = written(sets.dropDuplicates(["tid"]), "near-sets")
    links, tried, led = leader_links(cells, sets)
    more, open_ = loose_links(led, tried, sets)
    links = links.union(more)
    if open_.take(1):
        links = prefix_links(open_, tried, links, sets)
    # texts of one id belong together
    same = known.groupBy("doc_id").agg(F.min("tid").alias("a"), F.max("tid").alias("b")).where("a <> b").select("a", "b")
    roots = written(components(links.union(same)).withColumnRenamed("id", "tid"), "near-classes")
    out = known.select("doc_id", "digest", "tid").join(small_side(roots), "tid", "left").select("doc_id", F.coalesce("root", "tid").alias("class_id"), "digest")
    # a class's least id has the least text id too; of its rows the first by digest is kept
    first = Window.partitionBy("doc_id").orderBy("digest")
    out = out.withColumn("is_kept", (F.row_number().over(first) == 1) & (F.col("doc_id") == F.col("class_id"))).select("doc_id", "class_id", "is_kept", "digest")
    none = base.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(True).alias("is_kept"), "digest")
    return out.unionByName(none)


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text and any other columns) that near_duplicates keeps; nulls, repeats, ties and an empty table as there."""
    judged = written(near_duplicates(docs).where("doc_id IS NOT NULL").groupBy("doc_id", "digest").agg(F.max("is_kept").alias("stays"), F.count("*").alias("rows")), "near-judged")
    gone = small_side(written(judged.where(~F.col("stays")).select("doc_id", "digest"), "near-gone"))
    rows = packed(docs, doc_id=F.col("doc_id").cast("long"), digest=F.md5(F.encode(text_of("text"), "UTF-8")))
    left = rows.join(gone, ["doc_id", "digest"], "left_anti")
    if judged.where("rows > 1").take(1):
        left = left.where("doc_id IS NULL").unionByName(left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "digest"]))
    return unpacked(left)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).drop("digest")

"""Exact substring removal by range-partitioned, locally sorted suffixes (operator 4).

Only suffixes that start at anchors are sorted. Anchors are the least of the hashed GRAM-byte strings in every run of
LENGTH - GRAM + 1 of them, so each LENGTH-byte string has one, chosen from its own bytes: equal strings have theirs at the
same place. A string repeats only if SIDE bytes from its anchor on do, or SIDE bytes up to the end of its anchor's GRAM bytes:
it has one of them whole. This leaves few suffixes, whatever shorter phrases texts share. They are range-partitioned
by their leading tokens at sampled splitters, and sorted in each bucket, forwards from the anchor and backwards before
it, by multikey quicksort. The strings of two anchors with l bytes before them are equal if the suffixes share LENGTH - l
bytes forwards and l backwards: for each l, one pass over the two sorted orders finds all strings that occur twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import textflat as tf
from .base import few_bytes, read, small_side, text_of, written

#: Bytes of a string that must repeat, and of the strings whose hashes choose the anchors.
LENGTH, GRAM = 200, 48
#: Of any LENGTH bytes around GRAM bytes, as many lie from these on or up to their end.
SIDE = (LENGTH + GRAM) // 2
#: Bits for a place in the bytes worked on at once.
PLACE_BITS = 27
#: Rows that a bucket's sort holds at once. Equal leading tokens can't be split over buckets, so the strings of a group with more are counted one by one.
BUCKET_ROWS = 40_000
#: Groups that may be broadcast: two numbers each, about 40 MB as a hash relation.
BROADCAST_GROUPS = 1_000_000
#: place: the anchor's byte, then how far before it its strings start at most and at least, 8 bits each.
ANCHORS = "doc binary, h long, place long, right long, left long"
SUFFIXES = "doc binary, pos int, low int, high int, h long, lead binary, body binary, hot boolean"


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each anchor: row, place, first and last start of the strings whose anchor it is (all in `data`), hash; hashes of its two sides (0: none of its strings has this side)."""
    n, window = len(data), length - gram + 1
    if n < length:
        e = np.empty(0, np.int64)
        return e, e, e, e, *[np.empty(0, tf.U64)] * 3
    power, inverse = tf.powers(n + 1)
    sums = np.empty(n + 1, tf.U64)
    sums[0] = 0
    np.cumsum((data.astype(tf.U64) + tf.U64(1)) * power[:n], out=sums[1:])
    h = tf.mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    # 36 bits of hash and PLACE_BITS of place: the least value tells where it stands, the last one if hashes are equal
    m, mask = len(h), (1 << PLACE_BITS) - 1
    key = (h >> tf.U64(PLACE_BITS + 1)).astype(np.int64) << PLACE_BITS
    key |= mask - (np.arange(m) & mask)
    span = 1
    while span < window:
        step = min(span, window - span)
        key = np.minimum(key[:-step], key[step:])
        span += step
    start = np.arange(len(key))
    place = start + ((mask - (key & mask) - start) & mask)
    row = np.searchsorted(offsets, start, side="right") - 1
    inside = start + length <= offsets[row + 1]
    start, place, row = start[inside], place[inside], row[inside]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    row, place, low, high = row[first], place[first], start[first], start[last]
    side = (length + gram) // 2
    both = []
    for k, (begin, some) in enumerate([(place, place - high <= length - side), (place + gram - side, place - low >= side - gram)]):
        inside = some & (begin >= offsets[row]) & (begin + side <= offsets[row + 1])
        x = np.where(inside, begin, 0)
        x = tf.mix((sums[np.minimum(x + side, n)] - sums[x]) * inverse[x] + tf.U64(k))
        both.append(np.where(inside, np.maximum(x, tf.U64(1)), tf.U64(0)))
    return row, place, low, high, h[place], *both


#: Bytes of text whose anchors are found at once: each takes about 100 bytes meanwhile.
ANCHOR_BYTES = 1 << 18


def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for c in tf.chunks(batch, "text", ANCHOR_BYTES):
            data, offsets = tf.flat(c.column("text"))
            row, place, low, high, h, right, left = anchors(data, offsets, LENGTH, GRAM)
            doc = c.column("doc").take(pa.array(row))
            packed = (place - offsets[row]) << 16 | (place - low) << 8 | (place - high)
            yield pa.record_batch([doc, pa.array(h.view(np.int64)), pa.array(packed), *[pa.array(x.view(np.int64), mask=x == 0) for x in (right, left)]], ["doc", "h", "place", "right", "left"])


#: Anchors whose suffixes are copied at once, some 300 bytes each with an index of 8 bytes for each: a periodic text has an anchor for nearly every byte.
SLICE = 2048


def suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For (doc, text, a: array of (place, h, hot)): bytes low .. high + LENGTH of each anchor, some thousand anchors at a time."""
    for batch in batches:
        for c in tf.chunks(batch, "text"):
            data, offsets = tf.flat(c.column("text"))
            lists = c.column("a")
            rows = np.repeat(np.arange(c.num_rows), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            for k in range(0, len(rows), SLICE):
                row, part = rows[k : k + SLICE], flat.slice(k, SLICE)
                place = part.field("place").to_numpy(zero_copy_only=False).astype(np.int64)
                pos = place >> 16
                low, high = pos - (place >> 8 & 255), pos - (place & 255)
                size = high - low + LENGTH
                bounds = np.concatenate([[0], np.cumsum(size)])
                where = np.repeat(offsets[row] + low - bounds[:-1], size) + np.arange(bounds[-1])
                body = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data[where])])
                lead_at = (offsets[row] + pos)[:, None] + np.arange(16)
                lead = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(row), [None, pa.py_buffer(np.ascontiguousarray(data[lead_at]))]).cast(pa.binary())
                at = [pa.array(x.astype(np.int32)) for x in (pos, low, high)]
                yield pa.record_batch([c.column("doc").take(pa.array(row)), *at, part.field("h"), lead, body, part.field("hot")], ["doc", "pos", "low", "high", "h", "lead", "body", "hot"])


def multikey_order(token: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings given as rows of bytes (padded to whole 8-byte tokens), and of each the common bytes with the one before it in that order.

    Multikey quicksort: all strings are split by the first token, then only those that are still equal by the next one.
    """
    n = len(token)
    words = np.ascontiguousarray(token).view(">u8")
    order, group = np.arange(n), np.zeros(n, np.int64)
    open_ = np.arange(n)  # places in the order whose strings are not told apart yet
    for t in range(words.shape[1]):
        if not len(open_):
            break
        key = words[order[open_], t]
        sub = np.lexsort((key, group[open_]))
        order[open_] = order[open_][sub]
        key, g = key[sub], group[open_]
        new = np.ones(len(open_), bool)
        new[1:] = (key[1:] != key[:-1]) | (g[1:] != g[:-1])
        head = np.flatnonzero(new)
        group[open_] = open_[head][np.cumsum(new) - 1]
        size = np.diff(np.append(head, len(open_)))
        open_ = open_[np.repeat(size > 1, size)]
    common = np.zeros(n, np.int64)
    if n > 1:
        step = 20_000
        for a in range(1, n, step):
            x, y = token[order[a : a + step]], token[order[a - 1 : min(a + step, n) - 1]]
            differ = x != y
            common[a : a + step] = np.where(differ.any(axis=1), differ.argmax(axis=1), token.shape[1])
    return order, np.minimum(common, depth)


def repeated_spans(body: list[np.ndarray], pos: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per anchor the first and last start of a string that occurs at another anchor too (-1: none)."""
    n, reach = len(body), LENGTH - GRAM
    right, left = np.zeros((n, -(-LENGTH // 8) * 8), np.uint8), np.zeros((n, -(-reach // 8) * 8), np.uint8)
    for i in range(n):
        b, p = body[i], pos[i] - low[i]
        r = b[p : p + LENGTH]
        right[i, : len(r)] = r
        left[i, :p] = b[:p][::-1]
    ro, rc = multikey_order(right, LENGTH)
    lo, lc = multikey_order(left, reach)
    first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1, np.int64)
    before_most, before_least = pos - low, pos - high  # bytes before the anchor in its strings
    rg, lg = np.empty(n, np.int64), np.empty(n, np.int64)
    for l in range(reach + 1):
        live = np.flatnonzero((before_least <= l) & (l <= before_most))
        if len(live) < 2:
            continue
        rg[ro], lg[lo] = np.cumsum(rc < LENGTH - l), np.cumsum(lc < l)
        key = rg[live] * (n + 1) + lg[live]
        o = np.argsort(key, kind="stable")
        same = key[o][1:] == key[o][:-1]
        twice = np.zeros(len(live), bool)
        twice[o[1:][same]] = twice[o[:-1][same]] = True
        hit = live[twice]
        start = pos[hit] - l
        first[hit] = np.minimum(first[hit], start)
        last[hit] = np.maximum(last[hit], start)
    first[last < 0] = -1
    return first, last


def bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within one partition, ordered by leading token: whole groups of one GRAM-byte hash, BUCKET_ROWS and a group at a time."""

    def solve(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        data, offsets = tf.flat(t.column("body").combine_chunks())
        pos, low, high = (t.column(c).to_numpy().astype(np.int64) for c in ("pos", "low", "high"))
        first, last = repeated_spans([data[offsets[i] : offsets[i + 1]] for i in range(t.num_rows)], pos, low, high)
        some = np.flatnonzero(last >= 0)
        return pa.record_batch([t.column("doc").combine_chunks().take(pa.array(some)), pa.array(first[some].astype(np.int32)), pa.array((last[some] + LENGTH).astype(np.int32))], ["doc", "b", "e"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        while rows > BUCKET_ROWS:
            t = pa.Table.from_batches(held)
            h = t.column("h").to_numpy()
            change = np.flatnonzero(h[1:] != h[:-1]) + 1
            if not len(change):
                break  # one group so far
            cut = change[np.searchsorted(change, BUCKET_ROWS)] if change[-1] >= BUCKET_ROWS else change[-1]
            yield solve(t.slice(0, cut))
            held = t.slice(cut).to_batches()
            rows = t.num_rows - cut
            if rows <= BUCKET_ROWS or cut == change[-1]:
                break
    if rows:
        yield solve(pa.Table.from_batches(held))


def string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For anchors of hot groups: a row for each of their strings, with the 128-bit BLAKE2 digest of its bytes."""
    for batch in batches:
        for k in range(0, batch.num_rows, 2000):
            c = batch.slice(k, 2000)
            data, offsets = tf.flat(c.column("body"))
            raw = data.tobytes()
            low = c.column("low").to_numpy().astype(np.int64)
            count = np.diff(offsets) - LENGTH + 1
            row = np.repeat(np.arange(c.num_rows), count)
            within = np.arange(count.sum()) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
            digests = [hashlib.blake2b(raw[i : i + LENGTH], digest_size=16).digest() for i in (offsets[row] + within).tolist()]
            yield pa.record_batch([c.column("doc").take(pa.array(row)), pa.array((low[row] + within).astype(np.int32)), pa.array(digests, pa.binary())], ["doc", "s", "f"])


def cut_rows(keep_text: bool):
    """(…, text, spans: array of (b, e)) to what is left of each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in tf.chunks(batch, "text"):
                data, offsets = tf.flat(c.column("text"))
                lists = c.column("spans").fill_null([]) if c.column("spans").null_count else c.column("spans")
                begin = lists.offsets.to_numpy()
                flat = lists.flatten()
                b, e = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("b", "e"))
                whole = c.column("whole").to_numpy(zero_copy_only=False)
                raw = data.tobytes()
                n_bytes, removed, spans, digest, left = [], [], [], [], []
                for i in range(c.num_rows):
                    x = raw[offsets[i] : offsets[i + 1]]
                    if whole[i] and len(x) >= LENGTH:
                        runs = [(0, len(x))]
                    else:
                        runs = merge(b[begin[i] : begin[i + 1]], e[begin[i] : begin[i + 1]])
                    at, parts = 0, []
                    for s, t in runs:
                        parts.append(x[at:s])
                        at = t
                    kept = b"".join([*parts, x[at:]])
                    n_bytes.append(len(x))
                    removed.append(len(x) - len(kept))
                    spans.append(len(runs))
                    digest.append(hashlib.sha256(kept).hexdigest())
                    left.append(kept)
                if keep_text:
                    rest = {"row": c.column("row")}
                    # a character may lose some of its bytes: what is left of it goes as well
                    rest["text"] = pa.array([x.decode("utf-8", "ignore") if r else x.decode("utf-8") for x, r in zip(left, removed, strict=True)])
                    rest["n_removed"] = pa.array(removed, pa.int64())
                    yield pa.record_batch(list(rest.values()), list(rest))
                else:
                    yield pa.record_batch([c.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows


def merge(b: np.ndarray, e: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union; touching spans are one run."""
    out: list[tuple[int, int]] = []
    for i in np.argsort(b, kind="stable"):
        if out and b[i] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], int(e[i])))
        else:
            out.append((int(b[i]), int(e[i])))
    return out


def spans(docs: DataFrame) -> DataFrame:
    """(doc, spans array<struct<b,e>>, whole) for docs (doc: digest of the text, id: tells copies apart, text).

    Equal texts are compared once: `whole` marks those that have a copy, and only the one of the least id gives suffixes.
    Rows equal in id and text, which give them each, only repeat what is repeated anyway; so do copies without any id.
    """
    spark = docs.sparkSession
    # counted and written before it is joined: Spark can then split the rows of a text with very many copies
    copies = docs.select("doc", "id").groupBy("doc").agg(F.min("id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("doc", "rep")
    copies = written(copies, "suffix-copies")
    docs = docs.join(small_side(copies), "doc", "left").where("rep IS NULL OR id = rep").select("doc", "text")
    found = docs.mapInArrow(anchor_rows, ANCHORS)
    # rows of one document count too: a string may repeat within it
    side = F.explode(F.array_compact(F.array("right", "left"))).alias("side")
    groups = written(found.select(side).groupBy("side").agg(F.count("*").alias("n")).where("n > 1").select("side"), "suffix-groups")
    open_ = found.select("doc", "h", "place", side).join(small_side(groups, BROADCAST_GROUPS), "side").select("doc", "h", "place")
    open_ = written(open_, "suffix-open")  # an anchor both of whose sides repeat stands there twice
    large = written(open_.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_ROWS).select("h", F.lit(True).alias("hot")), "suffix-large")
    lists = open_.join(small_side(large), "h", "left").select("doc", F.struct("place", "h", F.coalesce("hot", F.lit(False)).alias("hot")).alias("a"))
    lists = lists.groupBy("doc").agg(F.collect_set("a").alias("a"))
    # written: texts are shuffled and cut once, for hot groups, the sample of the splitters and the buckets
    suffixes = written(docs.select("doc", "text").join(lists, "doc").mapInArrow(suffix_rows, SUFFIXES), "suffix-bodies")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # Spark samples the splitters; equal leading tokens and hashes meet in one bucket, so no match crosses a boundary
    buckets = suffixes.where("NOT hot").drop("hot").repartitionByRange(parts, "lead", "h").sortWithinPartitions("lead", "h")
    sorted_spans = buckets.mapInArrow(bucket_rows, "doc binary, b int, e int")
    strings = suffixes.where("hot").select("doc", "low", "body") if large.take(1) else suffixes.select("doc", "low", "body").where(F.lit(False))
    strings = written(strings.mapInArrow(string_rows, "doc binary, s int, f binary"), "suffix-strings")
    twice = small_side(written(strings.groupBy("f").agg(F.count("*").alias("n")).where("n > 1").select("f"), "suffix-twice"))  # written: Spark can then split a hot string
    hot_spans = strings.join(twice, "f").select("doc", F.col("s").alias("b"), (F.col("s") + LENGTH).alias("e")).distinct()
    all_spans = sorted_spans.unionByName(hot_spans)
    lists = all_spans.groupBy("doc").agg(F.collect_list(F.struct("b", "e")).alias("spans")).mapInArrow(merged_rows, "doc binary, spans array<struct<b:int,e:int>>")
    out = lists.join(copies.select("doc", F.lit(True).alias("whole")), "doc", "full_outer")
    # a text with copies goes as a whole: its spans need not be kept
    whole = F.coalesce("whole", F.lit(False))
    return written(out.select("doc", F.when(~whole, F.col("spans")).alias("spans"), whole.alias("whole")), "suffix-spans")


def merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, spans) with maximal runs."""
    kind = pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())]))
    for c in batches:
        lists = c.column("spans")
        begin, flat = lists.offsets.to_numpy(), lists.values
        b, e = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("b", "e"))
        runs = [[{"b": x, "e": y} for x, y in merge(b[i:j], e[i:j])] for i, j in zip(begin[:-1], begin[1:], strict=True)]
        yield pa.record_batch([c.column("doc"), pa.array(runs, kind)], ["doc", "spans"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False, counted: bool = True) -> DataFrame:
    """Removes every byte covered by a LENGTH-byte string that also starts anywhere else, in any document or the same one.

    Returns one row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with keep_text the columns of
    docs, text cut (bytes of a character that was cut in part go too), and, if counted, n_removed, which replaces a column
    of that name. Texts are UTF-8 bytes, whole ones of any length; null is empty. Texts shorter than LENGTH lose nothing.
    Overlapping repeats count; strings are judged on the input. Rows that repeat an id, or are equal in all, are documents
    of their own: equal texts are copies of each other, and no copy is preferred. Empty table: no rows. A document's spans
    are one row.
    """
    docs = docs.drop("n_removed") if keep_text and counted else docs
    digest = F.unhex(F.md5(F.encode(text_of(text), "UTF-8")))
    table = few_bytes(spans(docs.select(digest.alias("doc"), F.col(doc_id).alias("id"), text_of(text).alias("text"))), F.lit(40) + F.lit(8) * F.greatest(F.size("spans"), F.lit(0)))
    if keep_text:
        rest = [c for c in docs.columns if c != text]
        own = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), text_of(text).alias("text"), digest.alias("doc"))
        joined = own.join(table, "doc", "left").select("row", "text", "spans", F.coalesce("whole", F.lit(False)).alias("whole"))
        out = joined.mapInArrow(cut_rows(True), StructType([own.schema["row"], StructField("text", StringType()), StructField("n_removed", LongType())]))
        return out.select(*[F.col("text").alias(text) if c == text else F.col(f"row.`{c}`") for c in docs.columns], *["n_removed"] * counted)
    own = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"), digest.alias("doc"))
    joined = own.join(table, "doc", "left").select("doc_id", "text", "spans", F.coalesce("whole", F.lit(False)).alias("whole"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return joined.mapInArrow(cut_rows(False), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


#: Every string of LENGTH bytes by its MD5; texts are cut into blocks first, as taking a part of a long string is slow.
OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS x FROM documents),
j AS (SELECT r, x, length(x) // 2 AS n, unnest(range(0, length(x) // 2 - 199, 500)) AS j FROM d WHERE length(x) >= 400),
y AS (SELECT r, j, n, substr(x, 2 * j + 1, 1400) AS y FROM j),
w AS (SELECT r, j + i AS i, md5(substr(y, 2 * i + 1, 400)) AS h FROM (SELECT r, j, y, unnest(range(0, least(500, n - 199 - j))) AS i FROM y)),
t AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
s AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM w SEMI JOIN t ON w.h = t.h),
u AS (SELECT r, i, sum((before IS NULL OR i > before + 200)::INT) OVER (PARTITION BY r ORDER BY i) AS run FROM s),
g AS (SELECT r, run, min(i) AS b, max(i) + 200 AS e FROM u GROUP BY ALL),
p AS (SELECT r, b, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY b), 0) AS a FROM g),
k AS (SELECT r, count(*)::BIGINT AS n_spans, sum(e - b)::BIGINT AS n_removed, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY b) AS head, max(e) AS last FROM p JOIN d USING (r) GROUP BY r)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(CASE WHEN last IS NULL THEN x ELSE head || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

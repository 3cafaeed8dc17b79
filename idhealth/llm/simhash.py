"""SimHash near-duplicates by vantage-point trees (operator 12).

Fingerprints are 64-bit SimHashes of three-word shingles. A tree node has a vantage point v and a radius m: fingerprints
at a distance of m or less go inside, others outside. Two fingerprints within RADIUS bits of each other that m parts lie,
by the triangle inequality, at most RADIUS beyond it on the outer side; so what is outside by no more than RADIUS goes
inside too, and every pair is together in a leaf. Fingerprints are dealt to shards, each of which makes a tree of its own
in its task and compares within the leaves. Two fingerprints within RADIUS bits are equal in one of RADIUS + 1 fields; so
each goes to one range of values of every field, four rows however many there are, and every pair is together in a shard.
Of a dense ball of fingerprints only links that join it are found: what is reached already is not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textflat as tf
from .base import read, small_side, text_of, written
from .components import components

#: Words of a shingle, seed of its XXH64, and differing bits up to which fingerprints are linked.
SHINGLE, SEED, RADIUS = 3, 42, 3
#: Fields of 16 bits, of which two linked fingerprints have one in common.
FIELDS = RADIUS + 1
#: Fingerprints of the sample that the ranges of the fields are made from.
SAMPLE = 65_536
#: Fingerprints that a shard should have, and that a leaf of its tree compares at once.
SHARD, LEAF = 8192, 256
#: Vantage points tried for a node.
TRIED = 4
#: Shingles hashed at once: bounds the memory for a very long text.
BLOCK = 1 << 16

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def joined_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words, lower-cased A-Z, each with a space behind it; of every word its first byte and its end in them, and its row."""
    low = tf.lower(data)
    word = ~_SPACE[low]
    if not word.any():
        e = np.empty(0, np.int64)
        return low[:0], e, e, e
    last = word.copy()
    last[:-1] &= ~word[1:]
    filled = offsets[:-1] < offsets[1:]
    tails = offsets[1:][filled] - 1
    last[tails] = word[tails]
    at = np.flatnonzero(last)
    kept = np.cumsum(word)  # letters up to each byte
    ends = kept[at] + np.arange(len(at))
    out = np.full(int(kept[-1]) + len(at), 0x20, np.uint8)
    where = np.ones(len(out), bool)
    where[ends] = False
    out[where] = low[word]
    starts = np.concatenate([[0], ends[:-1] + 1])
    return out, starts, ends, np.searchsorted(offsets, at, side="right") - 1


def simhashes(column: pa.Array) -> np.ndarray:
    """The 64-bit SimHash of each text: a bit is 1 if it is in over half of the shingles' hashes."""
    data, offsets = tf.flat(column)
    rows = len(column)
    text, starts, ends, row = joined_words(data, offsets)
    count = np.bincount(row, minlength=rows)
    begin = np.concatenate([[0], np.cumsum(count)])
    # a shingle starts at every word that has SHINGLE - 1 more behind it, or at the first one of a short text
    index = np.arange(len(row)) - begin[row]
    first = np.flatnonzero((index + SHINGLE <= count[row]) | (index == 0))
    stop = ends[np.minimum(first + SHINGLE, begin[row[first] + 1]) - 1] if len(first) else first
    of = row[first]
    ones, n = np.zeros((rows, 64), np.int64), np.bincount(of, minlength=rows)
    body = memoryview(text)
    digest = xxhash.xxh64_intdigest
    for a in range(0, len(first), BLOCK):
        s, e, r = starts[first[a : a + BLOCK]].tolist(), stop[a : a + BLOCK].tolist(), of[a : a + BLOCK]
        h = np.fromiter((digest(body[i:j], SEED) for i, j in zip(s, e, strict=True)), np.uint64, len(s))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        head = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        for i, j in pairwise([*head.tolist(), len(r)]):
            ones[r[i]] += bits[i:j].sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").reshape(rows)


def fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for c in tf.chunks(batch, "text"):
            yield pa.record_batch([c.column("doc_id"), pa.array(simhashes(c.column("text")).view(np.int64))], ["doc_id", "fp"])


def distance(x: np.ndarray, v: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(x ^ v)


def best_split(x: np.ndarray) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that leave the fewest pairs to compare on both sides; None if none saves a tenth of them."""
    order = tf.mix(x)
    tried = x[np.argpartition(order, TRIED - 1)[:TRIED]] if len(x) > TRIED else x
    best, found = 0.9 * float(len(x)) ** 2, None
    for v in tried:
        upto = np.cumsum(np.bincount(distance(x, v), minlength=65 + RADIUS)).astype(float)
        cost = upto[RADIUS : 64 + RADIUS] ** 2 + (len(x) - upto[:64]) ** 2
        m = int(cost.argmin())
        if cost[m] < best:
            best, found = cost[m], (v, m)
    return found


def sides(x: np.ndarray, v: np.uint64, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in x of what goes inside and outside; within RADIUS beyond the radius both."""
    d = distance(x, v)
    return np.flatnonzero(d <= m + RADIUS), np.flatnonzero(d > m)


def fields(x: np.ndarray) -> np.ndarray:
    """The FIELDS parts of 16 bits of each fingerprint, a row each."""
    return np.stack([(x >> np.uint64(16 * i)).astype(np.uint16) for i in range(FIELDS)])


def field_bounds(sample: np.ndarray, shards: int) -> list[np.ndarray]:
    """Of each field the values at which its ranges begin, so that `shards` ranges hold about the same share of the sample."""
    at = np.arange(1, shards) * len(sample) // shards
    return [np.unique(np.sort(f)[at]) for f in fields(sample)]


def shard_rows(bounds: list[np.ndarray]):
    """(shard, fp): every fingerprint once for each field, with the range that its value lies in; once in all if there is one range only."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp")
            first = 0
            for field, cuts in zip(fields(fp.to_numpy().view(np.uint64)), bounds, strict=True):
                shard = first + np.searchsorted(cuts, field, "right")
                yield pa.record_batch([pa.array(shard.astype(np.int32)), fp], ["shard", "fp"])
                first += len(cuts) + 1
                if not any(map(len, bounds)):
                    break

    return deal


def joined(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (as places in x) that join all of x which is connected by distances up to RADIUS.

    A group goes on from what it reached last to what nothing has reached yet, so members of a ball are compared with what
    is outside the ball, but not with each other.
    """
    n = len(x)
    if n <= LEAF:
        near = distance(x[:, None], x[None, :]) <= RADIUS
        if near.sum() == n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        label = np.arange(n)
        while True:
            least = np.where(near, label[None, :], n).min(axis=1)
            if (least == label).all():
                break
            label = least
        at = np.flatnonzero(label != np.arange(n))
        return at, label[at]
    left, a, b = np.arange(n), [], []
    while len(left):
        start, left = left[0], left[1:]
        reached = [np.array([start])]
        while reached and len(left):
            now = reached.pop()
            hit = np.zeros(len(left), bool)
            for k in range(0, len(now), 64):
                rest = np.flatnonzero(~hit)
                hit[rest] |= (distance(x[now[k : k + 64], None], x[left[rest]][None, :]) <= RADIUS).any(axis=0)
            if hit.any():
                new = left[hit]
                a.append(new)
                b.append(np.full(len(new), start))
                left = left[~hit]
                reached.append(new)
    return np.concatenate([np.empty(0, np.int64), *a]), np.concatenate([np.empty(0, np.int64), *b])


def shard_links(table: pa.Table) -> pa.Table:
    """Links (a, b) that join all fingerprints of one shard that are connected within it: the rest of the tree, leaf by leaf."""
    found = []
    open_ = [table.column("fp").to_numpy().view(np.uint64)]
    while open_:
        x = open_.pop()
        split = best_split(x) if len(x) > LEAF else None
        if split is None:
            a, b = joined(x)
            found.append((x[a], x[b]))
        else:
            open_ += [x[i] for i in sides(x, *split)]
    a, b = (np.concatenate([np.empty(0, np.uint64), *[f[i] for f in found]]).view(np.int64) for i in (0, 1))
    return pa.table({"a": a, "b": b})


def near_fingerprints(fps: DataFrame) -> DataFrame:
    """(a, b) for a written table of distinct fingerprints (fp long): enough of the pairs within RADIUS bits to connect all that are connected.

    The ranges are made from the SAMPLE fingerprints of the least hashes; they decide how evenly the work is dealt, never what is found.
    """
    n = fps.count()
    sample = fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    shards = fps.select("fp").mapInArrow(shard_rows(field_bounds(sample, -(-n // SHARD))), "shard int, fp long")
    return written(shards.groupBy("shard").applyInArrow(shard_links, "a long, b long").distinct(), "simhash-links")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, fp (the fingerprint as a signed long), component_id.

    Words are runs of anything but ASCII white space; repeats of a shingle count each. A null text or one without words
    has fingerprint 0, which is linked like any other. component_id is the least doc_id that links reach, its own
    included; a row with a null id has a fingerprint and passes links on, but is the least id only if there is no other
    (then null). Rows that repeat an id or are equal keep their own rows. Texts of any length count as a whole. Empty
    table: no rows. Further columns are not read.
    """
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(f"`{text}`").alias("text"))
    own = written(own.mapInArrow(fingerprint_rows, "doc_id long, fp long"), "simhash-own")
    fps = written(own.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-fps")
    roots = small_side(written(components(near_fingerprints(fps)).withColumnRenamed("id", "fp"), "simhash-roots"))
    known = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    known = written(known, "simhash-known")
    tops = known.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("n")).where("n > 1").drop("n")
    shared = known.select("fp", "root").join(small_side(written(tops, "simhash-tops")), "root").select("fp", "component_id")
    # a fingerprint that only one row has, linked to none, needs no join
    return own.join(small_side(written(shared, "simhash-shared")), "fp", "left").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Ordinal cumulative-link quality classifier on hashed text (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textflat as tf
from .base import read, text_key, text_of, written

#: Weights are hashed into 2**BITS buckets. FIT_ROWS and FIT_BYTES bound the labelled documents that the fit reads, in order of their id's hash.
BITS, FIT_ROWS, FIT_BYTES = 19, 16_000, 128 << 20
#: Strength of the weights' quadratic penalty (for the whole sample), most steps of the fit, gradients it remembers.
DECAY, STEPS, MEMORY = 0.1, 50, 8
#: Beginnings of words, in bytes, that are features besides the words; value of any such feature, and of a step of shape.
PREFIXES, WORD_VALUE, SHAPE_VALUE = (4, 5), 0.3, 2.0
#: Grades: 0 toxic, 1 poor, 2 good.
GRADES = 3
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 2
_CLASS[[9, 10, 13, 32]] = 4


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, buckets and values: the distinct words and word beginnings of each text, and its shape (case, punctuation, repetition, lengths) in steps.

    Each counts once, however often it occurs and however long the text is: one word can decide. A text without words
    has its shape only; null counts as empty.
    """
    n = len(column)
    data, offsets = tf.flat(column)
    row, starts, ends, h = tf.words(data, offsets)
    mask = tf.U64((1 << BITS) - 1)
    total = np.bincount(row, minlength=n)
    distinct = np.bincount((np.unique((row.astype(tf.U64) << tf.U64(40)) | (h >> tf.U64(24))) >> tf.U64(40)).astype(np.int64), minlength=n)
    low = tf.lower(data)
    for size in PREFIXES:
        long = np.flatnonzero(ends - starts > size)
        row = np.concatenate([row, row[: len(starts)][long]])
        h = np.concatenate([h, tf.mix(tf.spans_hash(low, starts[long], starts[long] + size) + tf.U64(size))])
    key = np.unique((row.astype(tf.U64) << tf.U64(BITS)) | (h & mask))
    krow, kbucket = (key >> tf.U64(BITS)).astype(np.int64), (key & mask).astype(np.int64)
    kinds = np.empty((5, n))
    length = np.maximum(1, np.diff(offsets))
    kind = _CLASS[data]
    for c in range(5):
        sums = np.concatenate([[0], np.cumsum(kind == c)])
        kinds[c] = sums[offsets[1:]] - sums[offsets[:-1]]
    some = np.maximum(1, total)
    shape = np.stack([
        8 * kinds[1] / np.maximum(1, kinds[1] + kinds[2]),
        24 * kinds[0] / length,
        12 * kinds[3] / length,
        10 * distinct / some,
        np.log2(1 + total),
        np.log2(1 + kinds[1] + kinds[2]) - np.log2(1 + total),
    ])
    shape = np.minimum(31, np.round(2 * shape)).astype(np.int64)
    which = np.arange(len(shape))[:, None] * 32 + shape
    sbucket = (tf.mix(which.ravel().astype(tf.U64) + tf.U64(77)) & mask).astype(np.int64)
    srow = np.tile(np.arange(n), len(shape))
    value = np.concatenate([np.full(len(krow), WORD_VALUE), np.full(len(srow), SHAPE_VALUE)])
    return np.concatenate([krow, srow]), np.concatenate([kbucket, sbucket]), value


@dataclass
class OrdinalModel:
    """P(grade <= k) = 1 / (1 + exp(score - thresholds[k])); one weight vector for all grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, column: pa.Array) -> np.ndarray:
        row, bucket, value = features(column)
        return np.bincount(row, self.weights[bucket] * value, minlength=len(column))

    def tail(self, score: np.ndarray, grade: int) -> np.ndarray:
        """Probability of this grade or a better one."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[grade - 1] - score, -60, 60)))

    def expected(self, score: np.ndarray) -> np.ndarray:
        return sum(self.tail(score, k) for k in range(1, len(self.thresholds) + 1))


def likelihood(s: np.ndarray, y: np.ndarray, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood, and its gradients by each score and by each threshold."""
    cuts = np.concatenate([[-1e9], theta, [1e9]])
    upper, lower = 1 / (1 + np.exp(np.clip(s - cuts[y + 1], -60, 60))), 1 / (1 + np.exp(np.clip(s - cuts[y], -60, 60)))
    p = np.maximum(upper - lower, 1e-12)
    by_theta = [-(upper * (1 - upper) / p)[y == k].sum() + (lower * (1 - lower) / p)[y == k + 1].sum() for k in range(len(theta))]
    return -np.log(p).mean(), (1 - upper - lower) / len(s), np.array(by_theta) / len(s)


def minimize(loss, x: np.ndarray) -> np.ndarray:
    """L-BFGS with backtracking (Nocedal and Wright, "Numerical Optimization"); loss gives a value and its gradient."""
    f, g = loss(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        d, parts = -g, []
        for s, y in reversed(moves):
            parts.append((s @ d) / (s @ y))
            d = d - parts[-1] * y
        if moves:
            s, y = moves[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), part in zip(moves, reversed(parts), strict=True):
            d = d + s * (part - (y @ d) / (s @ y))
        step, slope = 1.0 if moves else 1 / max(1e-9, np.abs(g).sum()), g @ d
        while True:
            nx = x + step * d
            nf, ng = loss(nx)
            if nf <= f + 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        if (nx - x) @ (ng - g) > 1e-12:
            moves = [*moves, (nx - x, ng - g)][-MEMORY:]
        done = f - nf < 1e-6 * max(1.0, abs(f))
        x, f, g = nx, nf, ng
        if done:
            break
    return x


def fit_sample(texts: list[str], grades: np.ndarray) -> OrdinalModel:
    """Fits weights and thresholds together on the whole sample, so that equal samples give equal models.

    The penalty keeps words of few documents near 0. Grades that the sample lacks get a probability near 0.
    """
    rows, buckets, values, at = [], [], [], 0
    for c in tf.chunks(pa.record_batch([pa.array(texts, pa.large_string())], ["text"]), "text"):
        row, bucket, value = features(c.column("text"))
        rows.append((row + at).astype(np.int32))
        buckets.append(bucket.astype(np.int32))
        values.append(value.astype(np.float32))
        at += c.num_rows
    row, bucket, value = np.concatenate(rows), np.concatenate(buckets), np.concatenate(values)
    del rows, buckets, values
    known, bucket = np.unique(bucket, return_inverse=True)
    bucket = bucket.astype(np.int32)
    n, decay = len(texts), DECAY / len(texts)

    def cuts(x: np.ndarray) -> np.ndarray:
        """Thresholds: the first, then steps that are above 0."""
        return x[0] + np.concatenate([[0.0], np.cumsum(np.exp(x[1:]))])

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, t = x[: len(known)], x[len(known) :]
        f, ds, gt = likelihood(np.bincount(row, w[bucket] * value, minlength=n), grades, cuts(t))
        gw = np.bincount(bucket, ds[row] * value, minlength=len(known)) + decay * w
        steps = np.cumsum(gt[::-1])[::-1]
        steps[1:] = steps[1:] * np.exp(t[1:]) + 1e-3 * t[1:]
        return f + decay / 2 * (w @ w) + 5e-4 * (t[1:] @ t[1:]), np.concatenate([gw, steps])

    x = minimize(loss, np.concatenate([np.zeros(len(known)), [-1.0], np.zeros(GRADES - 2)]))
    weights = np.zeros(1 << BITS, np.float32)
    weights[known] = x[: len(known)]
    return OrdinalModel(weights, cuts(x[len(known) :]))


def sample(docs: DataFrame, labels: DataFrame, rows: int, size: int) -> DataFrame:
    """doc_id, grade, text of the labelled documents whose ids hash lowest: at most `rows`, with `size` bytes of text together.

    Ids and lengths are chosen first, so that no task ever holds more texts than that.
    """
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") <= 0, 1).when(F.col("quality") > 0, 2)
    graded = labels.select("doc_id", grade.alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    low = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    own = docs.select("doc_id", text_key("text").alias("tkey"), text_of("text").alias("text"))
    found = own.select("doc_id", "tkey", F.octet_length("text").alias("bytes")).join(F.broadcast(low), "doc_id").groupBy("doc_id", "tkey").agg(F.first("bytes").alias("bytes"), F.first("grade").alias("grade"))
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id", "tkey").limit(rows)
    upto = F.sum("bytes").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "tkey").rowsBetween(Window.unboundedPreceding, 0))  # `rows` ids at most
    chosen = written(found.withColumn("upto", upto).where(F.col("upto") <= size).select("doc_id", "tkey", "grade"), "fit-sample")
    return own.join(F.broadcast(chosen), ["doc_id", "tkey"]).dropDuplicates(["doc_id", "tkey"]).select("doc_id", "grade", "text")  # at most `rows` ids


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, size: int = FIT_BYTES) -> OrdinalModel:
    """Fits on the labelled documents of `sample`, in one task of that bounded size.

    A toxic document has grade 0 whatever its quality; repeated labels of a document count as their least grade, labels
    that are null in quality (and not toxic) are left out. Documents that share an id but not a text count each, rows
    equal in both count once. Without any labelled document (an empty table too) the model has no weights and calls
    everything good.
    """

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"])
        m = fit_sample(list(pdf["text"]), pdf["grade"].to_numpy(np.int64))
        used = np.flatnonzero(m.weights)
        cuts = pd.DataFrame({"k": -1 - np.arange(GRADES - 1), "v": m.thresholds})
        return pd.concat([pd.DataFrame({"k": used, "v": m.weights[used].astype(float)}), cuts])

    model = sample(docs, labels, rows, size).groupBy(F.lit("all").alias("all")).applyInPandas(train, "k long, v double").toPandas()  # 2**BITS rows at most
    weights, cuts = np.zeros(1 << BITS, np.float32), np.full(GRADES - 1, -4.0)
    at = model["k"].to_numpy()
    weights[at[at >= 0]] = model["v"].to_numpy()[at >= 0]
    cuts[-1 - at[at < 0]] = model["v"].to_numpy()[at < 0]
    return OrdinalModel(weights, cuts)


def classify(docs: DataFrame, model: OrdinalModel, min_tail: float = 0.7) -> DataFrame:
    """One row per row of docs: doc_id, score, expected_grade, p_good (probability of the best grade), keep (p_good >= min_tail).

    A null text counts as empty; a null id stays null; rows that repeat an id are judged each, equal texts alike. Empty
    table: no rows. Narrow: no shuffle. Columns besides doc_id and text are not read.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in tf.chunks(batch, "text"):
                s = model.score(c.column("text"))
                p = model.tail(s, GRADES - 1)
                yield pa.record_batch([c.column("doc_id"), pa.array(s), pa.array(model.expected(s)), pa.array(p), pa.array(p >= min_tail)], ["doc_id", "score", "expected_grade", "p_good", "keep"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, score double, expected_grade double, p_good double, keep boolean")


def select_good(docs: DataFrame, model: OrdinalModel, min_tail: float = 0.7) -> DataFrame:
    """The rows of docs that the model keeps, with all their columns, whatever their names; nulls, repeats and an empty table as in classify."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in tf.chunks(batch, "text"):
                yield c.filter(pa.array(model.tail(model.score(c.column("text")), GRADES - 1) >= min_tail))

    return docs.mapInArrow(rows, docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return classify(docs, fit(docs, read(spark, sf_dir, "labels")))

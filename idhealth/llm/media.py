"""Content-defined chunks of media payloads in a deduplicated store (operator 10).

A payload is kept as an 8-bit mono WAV file. Its bytes are cut where a rolling gear hash of the last 32 bytes has CUT
zero bits. Each task appends the chunks it has not written yet to one pack file in the shared folder and returns a row
per chunk. A Spark join by digest gives every chunk one place, of all packs that hold it; the ordered chunk list of a
document then reads its ranges, rebuilds the file and is verified against the digest of what was stored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textflat as tf
from .base import new_dir, read, text_key, text_of, written

#: Payloads are filled up to a positive multiple of BLOCK bytes with FILL.
BLOCK, FILL = 576, 255
#: Least and greatest bytes of a chunk, and zero bits that make a cut (about 2**CUT bytes on average).
LEAST, MOST, CUT = 512, 16_384, 11
RATE = 8000
_GEAR = (tf.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
REFS = "doc_id long, tkey long, n_bytes long, media_sha256 string, ord int, digest binary, size int, pack string, at long, packed int"


def wav(samples: bytes) -> bytes:
    """A RIFF file of 8-bit unsigned mono PCM samples; an even number of them needs no pad byte."""
    return b"RIFF" + struct.pack("<I", 36 + len(samples)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(samples)) + samples


def samples_of(media: bytes) -> bytes:
    """The samples of a file that wav() made, found by walking its chunks."""
    at = 12
    while media[at : at + 4] != b"data":
        at += 8 + struct.unpack_from("<I", media, at + 4)[0]
    n = struct.unpack_from("<I", media, at + 4)[0]
    return media[at + 8 : at + 8 + n]


def payload_of(text: bytes) -> bytes:
    return text + bytes([FILL]) * (max(BLOCK, -(-len(text) // BLOCK) * BLOCK) - len(text))


def cuts(media: np.ndarray) -> list[int]:
    """Ends of the chunks of one file. They depend on its bytes only, so an insertion moves the cuts next to it alone."""
    h = _GEAR[media]
    for step in (1, 2, 4, 8, 16):  # hash of the last 32 bytes, doubling
        if len(h) > step:
            shifted = h[:-step] << np.uint32(step)
            h = h.copy()
            h[step:] += shifted
    places = (np.flatnonzero((h >> np.uint32(32 - CUT)) == 0) + 1).tolist()
    out, begin, n, k = [], 0, len(media), 0
    while n - begin > LEAST:
        while k < len(places) and places[k] < begin + LEAST:
            k += 1
        end = min(places[k] if k < len(places) else n, begin + MOST, n)
        out.append(end)
        begin = end
    if begin < n:
        out.append(n)
    return out


def pack_rows(folder: str):
    """Writes one pack per task and gives a row per chunk. Every attempt has its own file; only those of finished tasks are referred to."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        name = f"{uuid.uuid4().hex}.pack"
        squeeze = zstandard.ZstdCompressor(level=3)
        seen: dict[bytes, tuple[int, int]] = {}
        at, out = 0, None
        try:
            for batch in batches:
                for c in tf.chunks(batch, "text"):
                    data, offsets = tf.flat(c.column("text"))
                    raw, cols = data.tobytes(), [[] for _ in range(10)]
                    ids, keys = c.column("doc_id").to_pylist(), c.column("tkey").to_pylist()
                    for i in range(c.num_rows):
                        media = wav(payload_of(raw[offsets[i] : offsets[i + 1]]))
                        whole, begin = hashlib.sha256(media).hexdigest(), 0
                        for k, end in enumerate(cuts(np.frombuffer(media, np.uint8))):
                            piece = media[begin:end]
                            digest = hashlib.sha256(piece).digest()
                            if digest not in seen:
                                if out is None:
                                    fs.create_dir(root, recursive=True)
                                    out = fs.open_output_stream(f"{root}/{name}")
                                packed = squeeze.compress(piece)
                                out.write(packed)
                                if len(seen) >= SEEN:
                                    seen.clear()  # a chunk may be written twice in a pack; the join picks one
                                seen[digest] = (at, len(packed))
                                at += len(packed)
                            place, size = seen[digest]
                            for col, v in zip(cols, (ids[i], keys[i], int(offsets[i + 1] - offsets[i]), whole, k, digest, end - begin, name, place, size), strict=True):
                                col.append(v)
                            begin = end
                    yield pa.record_batch([pa.array(v, t) for v, t in zip(cols, KINDS, strict=True)], NAMES)
        finally:
            if out is not None:
                out.close()

    return rows


#: Digests that a task remembers.
SEEN = 1_000_000
NAMES = [x.split()[0] for x in REFS.split(", ")]
KINDS = [{"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}[x.split()[1]] for x in REFS.split(", ")]


def rebuilt_rows(folder: str):
    """Reads the ranges of each document's chunk list, rebuilds its file, verifies it and describes it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        expand, files = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                parts = []
                for x in sorted(r["refs"], key=lambda x: x["ord"]):
                    if x["pack"] not in files:
                        if len(files) >= 64:
                            files.pop(next(iter(files))).close()
                        files[x["pack"]] = fs.open_input_file(f"{root}/{x['pack']}")
                    f = files[x["pack"]]
                    f.seek(x["at"])
                    piece = expand.decompress(f.read(x["packed"]), max_output_size=x["size"])
                    if hashlib.sha256(piece).digest() != x["digest"]:
                        raise ValueError(f"chunk {x['digest'].hex()} of {x['pack']} is damaged")
                    parts.append(piece)
                media = b"".join(parts)
                digest = hashlib.sha256(media).hexdigest()
                if digest != r["media_sha256"]:
                    raise ValueError(f"document {r['doc_id']} was not rebuilt as stored")
                payload = samples_of(media)
                level = np.frombuffer(payload, np.uint8)
                counts = np.bincount(level, minlength=256)
                share = counts[counts > 0] / len(level)
                feature = f"chunks={len(parts)};mean={level.mean():.4f};peak={int(level.max())};entropy={-(share * np.log2(share)).sum() + 0.0:.4f}"
                out.append((r["doc_id"], r["n_bytes"], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), digest, feature, r["tkey"]))
            cols = list(zip(*out, strict=True)) if out else [()] * 9
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], OUT_NAMES)

    return rows


OUT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tkey long"
OUT_NAMES = [x.split()[0] for x in OUT.split(", ")]


def store(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the packs of all texts into the folder; a written table of a row per document and chunk (REFS), each chunk at one place of all packs."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(text).alias("tkey"), text_of(text).alias("text"))
    refs = written(own.mapInArrow(pack_rows(folder), REFS), "media-refs")
    place = refs.groupBy("digest").agg(F.min(F.struct("pack", "at", "packed")).alias("place"))
    place = written(place, "media-places")  # written before it is joined: Spark can then split the rows of a very common chunk
    joined = refs.drop("pack", "at", "packed").join(place, "digest")
    return written(joined.select("doc_id", "tkey", "n_bytes", "media_sha256", "ord", "digest", "size", "place.pack", "place.at", "place.packed"), "media-lists")


def rebuild(refs: DataFrame, folder: str) -> DataFrame:
    """One row per document (id and text): its payload's and file's digests, as read back from the packs, and features.

    Rows equal in id and text are one document here. A chunk list is as long as its document.
    """
    lists = refs.dropDuplicates(["doc_id", "tkey", "ord"]).groupBy("doc_id", "tkey", "n_bytes", "media_sha256").agg(F.collect_list(F.struct("ord", "digest", "size", "pack", "at", "packed")).alias("refs"))
    return lists.mapInArrow(rebuilt_rows(folder), OUT)


def media_columns(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.

    A null text is empty: its payload is one block of FILL. A null id is a value like others. Equal texts give equal
    values. Rows equal in id and text are stored once and returned as often as they came. Empty table: no rows.
    Columns besides id and text are not read.
    """
    refs = store(docs, folder, doc_id, text)
    rows = refs.where("ord = 0").groupBy("doc_id", "tkey").agg(F.count("*").alias("n")).where("n > 1")
    out = rebuild(refs, folder).withColumnRenamed("doc_id", "d").withColumnRenamed("tkey", "t")
    out = out.join(rows, F.col("d").eqNullSafe(rows["doc_id"]) & (F.col("t") == rows["tkey"]), "left")
    times = F.explode(F.sequence(F.lit(1), F.coalesce("n", F.lit(1)).cast("int")))
    return out.select(F.col("d").alias("doc_id"), *[c for c in OUT_NAMES if c not in ("doc_id", "tkey")], times.alias("copy")).drop("copy")


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(read(spark, sf_dir, "documents"), new_dir(spark, "media-packs"))

"""WARC archives with a two-level capture index (operator 7).

Archives hold one gzip member per record. Captures are sorted by reversed-host URL keys and written in compressed blocks
of BLOCK lines; each index file ends in a sparse directory of its blocks' first keys. A lookup finds the index file
among the files' first keys, the block by binary search in its directory, the line in the block, and reads the record's
range of the archive.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import few_bytes, new_dir, read, text_of, written

#: Lines of an index block, and bytes after which a task starts another archive.
BLOCK, ROLL = 1000, 1 << 28
CAPTURES = "key string, page_id long, url string, record_type string, refers_to long, refers_key string, digest string, file string, at long, size int"


def url_key(url: Column) -> Column:
    """Host labels reversed and joined by commas, then ) and the rest in lower case; the scheme, port and fragment are left out. Null: empty."""
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^#]*)"
    u = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(u, parts, 1))
    return F.when(host == "", F.lower(u)).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.lower(F.regexp_extract(u, parts, 2))))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, digest: str, kind: str, refers_to, refers_url: str | None) -> bytes:
    """A WARC/1.1 record. A revisit has no payload, but names the record that has it."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        head.append(("WARC-Target-URI", json.dumps(url)[1:-1]))
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        if refers_url is not None:
            head.append(("WARC-Refers-To-Target-URI", json.dumps(refers_url)[1:-1]))
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    else:
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) for x in lines[1:])
    body = raw[end + 4 : end + 4 + int(head["Content-Length"])]
    return head, body[body.index(b"\r\n\r\n") + 4 :]


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def page_of(record_id: str) -> int | None:
    x = record_id[len("<urn:page:") : -1]
    return None if x == "None" else int(x)


def archive_rows(folder: str):
    """Writes the archives of one task and gives a capture per record. Every attempt writes files of its own names; only finished tasks' captures count."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        out, at, name = None, 0, ""
        try:
            for batch in batches:
                for k in range(0, batch.num_rows, 256):
                    got = []
                    for r in batch.slice(k, 256).to_pylist():
                        if out is None or at >= ROLL:
                            if out is not None:
                                out.close()
                            fs.create_dir(root, recursive=True)
                            name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                            out = fs.open_output_stream(f"{root}/{name}", compression=None)
                        payload = r["html"].encode()
                        digest = base32_sha1(payload)
                        kind = "response" if r["is_response"] else "revisit"
                        member = gzip_member(record(r["page_id"], r["url"], payload, digest, kind, r["first_id"], r["first_url"]))
                        out.write(member)
                        revisit = kind == "revisit"
                        got.append((r["key"], r["page_id"], r["url"], kind, r["first_id"] if revisit else None, r["first_key"] if revisit else None, digest, name, at, len(member)))
                        at += len(member)
                    cols = zip(*got, strict=True)
                    yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, CAPTURE_TYPES, strict=True)], CAPTURE_NAMES)
        finally:
            if out is not None:
                out.close()

    return rows


_TYPES = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
CAPTURE_NAMES = [x.split()[0] for x in CAPTURES.split(", ")]
CAPTURE_TYPES = [_TYPES[x.split()[1]] for x in CAPTURES.split(", ")]


def index_rows(folder: str):
    """Sorted captures of one partition to one index file; gives its name and first capture."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        out, at, held, directory, name = None, 0, [], [], f"{uuid.uuid4().hex}.cdx"

        def flush() -> None:
            nonlocal out, at
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            block = zlib.compress("\n".join(json.dumps([r[c] for c in INDEXED], ensure_ascii=False) for r in held).encode(), 6)
            directory.append([held[0]["key"], held[0]["page_id"], at, len(block)])
            out.write(block)
            at += len(block)
            held.clear()

        try:
            for batch in batches:
                for r in batch.to_pylist():
                    held.append(r)
                    if len(held) >= BLOCK:
                        flush()
            if held:
                flush()
            if out is not None:
                tail = zlib.compress(json.dumps(directory, ensure_ascii=False).encode(), 6)
                out.write(tail + struct.pack("<Q", len(tail)))
                yield pa.record_batch([pa.array([name]), pa.array([directory[0][0]]), pa.array([directory[0][1]], pa.int64())], ["index_file", "first_key", "first_id"])
        finally:
            if out is not None:
                out.close()

    return rows


INDEXED = ["key", "page_id", "file", "at", "size"]

Place = tuple[bytes, bool, int]


def place_of(key: str, page_id: int | None) -> Place:
    """Where a capture stands in the index: by key, then page_id, null first."""
    return key.encode(), page_id is not None, page_id or 0


class IndexFile:
    """One index file, opened at its directory; keeps the last block that was read."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        end = self.file.size()
        n = struct.unpack("<Q", self.range(end - 8, 8))[0]
        self.directory = json.loads(zlib.decompress(self.range(end - 8 - n, n)))
        self.firsts = [place_of(x[0], x[1]) for x in self.directory]
        self.block, self.lines, self.places = -1, [], []

    def range(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def find(self, place: Place) -> Iterator[list]:
        """Lines of a capture: from the last block that begins before it, on while blocks may hold it. However many captures a key has, no others are looked at."""
        b = max(0, bisect.bisect_left(self.firsts, place) - 1)
        while b < len(self.firsts) and self.firsts[b] <= place:
            if self.block != b:
                *_, at, size = self.directory[b]
                self.lines = [json.loads(x) for x in zlib.decompress(self.range(at, size)).decode().split("\n")]
                self.places, self.block = [place_of(x[0], x[1]) for x in self.lines], b
            i = bisect.bisect_left(self.places, place)
            while i < len(self.places) and self.places[i] == place:
                yield self.lines[i]
                i += 1
            b += 1


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, refers_key string"


def lookup_rows(archive: str, index: str):
    """For rows (index_files, key, page_id) ordered by key: the records that the index finds for them, read and verified."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, aroot), (ifs, iroot) = pafs.FileSystem.from_uri(archive), pafs.FileSystem.from_uri(index)
        opened: dict[str, IndexFile] = {}
        archives: dict = {}
        for batch in batches:
            got = []
            for r in batch.to_pylist():
                for name in r["index_files"]:
                    if name not in opened:
                        if len(opened) >= 8:
                            opened.pop(next(iter(opened))).file.close()
                        opened[name] = IndexFile(ifs, f"{iroot}/{name}")
                    for _, page_id, file, at, size in opened[name].find(place_of(r["key"], r["page_id"])):
                        if file not in archives:
                            if len(archives) >= 64:
                                archives.pop(next(iter(archives))).close()
                            archives[file] = fs.open_input_file(f"{aroot}/{file}")
                        archives[file].seek(at)
                        head, payload = parse(zlib.decompress(archives[file].read(size), 31))
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if head["WARC-Type"] == "response":
                            if base32_sha1(payload) != digest:
                                raise ValueError(f"record of page {page_id} is damaged")
                            got.append((page_id, len(payload), digest, "response", None, None))
                        else:
                            url = head.get("WARC-Refers-To-Target-URI")
                            got.append((page_id, None, digest, "revisit", page_of(head["WARC-Refers-To"]), None if url is None else json.loads(f'"{url}"')))
            cols = list(zip(*got, strict=True)) if got else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], [x.split()[0] for x in READ.split(", ")])

    return rows


def write_archives(pages: DataFrame, archive: str, min_bytes: int = 0) -> DataFrame:
    """A record per row of pages (page_id, url, html); the written captures. Of equal payloads of min_bytes or more the greatest (page_id, url) is the response."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", text_of("html").alias("html")).withColumn("key", url_key(F.col("url")))
    own = own.withColumn("sha", F.unhex(F.sha2(F.encode("html", "UTF-8"), 256)))
    heads = own.select("sha", "page_id", "url", "key").groupBy("sha").agg(F.max(F.struct("page_id", "url", "key")).alias("first"), F.count("*").alias("n"))
    # payloads of several pages only, written before they are joined: a very common one is then broadcast, or split by Spark
    heads = written(heads.where("n > 1").select("sha", "first"), "warc-heads")
    heads = few_bytes(heads, F.coalesce(F.octet_length("first.url") + F.octet_length("first.key"), F.lit(0)) + F.lit(60))
    big = F.octet_length("html") >= min_bytes
    same = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    joined = own.join(heads, "sha", "left").select("page_id", "url", "html", "key", (F.col("first").isNull() | ~big | same).alias("is_response"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), F.col("first.key").alias("first_key"))
    return written(joined.mapInArrow(archive_rows(archive), CAPTURES), "warc-captures")


def write_index(captures: DataFrame, index: str) -> DataFrame:
    """Writes the sorted index files; their written list (index_file, first_key, first_id): a row per partition."""
    parts = max(1, int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = captures.select(*INDEXED).repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id")
    return written(ordered.mapInArrow(index_rows(index), "index_file string, first_key string, first_id long"), "warc-index")


def lookup(keys: DataFrame, files: DataFrame, archive: str, index: str) -> DataFrame:
    """READ rows of the records that the index has for (key, page_id) rows.

    The index files' first captures (a row per index partition) go to every task; a key may run on from one file to the next.
    """
    heads = sorted((place_of(r["first_key"], r["first_id"]), r["index_file"]) for r in files.collect())  # a row per index partition
    firsts, names = [x[0] for x in heads], [x[1] for x in heads]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = []
            for key, page_id in zip(b.column("key").to_pylist(), b.column("page_id").to_pylist(), strict=True):
                k = place_of(key, page_id)
                lists.append(names[max(0, bisect.bisect_left(firsts, k) - 1) : bisect.bisect_right(firsts, k)])
            yield pa.record_batch([b.column("key"), b.column("page_id"), pa.array(lists, pa.list_(pa.string()))], ["key", "page_id", "index_files"])

    parts = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = keys.select("key", "page_id").repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id")
    placed = placed.mapInArrow(place, "key string, page_id long, index_files array<string>")
    return placed.mapInArrow(lookup_rows(archive, index), READ)


def archive_pages(pages: DataFrame, archive: str, index: str, min_bytes: int = 0) -> DataFrame:
    """Archives and indexes all pages and reads them back through the index.

    One row per row of pages: page_id, payload_bytes, payload_digest, record_type, refers_to. A null html is an empty
    payload, a null url an empty key, a null page_id a value like others. Of equal payloads the greatest (page_id, url) is
    the response; rows equal in id, url and payload are all alike (responses if they are the greatest). Empty table: no
    rows. Payloads of any length are one record. Further columns are not read.
    """
    captures = write_archives(pages, archive, min_bytes)
    files = write_index(captures, index)
    asked = captures.groupBy("key", "page_id").agg(F.count("*"))
    found = written(lookup(asked, files, archive, index), "warc-read")
    # a revisit has the payload of the record it refers to, which is looked up once for all its revisits
    revisits = found.where("record_type = 'revisit'").select("page_id", "payload_digest", "record_type", "refers_to", "refers_key")
    targets = revisits.select(url_key(F.col("refers_key")).alias("key"), F.col("refers_to").alias("page_id")).distinct()
    read_back = lookup(targets, files, archive, index).where("record_type = 'response'").select(F.col("payload_digest").alias("d"), F.col("page_id").alias("p"), F.col("payload_bytes").alias("payload_bytes")).distinct()
    full = revisits.join(read_back, (F.col("payload_digest") == F.col("d")) & F.col("refers_to").eqNullSafe(F.col("p")))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return found.where("record_type = 'response'").select(*cols).unionByName(full.select(*cols))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(read(spark, sf_dir, "pages"), new_dir(spark, "warc"), new_dir(spark, "warc-cdx"))


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM p
"""

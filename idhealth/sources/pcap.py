"""Packet captures to message and traffic rows: files, and byte ranges of long ones, are dealt out to tasks and decoded where they are read."""

from __future__ import annotations

import ipaddress
import itertools
import re
import struct
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = (
    "path string, msg_no long, us long, client string, server string, is_response boolean, opcode int, rcode int, flags int, qname string, qtype int, qclass int, "
    "n_answer int, n_authority int, n_additional int, rrs array<struct<section:string,name:string,type:int,class:int,ttl:long,rdata:binary>>, error boolean, size int"
)


def read_name(data: bytes, at: int) -> tuple[str, int]:
    """A name in text, and the place behind it; follows pointers backwards only."""
    parts, end, limit = [], -1, at
    while True:
        n = data[at]
        if n >= 0xC0:
            to = (n & 0x3F) << 8 | data[at + 1]
            if end < 0:
                end = at + 2
            if to >= limit:
                raise ValueError("pointer forwards")
            at = limit = to
        elif n == 0:
            return ".".join(parts), end if end >= 0 else at + 1
        elif n > 63 or at + 1 + n > len(data):
            raise ValueError("bad label")
        else:
            parts.append("".join(chr(b) if 0x21 <= b <= 0x7E and b not in b'.\\"' else f"\\{b:03d}" for b in data[at + 1 : at + 1 + n]))
            at += 1 + n


def read_message(data: bytes) -> dict:
    """The header, the first question and all records; error tells that it broke off."""
    ident, bits, *counts = struct.unpack_from(">HHHHHH", data)
    out = {"is_response": bits >= 0x8000, "opcode": bits >> 11 & 15, "rcode": bits & 15, "flags": bits >> 4 & 0x7F, "qname": None, "qtype": None, "qclass": None, "n_answer": counts[1], "n_authority": counts[2], "n_additional": counts[3], "rrs": [], "error": False}
    at = 12
    try:
        for i in range(counts[0]):
            name, at = read_name(data, at)
            kind = struct.unpack_from(">HH", data, at)
            at += 4
            if i == 0:
                out |= {"qname": name, "qtype": kind[0], "qclass": kind[1]}
        for section, n in zip(("answer", "authority", "additional"), counts[1:], strict=True):
            for _ in range(n):
                name, at = read_name(data, at)
                kind, klass, ttl, size = struct.unpack_from(">HHIH", data, at)
                at += 10
                if at + size > len(data):
                    raise ValueError("record too long")
                out["rrs"].append({"section": section, "name": name, "type": kind, "class": klass, "ttl": ttl, "rdata": data[at : at + size]})
                at += size
    except (ValueError, IndexError, struct.error):
        out["error"] = True
    return out


class Packet(NamedTuple):
    """An IP packet of a capture: its byte place in the file, time, ends, protocol (17 UDP, 6 TCP), and what it carries."""

    at: int
    us: int
    source: str
    target: str
    source_port: int
    target_port: int
    protocol: int
    size: int
    tcp_flags: int
    is_fragment: bool
    payload: bytes


class Layout(NamedTuple):
    """What a capture's head says: byte order, nanoseconds, link type, longest packet."""

    order: str
    nano: bool
    link: int
    snap: int


HEAD, PACKET_HEAD = 24, 16
#: Bytes of a capture that one task reads; longer files are split.
SPLIT_BYTES = 128 << 20
#: Packet heads that must follow each other from a place in the file to be taken for a packet's start, and bytes that hold them.
CHAIN, WINDOW = 32, 4 << 20
#: Seconds that packets of one file lie apart at most; only to tell a packet's head from other bytes.
SPAN = 400 * 86_400


def layout_of(head: bytes) -> Layout:
    magic = head[:4]
    order = "<" if magic in (b"\xd4\xc3\xb2\xa1", b"\x4d\x3c\xb2\xa1") else ">"
    snap, link = struct.unpack_from(order + "II", head, 16)
    return Layout(order, magic in (b"\x4d\x3c\xb2\xa1", b"\xa1\xb2\x3c\x4d"), link, snap or 1 << 18)


def decoded(at: int, us: int, frame: bytes, link: int) -> Packet | None:
    """The packet in a frame; None for what is neither UDP nor TCP over IP, or a later fragment."""
    if link == 1:
        kind, frame = frame[12:14], frame[14:]
        if kind == b"\x81\x00":
            frame = frame[4:]
    if len(frame) < 28:
        return None
    version, more = frame[0] >> 4, False
    if version == 4:
        part = struct.unpack_from(">H", frame, 6)[0]
        if part & 0x1FFF:
            return None
        more = bool(part & 0x2000)
        head, protocol, a, b = (frame[0] & 15) * 4, frame[9], frame[12:16], frame[16:20]
        size = struct.unpack_from(">H", frame, 2)[0] - head
    elif version == 6:
        head, protocol, a, b = 40, frame[6], frame[8:24], frame[24:40]
        size = struct.unpack_from(">H", frame, 4)[0]
    else:
        return None
    if protocol not in (6, 17) or len(frame) < head + (8 if protocol == 17 else 14):
        return None
    source, target = struct.unpack_from(">HH", frame, head)
    own = 8 if protocol == 17 else (frame[head + 12] >> 4) * 4
    flags = frame[head + 13] & 0x3F if protocol == 6 else 0
    return Packet(at, us, str(ipaddress.ip_address(a)), str(ipaddress.ip_address(b)), source, target, protocol, size - own, flags, more, frame[head + own :])


def starts(data: bytes, layout: Layout, first_sec: int, is_end: bool) -> int:
    """The first place in `data` from which CHAIN packet heads follow each other (or fewer up to the file's end); -1 if there is none."""
    n = len(data) - PACKET_HEAD + 1
    if n <= 0:
        return -1
    raw = np.frombuffer(data, np.uint8)
    word = lambda o: sum(raw[o + (i if layout.order == "<" else 3 - i) : o + (i if layout.order == "<" else 3 - i) + n].astype(np.int64) << (8 * i) for i in range(4))
    sec, frac, size, full = (word(o) for o in (0, 4, 8, 12))
    ok = (size <= layout.snap) & (full >= size) & (full <= 1 << 18) & (frac < (1_000_000_000 if layout.nano else 1_000_000)) & (np.abs(sec - first_sec) <= SPAN)
    for start in np.flatnonzero(ok).tolist():
        at, seen = start, 0
        while seen < CHAIN and at < n and ok[at]:
            at += PACKET_HEAD + int(size[at])
            seen += 1
        if seen == CHAIN or (is_end and seen and at >= n):
            return start
    return -1


def packets(read: Callable[[int, int], bytes], length: int, begin: int = 0, end: int | None = None) -> Iterator[Packet]:
    """The packets that start in bytes begin to end of a capture, given by read(place, bytes). A packet belongs to the range it starts in."""
    head = read(0, HEAD + PACKET_HEAD)
    if len(head) < HEAD + PACKET_HEAD:
        return
    layout = layout_of(head)
    first_sec = struct.unpack_from(layout.order + "I", head, HEAD)[0]
    end = length if end is None else min(end, length)
    at, data, base = max(begin, HEAD), b"", max(begin, HEAD)
    if begin > HEAD:
        while at < end:
            data = read(at, WINDOW)
            found = starts(data, layout, first_sec, at + len(data) >= length)
            if found >= 0:
                base, at = at, at + found
                break
            at += max(1, len(data) - WINDOW // 2)
        else:
            return
    while at < end:
        if at + PACKET_HEAD > base + len(data):
            base, data = at, read(at, WINDOW)
        if at + PACKET_HEAD > base + len(data):
            return
        sec, frac, size, _ = struct.unpack_from(layout.order + "IIII", data, at - base)
        to = at + PACKET_HEAD + size
        if to > base + len(data):
            base, data = at, read(at, max(WINDOW, PACKET_HEAD + size))
        p = decoded(at, sec * 1_000_000 + (frac // 1000 if layout.nano else frac), data[at - base + PACKET_HEAD : to - base], layout.link)
        if p:
            yield p
        at = to


def _opened(path: str) -> tuple[Callable[[int, int], bytes], int]:
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    f = store.open_input_file(name)
    return (lambda at, n: f.read_at(n, at)), f.size()


def _rows(spark: SparkSession, path: str, split_bytes: int, rows: Callable[[str, Iterator[Packet]], Iterator[tuple]], schema: str) -> DataFrame:
    """rows(path, packets) of all captures: small files whole, by Spark's reader; longer ones in byte ranges, which tasks read from the file system."""
    names = [c.strip().split()[0] for c in re.sub(r"<[^>]*>*", "", schema).split(",")]

    def frames(found: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        while part := list(itertools.islice(found, 5000)):
            yield pd.DataFrame(part, columns=names)

    def whole(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in files:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                data = bytes(content)
                yield from frames(rows(name, packets(lambda at, n, data=data: data[at : at + n], len(data))))

    def parts(ranges: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in ranges:
            for name, begin in zip(pdf["path"], pdf["begin"], strict=True):
                read, length = _opened(name)
                yield from frames(rows(name, packets(read, length, int(begin), int(begin) + split_bytes)))

    files = spark.read.format("binaryFile").load(path)
    out = files.where(F.col("length") <= split_bytes).select("path", "content").mapInPandas(whole, schema)
    ranges = files.where(F.col("length") > split_bytes).select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("begin"))
    n = ranges.count()  # lists files, reads none
    return out.unionAll(ranges.repartition(n).mapInPandas(parts, schema)) if n else out


def read_pcap(spark: SparkSession, path: str, port: int = 53, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A row per DNS message over UDP. client is the side whose port is not `port`; msg_no is the packet's byte place in the file.

    A capture longer than split_bytes is read by several tasks: each finds the first packet that starts in its range by a
    chain of plausible packet heads. First fragments are left out, as their message is not whole.
    """

    def messages(name: str, found: Iterator[Packet]) -> Iterator[tuple]:
        for p in found:
            if p.protocol != 17 or p.is_fragment or port not in (p.source_port, p.target_port) or len(p.payload) < 12:
                continue
            client, server = (p.target, p.source) if p.source_port == port else (p.source, p.target)
            m = read_message(p.payload)
            yield (name, p.at, p.us, client, server, *(m[c] for c in ("is_response", "opcode", "rcode", "flags", "qname", "qtype", "qclass", "n_answer", "n_authority", "n_additional", "rrs", "error")), len(p.payload))

    return _rows(spark, path, split_bytes, messages, MESSAGE)


TRAFFIC = "path string, at long, us long, protocol int, source string, target string, source_port int, target_port int, size long, tcp_flags int"


def read_traffic(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A row per UDP or TCP packet: ends, ports, bytes carried, TCP flags (0 for UDP)."""

    def traffic(name: str, found: Iterator[Packet]) -> Iterator[tuple]:
        return ((name, p.at, p.us, p.protocol, p.source, p.target, p.source_port, p.target_port, p.size, p.tcp_flags) for p in found)

    return _rows(spark, path, split_bytes, traffic, TRAFFIC)


def explode_records(messages: DataFrame) -> DataFrame:
    """A row per resource record."""
    return messages.select("path", "msg_no", "us", "client", "server", F.inline("rrs"))

"""Conversation prefix trie, rolled up by centroid decomposition (operator 11).

A conversation is the byte string of its turns' digests, so that conversations in byte order are the trie in preorder.
Distinct ones are range-partitioned in this order. A task builds the nodes of its range: those on its first and on its
last path may go on in other ranges and stay open, all others are whole and settled in the task. The open nodes of FAN
neighbouring ranges are merged in one task, again and again, until one range is left; a task never holds more than the
two outer paths of FAN ranges.

Settling adds up subtrees by centroid decomposition of the forest of parent edges: each component is split at its
centroid, what hangs at the centroid is added up and added to all nodes on the way from the centroid to the component's
top; the parts go on alone, each of half the size at most. All components of one level are split at once.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import few_bytes, read, small_side, written

#: Turns of the opening that a rebuilt conversation may take from the first one of its hundred.
OPENING, FAMILY = 5, 100
#: Bytes of a turn in a path: 16 of its digest, 4 with its number of code points.
STEP = 20
#: Bytes of paths that a range takes, most ranges (they get larger beyond), and ranges whose open nodes are merged at once.
RANGE_BYTES, RANGES, FAN = 1 << 18, 20_000, 64
#: Bytes of member ids hashed at once.
PIECE = 1 << 16

NODE = "range long, done boolean, side int, key binary, parent binary, depth long, chars long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NODES = pa.schema([("range", pa.int64()), ("done", pa.bool_()), ("side", pa.int32()), ("key", pa.binary()), ("parent", pa.binary()), *[(c, pa.int64()) for c in "depth chars conv_id parent_conv_id n_convs n_children n_leaves saved_tokens".split()], ("ends_sha256", pa.string())])
NO_ENDS = hashlib.sha256(b"").hexdigest()


def subtree_sizes(parent: np.ndarray) -> np.ndarray:
    """Nodes in each node's subtree, of a forest in preorder (-1: a top)."""
    size, up = [1] * len(parent), parent.tolist()
    for i in range(len(up) - 1, -1, -1):
        if up[i] >= 0:
            size[up[i]] += size[i]
    return np.array(size, np.int64)


def centroid_totals(parent: np.ndarray, sums: list[np.ndarray], least: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray | None]:
    """Totals of `sums`, and the least of `least`, over each node's subtree, in a forest given by parents in preorder (-1: a top)."""
    n = len(parent)
    size = subtree_sizes(parent)
    weight = size.copy()  # of what is left of a subtree within its component
    top = np.arange(n)
    heads = np.flatnonzero(parent < 0)
    if n:
        top = heads[np.searchsorted(heads, top, side="right") - 1]
    out, low = [np.zeros(n, np.int64) for _ in sums], None if least is None else least.copy()
    live = np.arange(n)
    while len(live):
        t = top[live]
        # nodes with half of their component or more below them form a way down from its top; the centroid is its end
        heavy = 2 * weight[live] >= weight[t]
        end = np.full(n, -1)
        np.maximum.at(end, t[heavy], live[heavy])
        c = end[t]
        below = (live >= c) & (live < c + size[c])
        path = (live <= c) & (c < live + size[live])
        for total, own in zip(out, sums, strict=True):
            part = np.zeros(n, np.int64)
            np.add.at(part, t[below], own[live[below]])
            total[live[path]] += part[t[path]]
        if low is not None:
            part = np.full(n, np.iinfo(np.int64).max)
            np.minimum.at(part, t[below], least[live[below]])
            low[live[path]] = np.minimum(low[live[path]], part[t[path]])
        above = path & (live < c)
        weight[live[above]] -= weight[c[above]]
        # what hangs below the centroid gets the centroid's child as its top
        under = below & (live > c)
        kids = live[under][parent[live[under]] == c[under]]
        if len(kids):
            order = np.sort(top[kids] * n + kids)
            top_of = order[np.searchsorted(order, t[under] * n + live[under], side="right") - 1] % n
            top[live[under]] = top_of
        live = live[live != c]
    return out, low


def settle(parent: np.ndarray, is_open: np.ndarray, v: dict[str, np.ndarray]) -> None:
    """Completes the nodes that aren't open, in place, and adds what hangs at open ones to these.

    parent in preorder; v: n_convs, chars (complete), and what settled children brought so far: n_children, n_leaves, saved_tokens.
    """
    done = np.flatnonzero(~is_open)
    place = np.full(len(parent) + 1, -1)
    place[done] = np.arange(len(done))
    up = parent[done]
    np.add.at(v["n_children"], up[up >= 0], 1)
    leaf = (v["n_children"][done] == 0).astype(np.int64)
    saved = (v["n_convs"][done] - 1) * v["chars"][done]
    (leaves, saved), _ = centroid_totals(place[up], [v["n_leaves"][done] + leaf, v["saved_tokens"][done] + saved])
    v["n_leaves"][done], v["saved_tokens"][done] = leaves, saved
    tops = (up >= 0) & (place[up] < 0)
    np.add.at(v["n_leaves"], up[tops], leaves[tops])
    np.add.at(v["saved_tokens"], up[tops], saved[tops])


def node_rows(range_: int, parent: np.ndarray, is_open: np.ndarray, side: np.ndarray, key: list, v: dict[str, np.ndarray], ends: list[str], parent_key: list | None = None) -> pa.RecordBatch:
    """Rows of NODE; a settled node whose parent is open has the parent's key instead of its least conversation."""
    known = (parent >= 0) & ~is_open[parent]
    above = [None if k or p < 0 else key[p] for k, p in zip(known.tolist(), parent.tolist(), strict=True)]
    if parent_key is not None:
        above = [a or (None if k else b) for a, b, k in zip(above, parent_key, known.tolist(), strict=True)]
    over = pa.array(v["conv_id"][parent], mask=~known)
    return pa.record_batch([pa.array(np.full(len(parent), range_)), pa.array(~is_open), pa.array(side.astype(np.int32)), pa.array(key, pa.binary()), pa.array(above, pa.binary()), *map(pa.array, (v["depth"], v["chars"], v["conv_id"])), over, *map(pa.array, (v["n_convs"], v["n_children"], v["n_leaves"], v["saved_tokens"])), pa.array(ends, pa.string())], schema=NODES)


def common_steps(x: bytes, y: bytes) -> int:
    m = min(len(x), len(y)) // STEP
    if not m or x[:STEP] != y[:STEP]:
        return 0
    differ = (np.frombuffer(x, np.uint8, m * STEP) != np.frombuffer(y, np.uint8, m * STEP)).reshape(m, STEP).any(axis=1)
    return int(differ.argmax()) if differ.any() else m


def range_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one range: (path, n, least, ends_sha256, range) in byte order of distinct paths."""
    parent, depth, chars, own, least, ends = [-1], [0], [0], [0], [np.iinfo(np.int64).max], [NO_ENDS]
    stack, before, first, range_ = [0], None, 0, 0
    for b in batches:
        for path, n, low, digest, range_ in zip(*(b.column(c).to_pylist() for c in ("path", "n", "least", "ends_sha256", "range")), strict=True):
            del stack[(common_steps(before, path) if before is not None else 0) + 1 :]
            for d in range(len(stack), len(path) // STEP + 1):
                parent.append(stack[-1])
                stack.append(len(depth))
                depth.append(d)
                chars.append(int.from_bytes(path[d * STEP - 4 : d * STEP]))
                own.append(0)
                least.append(np.iinfo(np.int64).max)
                ends.append(NO_ENDS)
            own[stack[-1]], least[stack[-1]], ends[stack[-1]] = n, low, digest
            if before is None:
                first, head = len(stack), path
            before = path
    if before is None:
        return
    m = len(parent)
    up = np.array(parent)
    side, key = np.zeros(m, np.int64), [None] * m
    for bit, nodes, path in ((1, range(first), head), (2, stack, before)):
        h = hashlib.md5(b"")
        for d, node in enumerate(nodes):
            h.update(path[(d - 1) * STEP : d * STEP] if d else b"")
            side[node] |= bit
            key[node] = h.digest()
    (convs,), low = centroid_totals(up, [np.array(own)], np.array(least))
    v = {"depth": np.array(depth), "chars": np.array(chars), "conv_id": low, "n_convs": convs} | {c: np.zeros(m, np.int64) for c in ("n_children", "n_leaves", "saved_tokens")}
    settle(up, side > 0, v)
    yield node_rows(range_, up, side > 0, side, key, v, ends)


def merged_ranges(last: bool) -> Callable[[pa.Table], pa.Table]:
    """Merges the open nodes of neighbouring ranges: equal ones become one; all that isn't on the outer paths is settled."""

    def merge(t: pa.Table) -> pa.Table:
        ranges = t.column("range").to_numpy()
        low, high = ranges.min(), ranges.max()
        columns = {c: t.column(c).to_pylist() for c in t.column_names}
        at: dict[bytes, int] = {}
        rows: list[dict] = []
        children: dict[int, list[int]] = defaultdict(list)
        for i in sorted(range(t.num_rows), key=columns["depth"].__getitem__):
            r = {c: x[i] for c, x in columns.items()}
            r["side"] = (r["side"] & 1 if r["range"] == low else 0) | (r["side"] & 2 if r["range"] == high else 0)
            j = at.setdefault(r["key"], len(rows))
            if j == len(rows):
                rows.append(r)
                if r["parent"] in at:
                    children[at[r["parent"]]].append(j)
                continue
            known = rows[j]
            known["side"] |= r["side"]
            known["conv_id"] = min(known["conv_id"], r["conv_id"])
            for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                known[c] += r[c]
            if r["ends_sha256"] != NO_ENDS:
                known["ends_sha256"] = r["ends_sha256"]
        order, up, open_ = [], [], [(0, -1)]
        while open_:  # preorder
            j, above = open_.pop()
            open_ += [(k, len(order)) for k in children[j]]
            order.append(rows[j])
            up.append(above)
        parent = np.array(up)
        side = np.array([0 if last else r["side"] for r in order])
        v = {c: np.array([r[c] for r in order], np.int64) for c in ("depth", "chars", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")}
        settle(parent, side > 0, v)
        g = columns["group"][0]
        return pa.Table.from_batches([node_rows(g, parent, side > 0, side, [r["key"] for r in order], v, [r["ends_sha256"] for r in order])])

    return merge


def id_pieces(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(node, first, piece): comma-joined ids, up to `most` bytes, of rows sorted by (node, conv_id); a node with very many ids makes many."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size = None, [], 0
        for b in batches:
            done: list[tuple[bytes, int, str]] = []
            for k, c in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
                if ids and (k != node or size > most):
                    done.append((node, ids[0], ",".join(map(str, ids))))
                    ids, size = [], 0
                node = k
                ids.append(c)
                size += 12
            if done:
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*done, strict=True), (pa.binary(), pa.int64(), pa.string()), strict=True)], ["node", "first", "piece"])
        if ids:
            yield pa.record_batch([pa.array([node], pa.binary()), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])], ["node", "first", "piece"])

    return joined


def piece_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends_sha256) of pieces sorted by (node, first), one after the other: a hash is sequential, but needs one piece at a time."""
    node, h = None, None
    for b in batches:
        nodes, hashes = [], []
        for k, piece in zip(b.column("node").to_pylist(), b.column("piece"), strict=True):
            if k != node:
                if h is not None:
                    nodes.append(node)
                    hashes.append(h.hexdigest())
                node, h = k, hashlib.sha256()
            else:
                h.update(b",")
            h.update(piece.as_py().encode())
        if nodes:
            yield pa.record_batch([pa.array(nodes, pa.binary()), pa.array(hashes)], ["node", "ends_sha256"])
    if h is not None:
        yield pa.record_batch([pa.array([node], pa.binary()), pa.array([h.hexdigest()])], ["node", "ends_sha256"])


def member_hashes(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256) for written (node, conv_id): SHA-256 of the ids in ascending order, comma-joined.

    One node may have most ids: they are sorted over partitions and joined to pieces there, so that the task which hashes a node reads few rows.
    """
    parts = max(1, ceil(paths.count() / 50_000))
    pieces = paths.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(id_pieces(PIECE), "node binary, first long, piece string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(piece_hashes, "node binary, ends_sha256 string")


def rebuilt_paths(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, path) of every conversation, with its opening taken from the first conversation of its hundred."""
    said = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text)]
    digest = F.md5(F.encode(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said), "UTF-8"))
    step = F.concat(digest, F.lpad(F.hex(F.char_length(said[1]).cast("long")), 8, "0"))
    own = turns.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.struct(F.col(f"`{turn}`").alias("turn"), step.alias("step")).alias("t")).where("conv_id IS NOT NULL")
    convs = written(own.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["step"]).alias("own")), "trie-own")
    heads = convs.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("opener"), F.slice("own", 1, OPENING).alias("head"))
    h = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % (OPENING + 1)
    both = convs.withColumn("opener", F.col("conv_id") - F.col("conv_id") % FAMILY).join(small_side(written(heads, "trie-heads")), "opener", "left").withColumn("h", h.cast("int"))
    opening = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    steps = F.concat(opening, F.slice("own", F.col("h") + 1, F.size("own")))
    return both.select("conv_id", F.unhex(F.array_join(steps, "")).alias("path"))


def prefix_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations (the root: no turn): conv_id (least
    member), depth, parent_conv_id (the root's: null), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns go by turn (null first), then by the digest of role and text; rows equal in all are turns of their own. A null
    role or text is empty. Rows with a null conv_id belong to no conversation, so they make no node. A conversation whose
    opening is absent and which has no further turns has no turn left and is a member of the root only. Texts count as a
    whole, by their 128-bit digests; of a conversation, 20 bytes a turn must fit in a row. Many equal conversations are
    one path with a count. Empty table: no rows. Further columns are not read.
    """
    paths = written(rebuilt_paths(turns, conv_id, turn, role, text).withColumn("node", F.unhex(F.md5("path"))), "trie-paths")
    hashes = member_hashes(paths.select("node", "conv_id"))
    distinct = paths.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    distinct = written(distinct.withColumn("node", F.unhex(F.md5("path"))).join(hashes, "node").drop("node"), "trie-distinct")
    size = distinct.agg(F.sum(F.octet_length("path") + STEP).alias("b")).first()["b"] or 0
    ranges = min(RANGES, max(1, ceil(size / RANGE_BYTES)))
    dealt = distinct.repartitionByRange(ranges, "path").sortWithinPartitions("path").withColumn("range", F.spark_partition_id().cast("long"))
    nodes = written(dealt.mapInArrow(range_nodes, NODE), "trie-nodes")
    settled, open_ = [nodes.where("done")], nodes.where("NOT done")
    most = open_.agg(F.max("range").alias("r")).first()["r"]
    while most is not None:
        most //= FAN
        merged = open_.withColumn("group", F.floor(F.col("range") / FAN)).groupBy("group").applyInArrow(merged_ranges(most == 0), NODE)
        merged = written(merged, "trie-merged")
        settled.append(merged.where("done"))
        open_, most = merged.where("NOT done"), most if most else None
    late = settled[1:]
    keys = (late[0] if late else nodes).select(F.col("key").alias("parent"), F.col("conv_id").alias("late"))
    for more in late[1:]:
        keys = keys.unionAll(more.select(F.col("key").alias("parent"), F.col("conv_id").alias("late")))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionAll(more)
    keys = few_bytes(written(keys, "trie-keys"), F.lit(32))
    return out.join(keys, "parent", "left").select("conv_id", "depth", F.coalesce("parent_conv_id", "late").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations"))


#: crc32 of the decimal id bit by bit; then the trie by prefix strings of the turns' digests, 40 characters a turn.
OP11_SQL = r"""
WITH c AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) || lpad(length(coalesce(text, ''))::VARCHAR, 8, '0') AS step
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT conv_id, conv_id - conv_id % 100 AS opener, list(step ORDER BY i) AS own,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda d: [256 + ord(d), 0, 0, 0, 0, 0, 0, 0]))),
           lambda a, x: xor(xor(a, greatest(x - 256, 0)) >> 1, (xor(a, greatest(x - 256, 0)) & 1) * 3988292384)), 4294967295) % 6 AS h
  FROM c GROUP BY conv_id),
t AS (
  SELECT o.conv_id, list_concat(coalesce(p.own[1:o.h], []), o.own[o.h + 1:]) AS steps
  FROM o LEFT JOIN o AS p ON p.conv_id = o.opener),
s AS (SELECT conv_id, array_to_string(steps, '') AS path, len(steps) AS n FROM t),
r AS (SELECT conv_id, d, substr(path, 1, 40 * d) AS k, d = n AS is_end FROM (SELECT *, unnest(range(0, n + 1)) AS d FROM s)),
g AS (
  SELECT k, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d > 0 THEN right(k, 8)::BIGINT ELSE 0 END AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM r GROUP BY k, d),
n AS (SELECT g.*, coalesce(m.n_children, 0) AS n_children FROM g LEFT JOIN (SELECT substr(k, 1, length(k) - 40) AS k, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY 1) m USING (k)),
u AS (
  SELECT substr(k, 1, 40 * j) AS k, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS j FROM n) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, u.n_leaves, u.saved_tokens, n.ends_sha256
FROM n JOIN u USING (k) LEFT JOIN n AS p ON n.depth > 0 AND p.k = substr(n.k, 1, length(n.k) - 40)
"""

"""Merkle manifest of a table by SHA-256 midstates (operator 13).

Leaves of a group, in order, make runs of ARITY; each run becomes its hash, level by level, until one node is left; the
groups' nodes make the root likewise. Leaves are cut into aligned blocks of BLOCK, whose trees are built in tasks; the
blocks' nodes are the leaves of the next tier, so that the depth of the plan is the logarithm of the rows to base BLOCK.
A parent keeps a copy of its hash state before each child's slot: a changed child is folded by resuming that state with
the replacement and the right siblings; what stands left of it is never hashed again. The levels above a block are the
same for all of its leaves, so their left siblings are hashed once for a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import LOWER, UPPER, few_bytes, read, small_side, written

#: Children of a node; levels and leaves of a block.
ARITY, LEVELS = 8, 3
BLOCK = ARITY**LEVELS
#: Leaves that one partition of the sort takes.
SORT_ROWS = 20_000

Steps = list[tuple[list[bytes], list]]
PATH = "array<struct<left: string, right: string>>"


def climb(nodes: list[bytes], levels: int) -> tuple[Steps, bytes]:
    """The node above `nodes` after so many levels; of each level its nodes and the hash states of their parents before each of them."""
    steps: Steps = []
    for _ in range(levels):
        states, above = [], []
        for a in range(0, len(nodes), ARITY):
            h = hashlib.sha256()
            for child in nodes[a : a + ARITY]:
                states.append(h.copy())
                h.update(child)
            above.append(h.hexdigest().encode())
        steps.append((nodes, states))
        nodes = above
    return steps, nodes[0]


def siblings(steps: Steps, i: int) -> Iterator[tuple[bytes, bytes]]:
    """What stands left and right of node i's path in its runs, level by level."""
    for nodes, _ in steps:
        a = i - i % ARITY
        yield b"".join(nodes[a:i]), b"".join(nodes[i + 1 : a + ARITY])
        i //= ARITY


def fold(steps: Steps, i: int, node: bytes) -> bytes:
    """The node above with `node` in place i: each level resumes its parent's state before the slot."""
    for nodes, states in steps:
        h = states[i].copy()
        h.update(node)
        h.update(b"".join(nodes[i + 1 : i - i % ARITY + ARITY]))
        node = h.hexdigest().encode()
        i //= ARITY
    return node


def hexes(digests: pa.Array) -> list[bytes]:
    return [d.hex().encode() for d in digests.to_pylist()]


def block_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, at, node) above each block: the node that the block is in the next tier."""
    for b in batches:
        out = [climb(hexes(units.values.field("node")), n)[1] for units, n in zip(b.column("units"), b.column("levels").to_pylist(), strict=True)]
        yield pa.record_batch([b.column("g"), b.column("block"), pa.array([bytes.fromhex(x.decode()) for x in out], pa.binary())], ["g", "at", "node"])


def unit_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, at, path, top) of each unit of blocks with their own paths and tops."""
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    for b in batches:
        for g, units, n, above, top in zip(*(b.column(c) for c in ("g", "units", "levels", "path", "top")), strict=True):
            steps, _ = climb(hexes(units.values.field("node")), n.as_py())
            own = [[{"left": x.decode(), "right": y.decode()} for x, y in siblings(steps, i)] + above.as_py() for i in range(len(units))]
            at = units.values.field("at")
            yield pa.record_batch([pa.array([g.as_py()] * len(at), pa.string()), at, pa.array(own, kind), pa.array([top.as_py()] * len(at), pa.binary())], ["g", "at", "path", "top"])


def leaf_results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per leaf: proof hash, and the root folded from the changed leaf where there is one, else from the leaf itself."""
    for b in batches:
        for units, n, path, subroot, root in zip(*(b.column(c) for c in ("units", "levels", "path", "subroot", "root")), strict=True):
            leaves = hexes(units.values.field("node"))
            changed = [c.hex().encode() if c else leaf for c, leaf in zip(units.values.field("changed").to_pylist(), leaves, strict=True)]
            steps, _ = climb(leaves, n.as_py())
            above = [(hashlib.sha256(p["left"].encode()), p["left"].encode() + p["right"].encode(), p["right"].encode()) for p in path.as_py()]
            upper = b"".join(both for _, both, _ in above)
            proofs, folded = [], []
            for i, leaf in enumerate(changed):
                proof = hashlib.sha256()
                for left, right in siblings(steps, i):
                    proof.update(left)
                    proof.update(right)
                proof.update(upper)
                proofs.append(proof.hexdigest())
                node = fold(steps, i, leaf)
                for state, _, right in above:
                    h = state.copy()
                    h.update(node)
                    h.update(right)
                    node = h.hexdigest().encode()
                folded.append(node.decode())
            same = [[x.as_py().hex()] * len(leaves) for x in (subroot, root)]
            yield pa.record_batch([units.values.field("id"), pa.array([x.decode() for x in leaves]), *map(pa.array, (*same, proofs, folded))], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, DataFrame]:
    """Adds `at`, each row's place in its group g by `order`; and (g, n) of all groups.

    Rows are range-partitioned by group and order, so that one group with most rows takes many partitions; only a count
    for each partition and group is summed up.
    """
    parts = max(1, ceil(rows.count() / SORT_ROWS))
    rows = written(rows.repartitionByRange(parts, "g", *order).sortWithinPartitions("g", *order).withColumn("i", F.monotonically_increasing_id()), "merkle-sorted")
    runs = rows.groupBy("g", F.shiftright("i", 33).alias("part")).agg(F.count("*").alias("c"), F.min("i").alias("first"))
    before = F.sum("c").over(Window.partitionBy("g").orderBy("part")) - F.col("c")
    runs = written(runs.select("g", "part", "c", (before - F.col("first")).alias("shift")), "merkle-runs")
    placed = rows.withColumn("part", F.shiftright("i", 33)).join(small_side(runs.drop("c")), ["g", "part"])
    return placed.withColumn("at", F.col("i") + F.col("shift")).drop("i", "part", "shift"), runs.groupBy("g").agg(F.sum("c").alias("n"))


def blocks_of(units: DataFrame, sizes: DataFrame) -> DataFrame:
    """(g, block, levels, units: BLOCK of them at most, in order) of units (g, at, node and more).

    A block's tree has all LEVELS if its group has further blocks, else as many as leave one node.
    """
    levels = sum(((F.col("n") > ARITY**k).cast("int") for k in range(1, LEVELS)), (F.col("n") > 1).cast("int"))
    rest = [c for c in units.columns if c not in ("g", "at")]
    grouped = units.groupBy("g", F.floor(F.col("at") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(F.struct("at", *rest))).alias("units"))
    return written(grouped.join(small_side(written(sizes.select("g", levels.alias("levels")), "merkle-sizes")), "g"), "merkle-blocks")


def tier(units: DataFrame, sizes: DataFrame) -> DataFrame:
    """(g, at, path, top): of each unit the siblings up to its group's top node, and that node."""
    blocks = blocks_of(units, sizes)
    nodes = written(blocks.mapInArrow(block_nodes, "g string, at long, node binary"), "merkle-nodes")
    above = above_blocks(nodes).withColumnRenamed("at", "block")
    return written(blocks.join(above, ["g", "block"]).mapInArrow(unit_paths, f"g string, at long, path {PATH}, top binary"), "merkle-paths")


def above_blocks(nodes: DataFrame) -> DataFrame:
    """As tier(), for the nodes of blocks; ends where every group has one."""
    if nodes.where("at > 0").take(1):
        return tier(nodes, nodes.groupBy("g").agg(F.count("*").alias("n")))
    return nodes.select("g", "at", F.array().cast(PATH).alias("path"), F.col("node").alias("top"))


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 bytes' number, a colon, the value; integers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.unhex(F.sha2(F.encode(F.concat(*map(field, values)), "UTF-8"), 256))


def manifest(docs: DataFrame, changed: Column | None = None, where: Column | None = None, doc_id: str = "doc_id", group: str = "lang", text: str = "text", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot (of its group), root, proof_sha256 (of its siblings up to the root), folded_root.

    A leaf is the hash of `fields`. folded_root is recomputed from the original siblings and, where `where` holds, the
    leaf that the row has with `changed` as its text; elsewhere its own leaf, so that it equals the root.

    Null values are `-` in the leaf; a null group is a group of its own and comes first, as does a null id; rows that
    share an id go by their leaves, rows equal in all are leaves of their own. Texts of any length are hashed as a whole
    where they stand; only digests are moved. Further columns are not read. Empty table: no rows.
    """
    values = [F.col(f"`{c}`") for c in fields]
    other = [changed if c == text and changed is not None else F.col(f"`{c}`") for c in fields]
    node = F.when(where, leaf_of(*other)) if changed is not None and where is not None else F.lit(None).cast("binary")
    # "" for null, "=" before others: groups stay apart and in order
    g = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    leaves = docs.select(g.alias("g"), F.col(f"`{doc_id}`").cast("long").alias("id"), leaf_of(*values).alias("node"), node.alias("changed"))
    leaves = written(leaves.withColumn("salt", F.monotonically_increasing_id()), "merkle-leaves")
    placed, sizes = numbered(leaves, "id", "node", "salt")
    blocks = blocks_of(placed.drop("salt"), sizes)
    nodes = written(blocks.mapInArrow(block_nodes, "g string, at long, node binary"), "merkle-nodes")
    above = written(above_blocks(nodes), "merkle-above")
    tops = above.where("at = 0").select(F.lit("").alias("g"), F.col("g").alias("own"), F.col("top").alias("node"))
    tops, count = numbered(written(tops, "merkle-tops"), "own")
    tops = written(tops, "merkle-groups")
    roots = tier(tops.drop("own"), count).select("at", F.col("path").alias("more"), F.col("top").alias("root"))
    roots = tops.select("at", F.col("own").alias("g")).join(roots, "at").drop("at")
    roots = few_bytes(written(roots, "merkle-roots"), F.lit(64) + 2 * 64 * ARITY * F.size("more"))
    above = above.join(roots, "g").select("g", F.col("at").alias("block"), F.concat("path", "more").alias("path"), F.col("top").alias("subroot"), "root")
    return blocks.join(above, ["g", "block"]).mapInArrow(leaf_results, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", UPPER, LOWER)
    third = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    return manifest(read(spark, sf_dir, "documents"), lowered, third).withColumn("verified", F.col("folded_root") == F.col("root"))


def _op13_sql(levels: int = 10) -> str:
    """One query per level: of up to ARITY**levels nodes a group. Each level keeps, for every node, its run as (digests, place of the node)."""
    leaf = "|| ".join(f"coalesce(strlen({c}) || ':' || {c}, '-') " for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", "{t}"))
    crc = (
        "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda d: [256 + ord(d), 0, 0, 0, 0, 0, 0, 0]))), "
        "lambda a, x: xor(xor(a, greatest(x - 256, 0)) >> 1, (xor(a, greatest(x - 256, 0)) & 1) * 3988292384)), 4294967295)"
    )
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    sql = [
        f"WITH leaves AS (SELECT doc_id, lang, sha256({leaf.format(t='text')}) AS leaf, sha256({leaf.format(t=lowered)}) AS low, {crc} % 3 = 0 AS hit FROM documents)",
        "a0 AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i0 FROM leaves)",
        "n0 AS (SELECT lang AS g, i0 AS i, leaf AS h, count(*) OVER (PARTITION BY lang) AS c FROM a0)",
    ]

    def up(tag: str, into: str) -> str:
        return f"{into} AS (SELECT g, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, any_value((c + 7) // 8) AS c FROM {tag} WHERE c > 1 GROUP BY g, i // 8 UNION ALL SELECT * FROM {tag} WHERE c = 1)"

    sql += [up(f"n{k}", f"n{k + 1}") for k in range(levels)]
    sql += [f"m0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, h, count(*) OVER () AS c, g AS lang FROM n{levels})", "t0 AS (SELECT g, i, h, c FROM m0)"]
    sql += [up(f"t{k}", f"t{k + 1}") for k in range(levels)]
    # folding: proof is what was hashed beside the path so far, f the node folded so far
    sql.append("f0 AS (SELECT a0.*, i0 AS i, '' AS proof, CASE WHEN hit THEN low ELSE leaf END AS f FROM a0)")

    def fold_step(k: int, now: str, nodes: str, match: str, into: str) -> str:
        beside = f"(SELECT {match}, i // 8 AS run, any_value(c) AS c, list(h ORDER BY i) AS hs FROM {nodes} GROUP BY {match}, i // 8)"
        left, right = "array_to_string(hs[1:i % 8], '')", "array_to_string(hs[i % 8 + 2:], '')"
        return (
            f"{into} AS (SELECT {now}.* REPLACE (CASE WHEN c > 1 THEN i // 8 ELSE i END AS i, CASE WHEN c > 1 THEN proof || {left} || {right} ELSE proof END AS proof, "
            f"CASE WHEN c > 1 THEN sha256({left} || f || {right}) ELSE f END AS f) FROM {now} JOIN {beside} b ON b.{match} IS NOT DISTINCT FROM {now}.{'lang' if match == 'g' and nodes[0] == 'n' else 'zero'} AND b.run = {now}.i // 8)"
        )

    sql += [fold_step(k, f"f{k}", f"n{k}", "g", f"f{k + 1}") for k in range(levels)]
    sql.append(f"e0 AS (SELECT f.* REPLACE (m0.i AS i), m0.h AS subroot, 0 AS zero FROM f{levels} f JOIN m0 ON m0.lang IS NOT DISTINCT FROM f.lang)")
    sql += [fold_step(k, f"e{k}", f"t{k}", "g", f"e{k + 1}") for k in range(levels)]
    return ",\n".join(sql) + f"\nSELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified FROM e{levels} CROSS JOIN (SELECT h FROM t{levels})"


OP13_SQL = _op13_sql()

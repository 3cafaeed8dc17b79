"""Prefix trie, SimHash by vantage-point trees and Merkle manifest against brute force, with nulls, empty and long texts, ties, repeats, hot groups."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from idhealth.llm import merkle, neardup, simhash, suffixdedup, trie, warc
from idhealth.llm.base import new_dir


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


# --- prefix trie ---


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), digest, role, text))
    seqs = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        opener = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built = tuple(seqs.get(opener, [])[:h] + turns[h:])
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
        ends[built].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) if children[k] else 1
        saved[k] = sum(saved[x] for x in children[k]) + (len(members[k]) - 1) * (len(k[-1][1]) if k else 0)
    return sorted(
        ((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k], sha(",".join(map(str, sorted(ends[k]))))) for k, m in members.items()), key=repr
    )


def as_rows(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


def conversations(seed, convs, words=4):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        n = rng.choice([1, 2, 3, 4, 5, 6, 9]) if c % 50 else 60
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", "äx" * rng.randint(0, words)) for t in range(n)]
    copy = [(t, "user", f"copied {t}") for t in range(8)]
    rows += [(c, *t) for c in range(1000, 1000 + convs // 2) for t in copy]  # one very common conversation
    return rows


ODD_TURNS = [
    (7, None, "user", "first, without a turn"), (7, 0, None, None), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (7, 3, "", ""), (None, 1, "user", "of no conversation"),
    (-3, 0, "user", "negative"), (-200, 1, "user", "opener"), (5001, 0, "user", "no opener: nothing may be left"), (2**40 + 1, 2, "rôle", "x" * 70_000), (9, 1, "a", "b"), (9, 1, "ab", ""),
]


@pytest.mark.parametrize(("bytes_", "fan", "piece"), [(1 << 18, 64, 1 << 16), (600, 3, 40)])
def test_trie(spark, monkeypatch, bytes_, fan, piece):
    monkeypatch.setattr(trie, "RANGE_BYTES", bytes_)
    monkeypatch.setattr(trie, "FAN", fan)
    monkeypatch.setattr(trie, "PIECE", piece)
    rows = conversations(3, 220) + ODD_TURNS
    turns = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, path string, h int").repartition(5)
    assert as_rows(trie.prefix_trie(turns)) == brute_trie(rows)


def test_trie_of_nothing(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert as_rows(trie.prefix_trie(turns)) == []
    only_null = spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert as_rows(trie.prefix_trie(only_null)) == []


@pytest.mark.parametrize("shape", ["random", "chain", "star", "forest"])
def test_centroid_totals(shape):
    rng = random.Random(shape)
    n = 700
    parent = [-1]
    for i in range(1, n):
        # preorder: a parent is on the way from the top to the node before
        way, p = [], i - 1
        while p >= 0:
            way.append(p)
            p = parent[p]
        parent.append({"chain": i - 1, "star": way[-1], "random": rng.choice(way), "forest": rng.choice([*way, -1])}[shape])
    own, low = np.array([rng.randint(-5, 50) for _ in range(n)]), np.array([rng.randint(0, 9999) for _ in range(n)])
    (totals,), least = trie.centroid_totals(np.array(parent), [own], low)
    want, want_low = own.copy(), low.copy()
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
            want_low[parent[i]] = min(want_low[parent[i]], want_low[i])
    assert totals.tolist() == want.tolist()
    assert least.tolist() == want_low.tolist()


# --- SimHash ---


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(grams))


def brute_components(fps):
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                label[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


ODD_TEXTS = [None, "", " \t\n ", "One", "one", "two words are one", "ÀÉ b\x0bc\x1fd  e", "same same " * 400, "x" * 3000 + " y z", "\x00 \x7f ß"]


def test_fingerprints():
    rng = random.Random(9)
    texts = ODD_TEXTS + [" ".join(rng.choice("Alpha beta GAMMA délta eps".split()) for _ in range(rng.randint(1, 300))) for _ in range(40)] + ["word " * 200_000]
    assert [int(x) for x in simhash.simhashes(pa.array(texts))] == [brute_fingerprint(x) for x in texts]
    assert simhash.simhashes(pa.array(texts[3:20])[2:5]).tolist() == [brute_fingerprint(x) for x in texts[5:8]]


def near_texts(seed, n):
    rng = random.Random(seed)
    base = [[f"w{rng.randint(0, 5000)}" for _ in range(150)] for _ in range(n)]
    out = [" ".join(b) for b in base]
    for k in range(n):  # copies and near copies, of the first text many
        b = list(base[0 if k % 3 == 0 else k])
        b[rng.randrange(len(b))] = "changed"
        out.append(" ".join(b))
    return out + [out[1]] * 30


@pytest.mark.parametrize(("sample", "shard", "leaf"), [(65_536, 8192, 256), (60, 20, 4)])
def test_components(spark, monkeypatch, sample, shard, leaf):
    for name, value in (("SAMPLE", sample), ("SHARD", shard), ("LEAF", leaf)):
        monkeypatch.setattr(simhash, name, value)
    texts = near_texts(4, 150) + ODD_TEXTS
    want = brute_components([brute_fingerprint(x) for x in texts])
    docs = spark.createDataFrame([(i, x, "clash", 0) for i, x in enumerate(texts)], "doc_id long, text string, root string, n int").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in simhash.simhash_components(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert len(set(want)) < len(want) - 100  # the fixture has links


def test_links_of_many_fingerprints():
    """The tree's splits and leaves lose no link: random fingerprints, pairs at one to three bits across the splits, a dense ball and a chain."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 64, 6000, dtype=np.uint64)
    flip = lambda v, k: v ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, k, replace=False).astype(np.uint64))
    near = [flip(v, 1 + i % 3) for i, v in enumerate(x[:600])] + [flip(v, 4) for v in x[600:900]]
    ball = [flip(x[0], int(k)) for k in rng.integers(1, 7, 1500)]
    chain = [x[1]]
    for _ in range(200):
        chain.append(flip(chain[-1], 3))
    x = np.unique(np.concatenate([x, near, ball, chain]).astype(np.uint64))
    d = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    label = np.arange(len(x))
    while True:
        least = np.array([label[row].min() for row in d])
        if (least == label).all():
            break
        label = least
    t = simhash.shard_links(pa.table({"fp": x.view(np.int64)}))
    a, b = (np.searchsorted(x, t.column(c).to_numpy().view(np.uint64)) for c in ("a", "b"))
    found = np.arange(len(x))
    while True:
        before = found.copy()
        np.minimum.at(found, a, before[b])
        np.minimum.at(found, b, before[a])
        if (found == before).all():
            break
    assert found.tolist() == label.tolist()
    assert len(a) < 4 * len(x)  # links join a ball, they don't list its pairs


def test_simhash_of_nulls_and_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(docs).collect() == []
    docs = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (9, "a b c d"), (9, "a b c d"), (3, None), (None, "quite another text, alone here")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.simhash_components(docs).collect()), key=repr)
    assert got == sorted([(None, 4), (4, 4), (9, 4), (9, 4), (3, 3), (None, None)], key=repr)


# --- Merkle ---


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text); each doc's result computed from whole levels, without states."""
    fields = lambda r: "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r)
    lower = lambda t: None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    groups = defaultdict(list)
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        groups[r[2]].append((r[0] is not None, r[0] or 0, sha(fields(r)), sha(fields((*r[:4], lower(r[4])))) if hit else None))

    def up(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def walk(levels, i, node):
        proof = ""
        for nodes in levels[:-1]:
            run = nodes[i - i % 8 : i - i % 8 + 8]
            proof += "".join(run[: i % 8] + run[i % 8 + 1 :])
            node = sha("".join([*run[: i % 8], node, *run[i % 8 + 1 :]]))
            i //= 8
        return proof, node

    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: r[:3])
    trees = {g: up([r[2] for r in groups[g]]) for g in order}
    top = up([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (known, doc_id, leaf, changed) in enumerate(groups[g]):
            proof, node = walk(trees[g], i, changed or leaf)
            more, node = walk(top, k, node)
            root = top[-1][0]
            out.append((doc_id if known else None, leaf, trees[g][-1][0], root, sha(proof + more), node, node == root))
    return sorted(out, key=repr)


def manifest_rows(spark, rows):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, node string").repartition(3)
    lowered = F.translate("text", merkle.UPPER, merkle.LOWER)
    out = merkle.manifest(docs, lowered, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    out = out.withColumn("verified", F.col("folded_root") == F.col("root"))
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize(("levels", "sort_rows"), [(3, 20_000), (1, 70)])
def test_manifest(spark, monkeypatch, levels, sort_rows):
    for name, value in (("LEVELS", levels), ("BLOCK", 8**levels), ("SORT_ROWS", sort_rows)):
        monkeypatch.setattr(merkle, name, value)
    rng = random.Random(6)
    rows = [(i, f"s{i % 4}" if i % 5 else None, rng.choice(["en", "en", "en", "de", "é", "", "zh"]), i, rng.choice(["Text", "lower only", "É only", ""]) + str(i)) for i in range(900)]
    rows += [(None, None, None, None, None), (None, "a", None, 1, "A"), (3, "a", "en", 2, "Tie"), (3, "a", "en", 2, "Tie"), (3, None, "en", None, "x" * 100_000 + "A"), (5, "a", "alone", 0, "Z"), (-7, "-", "en", -4, "1:A")]
    assert manifest_rows(spark, rows) == brute_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 513])
def test_small_manifests(spark, n):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(n)]
    assert manifest_rows(spark, rows) == brute_manifest(rows)


def test_fold_resumes_states():
    """Folding hashes the replacement and the right siblings only: left siblings may be forgotten."""
    nodes = [sha(str(i)).encode() for i in range(20)]
    steps, top = merkle.climb(nodes, 2)
    changed = list(nodes)
    changed[11] = sha("new").encode()
    blind = [([b"forgotten" if j < i else x for j, x in enumerate(level)], states) for (level, states), i in zip(steps, (11, 1), strict=True)]
    assert merkle.fold(blind, 11, changed[11]) == merkle.climb(changed, 2)[1] != top


# --- near-duplicates whose lines repeat ---


@pytest.mark.parametrize("repeats", [1, 30, 300])
def test_repeated_lines_keep_links(spark, repeats):
    """Pairs at set Jaccard 0.83 are linked however often one text repeats a line."""
    rng = random.Random(repeats)
    texts = []
    for _ in range(200):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
        other = [*words[:185], *(f"v{rng.randint(0, 10**6)}" for _ in range(15))]
        line = " ".join(words[:9])
        texts += [" ".join(words) + ("\n" + line) * repeats, " ".join(other)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}

    def grams(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    alike = [i for i in range(0, 400, 2) if len(grams(texts[i]) & grams(texts[i + 1])) >= 0.8 * len(grams(texts[i]) | grams(texts[i + 1]))]
    assert len(alike) > 150
    assert all(got[i + 1] == i for i in alike)


# --- captures of one URL key ---


def test_one_key_over_many_index_files(spark, monkeypatch):
    """Most captures have one key, which runs over several index files and blocks; each is found by key and page, none is looked at twice."""
    rows = [(i, None if i % 4 else f"http://h{i}.org/", f"<p>{i if i % 10 else 'same'}</p>") for i in range(1500)] + [(None, None, "<p>no id</p>"), (7, None, "<p>again 7</p>")]
    monkeypatch.setattr(warc, "BLOCK", 16)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    archive, index = new_dir(spark, "warc"), new_dir(spark, "warc-cdx")
    files = warc.write_index(warc.write_archives(pages, archive), index)
    assert len({r["first_key"] for r in files.collect()}) < files.count() or files.where("first_key = ''").count() > 0
    got = warc.archive_pages(pages, new_dir(spark, "warc"), new_dir(spark, "warc-cdx")).collect()
    assert len(got) == len(rows)
    top = max(i for i in range(1500) if i % 10 == 0)
    assert sum(r["record_type"] == "revisit" for r in got) == 149 and {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {top}
    assert sorted((r["page_id"] is not None, r["page_id"] or 0, r["payload_bytes"]) for r in got) == sorted((p is not None, p or 0, len(h)) for p, _, h in rows)


def test_search_reads_one_block(spark, tmp_path):
    """A capture among many of its key is found in the block that holds it."""
    from pyarrow import fs

    captures = spark.createDataFrame([("k", i, "f", i, 1) for i in range(20_000)], "key string, page_id long, file string, at long, size long").coalesce(1).sortWithinPartitions("page_id")
    name = captures.mapInArrow(warc.index_rows(f"file://{tmp_path}"), "index_file string, first_key string, first_id long").collect()[0]["index_file"]
    index, read = warc.IndexFile(fs.LocalFileSystem(), f"{tmp_path}/{name}"), []
    whole = index.range
    index.range = lambda at, size: (read.append(at), whole(at, size))[1]
    for page in (0, 9_999, 19_999, 12_345):
        index.block = -1
        assert [x[1] for x in index.find(warc.place_of("k", page))] == [page]
    assert len(read) <= 8  # one block each, or the one before it too
    assert list(index.find(warc.place_of("k", 20_000))) == [] == list(index.find(warc.place_of("a", 5)))


@pytest.mark.parametrize("period", ["a", "abcdefg", "x" * 47 + "y"])
def test_periodic_texts(spark, period):
    """A text that repeats itself has an anchor at nearly every byte; its suffixes go out in slices."""
    long = (period * 60_000)[:60_000]
    docs = spark.createDataFrame([(1, long), (2, "start " + long[:250] + " end"), (3, long[:199]), (4, "unlike others " * 10)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffixdedup.remove_repeats(docs).collect()}
    assert got == {1: (60_000, 60_000, 1), 2: (260, 250, 1), 3: (199, 0, 0), 4: (140, 0, 0)}

"""Memory of the tasks that find anchors and copy their suffixes."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa

from idhealth.llm import base, suffixdedup


def peak(rows, batch):
    tracemalloc.start()
    n = sum(b.num_rows for b in rows(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return n, most / 1e6


def test_anchors_and_suffixes_in_small_parts():
    """A task held the work arrays of 1 MB of text, or the indices of 8,192 suffixes, at once."""
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefgh ", k=2000)) for _ in range(1000)]
    docs = pa.array([b"%d" % i for i in range(1000)])
    suffixdedup.tf.powers(1)
    n, most = peak(suffixdedup.anchor_rows, pa.record_batch([docs, pa.array(texts)], ["doc", "text"]))
    assert n > 10_000 and most < 75, most
    some = [[{"place": (p + 100) << 16 | 100 << 8 | 20, "h": p, "hot": False} for p in range(0, 1600, 80)]] * 1000
    kind = pa.list_(pa.struct([("place", pa.int64()), ("h", pa.int64()), ("hot", pa.bool_())]))
    n, most = peak(suffixdedup.suffix_rows, pa.record_batch([docs, pa.array(texts), pa.array(some, kind)], ["doc", "text", "a"]))
    assert n == 20_000 and most < 40, most


def test_texts_are_cut_into_suffixes_once(spark, monkeypatch):
    """Where a group was counted string by string, all texts were shuffled and cut into suffixes a second time."""
    plans = []

    def written(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return base.written(df, name)

    rng = random.Random(5)
    line = "".join(rng.choices("abcdefgh ", k=400))
    rows = [(i, "".join(rng.choices("abcdefgh ", k=300)) + line) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, suffixdedup.remove_repeats(docs).collect()))
    monkeypatch.setattr(suffixdedup, "written", written)
    monkeypatch.setattr(suffixdedup, "BUCKET_ROWS", 2)
    got = suffixdedup.remove_repeats(docs)
    assert sum(p.count("MapInArrow suffix_rows(") for p in plans) == 1 and any("string_rows(" in p for p in plans)
    assert sorted(map(tuple, got.collect())) == want and all(r[2] >= 400 for r in want)

"""The corpus pipeline on a small corpus with planted cases, stage by stage."""

from __future__ import annotations

import random

import pytest

from idhealth.llm import quality

from .test_llm_operators import prose, slow_classes, slow_repeats, slow_words

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    item = prose(rng, 30)
    texts, labels = [], []
    for i in range(240):
        w = prose(rng, rng.randint(40, 120)).split()
        if i % 4 == 0:
            w[3] = "vilewordone"
        texts.append(" ".join(w))
        labels.append((i, 1, int(i % 4 == 0)))
    passage = prose(rng, 60)
    texts += [texts[1], texts[2] + " end", texts[5] + " " + passage, passage + " " + texts[6][::-1], prose(rng, 60) + " " + " ".join(item.split()[5:18])]
    d = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(i, x, "en", f"s{i % 4}", len(x)) for i, x in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"file://{d}/benchmark.parquet")
    return f"file://{d}"


def test_stages(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    cols, item = docs.columns, slow_words(spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"])
    before = {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "passages", "benchmark", "mixture"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.createDataFrame([(*[r[c] for c in cols],) for r in docs.collect()], docs.schema), folder)
        rows = {r.doc_id: r for r in out.collect()}
        ids = sorted(before)
        if name == "quality":
            toxic = {i for i, x in before.items() if "vilewordone" in x}
            assert not toxic & set(rows) and len(rows) >= 0.97 * (len(before) - len(toxic))
        elif name == "near_duplicates":
            assert sorted(rows) == sorted({ids[c] for c in slow_classes([before[i] for i in ids])})
        elif name == "passages":
            assert [rows[i].text for i in ids] == [x[3].decode("utf-8", "ignore") for x in slow_repeats([before[i] for i in ids], 200)]
            assert all(r.n_chars == len(r.text) for r in rows.values())
        elif name == "benchmark":
            windows = {tuple(item[k : k + 10]) for k in range(len(item) - 9)}
            leaky = {i for i, x in before.items() if any(tuple(slow_words(x)[k : k + 10]) in windows for k in range(len(slow_words(x)) - 9))}
            assert set(rows) == set(before) - leaky and leaky
        else:
            assert set(rows) <= set(before) and out.columns == [*cols, "mix_size", "mix_taken"] and all(r.mix_taken > 0 for r in rows.values())
        if name != "mixture":
            assert out.columns == cols
            docs, before = out, {i: r.text for i, r in rows.items()}
    assert quality.GRADES == 3


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 50

from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline
from tillweave.operators.materialize import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string"


@pytest.fixture(scope="module")
def folder(spark):
    rng = random.Random(12)
    word = lambda: rng.choice("bcdfgh") + rng.choice("aeiou") + str(rng.randint(0, 3000))
    make = lambda n: [word() for _ in range(n)]
    rows, labels = [], []
    add = lambda words: rows.append((len(rows), " ".join(words))) or rows[-1][0]
    for _ in range(300):
        bad = rng.random() < 0.3
        words = make(40)
        for _ in range(4 * bad):
            words[rng.randrange(40)] = rng.choice(["grobian", "grobheit", "rüpel"])
        labels.append((add(words), int(bad)))
    passage, item = make(60), make(30)
    clean = [add(make(70) + ["\n"] + make(5)) for _ in range(20)]
    original = make(200)
    copies = [add(original), add(original[:-1] + ["x1"]), add(original)]
    shared = [add(make(20) + passage + make(20)) for _ in range(3)]
    leak = add(make(30) + item[5:20] + make(30))
    add([])
    rows.append((len(rows), None))
    rows.append(rows[clean[0]])
    path = scratch_path(spark, "sf")
    docs = [(i, t, "en", "s", len(t or ""), "x") for i, t in rows]
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, dict(rows), labels, clean, copies, shared, leak


def test_stages_take_effect_and_keep_the_rest(spark, folder):
    path, texts, labels, clean, copies, shared, leak = folder
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), []
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES:
        out = scratch_path(spark, name)
        step(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "best_fit_packing":
            assert docs.columns == columns
            kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
            assert len(kept[-1]) == docs.count() or name == "toxicity"
    toxic = {i for i, y in labels if y}
    assert len(toxic - set(kept[0])) >= 0.95 * len(toxic)
    assert len(set(kept[0]) - toxic) >= 0.99 * (len(texts) - len(toxic))
    assert set(copies) & set(kept[1]) == {copies[0]} and set(kept[0]) - set(kept[1]) == set(copies[1:])
    assert set(kept[2]) == set(kept[1])
    for i in shared:
        have = texts[i].split()
        assert kept[2][i] == " ".join(have[:20] + have[80:])
    for i in clean:
        assert kept[3][i] == texts[i]  # line breaks included
    assert set(kept[2]) - set(kept[3]) == {leak}
    assert Counter(r["doc_id"] for r in docs.collect()) == Counter(list(kept[3]))


def test_run_gives_the_packed_rows(spark, folder):
    rows = corpus_pipeline.run(spark, folder[0])
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 200

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillweave.llm import toxicity
from tillweave.llm.textwords import mix, window_hashes


def test_grams_of_words():
    size, slots = toxicity.word_grams([b"ab", "é".encode(), b"abcdefgh"])
    assert size.tolist() == [3, 1, 33]  # " ab", "ab ", " ab "; " é "; 8 + 7 + 6 + 5 + 4 + 3 of " abcdefgh "
    again, same = toxicity.word_grams([b"ab"])
    assert sorted(slots[:3]) == sorted(same) and again.tolist() == [3]


def sample(n=700):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        words = [rng.choice(["tha", "ing", "ere", "tion", "qu"]) + rng.choice("abcdefgh") for _ in range(rng.randint(5, 80))]
        for _ in range(rng.randint(1, 4) * toxic):
            words[rng.randrange(len(words))] = rng.choice(["Grobian", "grobheit,", "rüpel"])
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_accuracy_and_edges(spark):
    rows = sample()
    texts = [(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (902, "x " * 20_000), (902, "x " * 20_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("label", F.lit(1)).repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (4, 7)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, usable=F.col("doc_id") % 5 != 0)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(texts) and all(0 <= r["score"] <= 1 for r in out)
    score = {r["doc_id"]: r["score"] for r in out}
    held = [(score[i] >= 0.5) == bool(y) for i, _, y in rows if i % 5 == 0]
    assert sum(held) >= 0.97 * len(held)
    assert score[900] == score[901] < 0.5 and score[902] < 0.5


def test_labels_out_of_the_fold_are_not_learned(spark):
    rows = sample(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    scores = []
    for flip in (0, 1):
        labels = [(i, 1 - y if i % 5 == 0 and flip else y) for i, _, y in rows]
        frame = spark.createDataFrame(labels, "doc_id long, toxic int")
        model = toxicity.fit(docs, frame, usable=F.col("doc_id") % 5 != 0)
        scores.append(sorted(map(tuple, toxicity.score(docs, model).collect())))
    assert scores[0] == scores[1]


def test_without_labels_or_rows(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs(["a b"]), labels)
    assert [r["score"] for r in toxicity.score(docs(["a b", None]), model).collect()] == [0, 0]
    assert toxicity.score(docs([]), model).count() == 0


def test_a_wide_toxic_vocabulary_is_learned(spark):
    rng = random.Random(3)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    clean = [word("abcdefgh", 4) for _ in range(40)]
    toxic = [word("ijklmnopqrstuvwxyz", 9) for _ in range(150)]
    texts = [" ".join([*rng.choices(clean, k=12), w]) for w in toxic for _ in range(4)]
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    rows += [(len(rows) + i, " ".join(rng.choices(clean, k=13)), 0) for i in range(2000)]
    held = lambda i, y: y == 1 and i % 4 == 3
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if not held(i, y)], "doc_id long, toxic int")
    score = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    found = [score[i] >= 0.5 for i, _, y in rows if held(i, y)]
    assert sum(found) >= 0.95 * len(found)
    assert not any(score[i] >= 0.5 for i, _, y in rows if y == 0)


def test_ratios_chosen_features_and_scores_as_by_brute_force(spark):
    rows = sample(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)

    def grams(text):
        words = re.findall("[a-z0-9\x80-\U0010ffff]+", text.lower())
        return {f" {w} "[a : a + n] for w in words for n in range(3, 9) for a in range(len(w) + 3 - n)}

    slot = {}
    for gram in set().union(*(grams(t) for _, t, _ in rows)):  # a gram's slot, from a word that is nothing but it
        points = np.frombuffer(gram.encode("utf-32-le"), "<u4").astype(np.uint64)
        slot[gram] = int(window_hashes(mix(points), len(points))[0] % np.uint64(toxicity.SLOTS))
    has = [({slot[g] for g in grams(t)}, y) for _, t, y in rows]
    n = [Counter(s for x, y in has if y == label for s in x) for label in (0, 1)]
    of = [sum(y == label for _, y in has) for label in (0, 1)]

    def chi(s):
        a, c = n[1][s], n[0][s]
        b, d = of[1] - a, of[0] - c
        return sum(of) * (a * d - b * c) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d) + 1)

    kept = sorted(s for s in set(n[0]) | set(n[1]) if n[0][s] + n[1][s] >= 3 and chi(s) > 10.83)
    assert model.slots.tolist() == kept and len(kept) > 20
    whole = [sum(x[s] for s in kept) + len(kept) for x in n]
    ratio = {s: math.log((n[1][s] + 1) / whole[1]) - math.log((n[0][s] + 1) / whole[0]) for s in kept}
    weight = dict(zip(kept, model.weights))
    score = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    for (i, _, _), (x, _) in zip(rows, has):
        assert score[i] == pytest.approx(1 / (1 + math.exp(-model.bias - sum(weight[s] for s in x if s in weight))), abs=1e-9)
    # At the optimum of the ridge regression on scaled features every slope is 0.
    error = [score[i] - y for (i, _, y) in rows]
    assert abs(sum(error)) / len(rows) < 1e-3
    for s in kept:
        slope = ratio[s] * sum(e for e, (x, _) in zip(error, has) if s in x) / len(rows) + 1e-4 * weight[s] / ratio[s]
        assert abs(slope) < 5e-3


def test_recall_of_held_out_toxic_texts(spark):
    """Of the tables for these operators, whose labels have some toxic texts without a toxic word."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = toxicity.fit(docs, labels, usable=fold != 0)
    held = docs.where(fold == 0).join(labels.where("toxic IS NOT NULL").select("doc_id", "toxic"), "doc_id")
    found = toxicity.score(held, model, keep=("toxic",)).groupBy("toxic").agg(F.count("*").alias("n"), F.count_if(F.col("score") >= 0.5).alias("hit"))
    by = {r["toxic"]: (r["hit"], r["n"]) for r in found.collect()}
    assert by[1][0] >= 0.9 * by[1][1] and by[0][0] <= 0.005 * by[0][1]

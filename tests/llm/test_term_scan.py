from __future__ import annotations

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tillweave.llm import term_scan
from tillweave.llm.term_scan import guarded, make_block, occurrences, rank_documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, items, top=10):
    held = [(i, terms(t)) for i, t in documents]
    held = [(i, t, Counter(t)) for i, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t, _ in held)
    df = Counter(x for _, _, counts in held for x in counts)
    out = []
    for item, text in items:
        found = []
        for doc, t, counts in held:
            m = 25 + 75 * len(t) * n_docs // n_terms
            score = 0
            for x in terms(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                score += w * (10**9 * counts[x] // (1000 * counts[x] + 8 * m))
            if score > 0:
                found.append((-score, doc))
        found.sort(key=lambda x: (x[0], x[1] is not None, x[1]))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(found[:top], 1)]
    return out


def ranked(spark, documents, items, **options):
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id string, text string")
    rows = rank_documents(docs.repartition(3), asked, **options).collect()
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=lambda x: x[:2])


def made(seed, n):
    rng = random.Random(seed)
    words = ["a", "an", "Ana", "ñé", "x1", "1x", "the", "THE", "日本", "then", "he", "her"]
    return [(i, rng.choice(["", " ", "--"]) + rng.choice([" ", "-", "\n"]).join(rng.choices(words, k=rng.randrange(0, 30)))) for i in range(n)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_as_by_brute_force(spark, block_bytes, monkeypatch):
    documents = [*made(1, 300), (300, None), (301, ""), (302, "; -")]
    items = [(f"i{i}", t) for i, t in made(2, 12)] + [("null", None), ("none", "?!"), ("absent", "zebra the"), ("repeats", "a a a the")]
    found = ranked(spark, documents, items, block_bytes=block_bytes)
    assert found == sorted(brute(documents, items))
    assert {item for item, *_ in found} >= {"absent", "repeats"}


def test_many_equal_documents_tie_by_id(spark):
    documents = [(i, "needle in a stack") for i in range(2_000, 0, -1)] + [(None, "needle in a stack")]
    documents += [(i, "hay") for i in range(5_000, 7_000)]
    found = ranked(spark, documents, [("n", "needle")])
    assert [doc for _, _, doc, _ in sorted(found, key=lambda x: x[1])] == [None, *range(1, 10)]


def test_repeated_items_and_documents_count_each(spark):
    documents = [(1, "red apple"), (1, "red apple"), (2, "green pear"), (3, "pear"), (4, "plum"), (5, "kiwi"), (6, "fig")]
    items = [("f", "apple pear"), ("f", "apple pear")]
    assert ranked(spark, documents, items) == sorted(brute(documents, items))


def test_empty_tables(spark):
    assert ranked(spark, [], [("a", "b")]) == []
    assert ranked(spark, [(1, "b")], []) == []
    assert ranked(spark, [], []) == []


def test_columns_that_clash(spark, docs):
    table = docs(["red apple", "pear", "plum", "fig"])  # columns key, source besides
    items = spark.createDataFrame([(1, "pear", 5)], "item_id int, text string, rank int")
    assert [tuple(r)[:3] for r in rank_documents(table, items).collect()] == [(1, 1, 1)]


def test_scan_by_stretches_finds_whole_terms_only():
    block = make_block([0], ["he her she"], pa.int64())
    found = guarded(block.terms)
    texts = ["he-her-heher", None, "", "SHE he", "x" * 200 + " her " + "y" * 90 + "her her"]
    wide = [x.tolist() for x in occurrences(found, pa.array(texts))]
    assert wide[0] == [3, 0, 0, 2, 4]
    names = [x.decode() for x in block.terms]
    assert [(t, names[n], k) for t, n, k in zip(*wide[1:])] == [
        (0, "he", 1), (0, "her", 1), (3, "he", 1), (3, "she", 1), (4, "her", 2),
    ]
    for stretch in (1, 7, 64):
        assert [x.tolist() for x in occurrences(found, pa.array(texts), stretch)] == wide


def test_scores_by_small_groups(spark, monkeypatch):
    documents, items = made(3, 60), [(f"i{i}", t) for i, t in made(4, 5)]
    block = make_block([i for i, _ in items], [t for _, t in items], pa.string())
    found = occurrences(guarded(block.terms), pa.array([t for _, t in documents]))
    n_docs, n_terms = sum(x > 0 for x in found[0]), int(found[0].sum())
    df = Counter(found[2].tolist())
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[i] + 1))) for i in range(len(block.terms))]
    m = 25 + 75 * found[0] * n_docs // n_terms
    for cells in (1, 50, 1 << 19):
        monkeypatch.setattr(term_scan, "_CELLS", cells)
        best = term_scan.Best(len(items), 3)
        keys = pa.array([i for i, _ in documents])
        term_scan.add_scores(best, block, term_scan.np.array(weight), keys, m, found[1:])
        rows = best.rows.to_pydict()
        got = sorted((items[i][0], d, s) for i, d, s in zip(rows["item"], rows["key"], rows["score"]))
        assert got == sorted((i, d, s) for i, _, d, s in brute(documents, items, 3))

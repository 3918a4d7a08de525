from __future__ import annotations

import random
import re

from tillweave.llm import near_copies as near

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    have = WORD.findall(text or "")
    if not have:
        return frozenset()
    return frozenset(tuple(have[i : i + 5]) for i in range(max(1, len(have) - 4)))


def brute(texts):
    sets = [shingles(t) for t in texts]
    n = len(sets)
    links, root = [0] * n, list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    same = [min(j for j in range(n) if sets[j] == sets[i]) if sets[i] else i for i in range(n)]
    copies = [sum(s == sets[i] for s in sets) if sets[i] else 1 for i in range(n)]
    return [(top(i), links[i], same[i], copies[i]) for i in range(n)]


def sample():
    rng = random.Random(3)
    word = lambda: rng.choice("ab") + str(rng.randint(0, 400))
    passage = [word() for _ in range(30)]
    texts = [None, "", " \t", "one two", "one two", "One two", "a b c d e", "a b c d e f"]
    for _ in range(25):
        base = [word() for _ in range(rng.randint(40, 200))]
        for _ in range(rng.randint(1, 5)):
            other = list(base)
            for _ in range(rng.randint(0, 4)):
                other[rng.randrange(len(other))] = word()
            texts.append(" ".join(other + (passage if rng.random() < 0.3 else [])))
    hot = [word() for _ in range(120)]
    for _ in range(40):
        other = list(hot)
        other[rng.randrange(len(other))] = word()
        texts.append("  ".join(other))
    return texts + [texts[10]] * 6


def run(frame, **options):
    return {
        r["doc_id"]: (r["class_id"], r["n_links"], r["copy_of"], r["n_copies"])
        for r in near.near_copies(frame, **options).collect()
    }


def test_equals_brute_force(docs):
    texts = sample()
    want = brute(texts)
    assert max(x[1] for x in want) > 30
    found = run(docs(texts).repartition(3))
    assert [found[i] for i in range(len(texts))] == want


def test_split_buckets_blocks_and_shuffled_texts_give_the_same(docs):
    texts = sample()
    found = run(docs(texts), limit=6, recall=0.999999, broadcast_rows=0)
    assert [found[i] for i in range(len(texts))] == brute(texts)


def test_one_of_each_keeps_clean_rows_once(docs):
    text = " ".join(map(str, range(30)))
    frame = docs([text, text, text + " x", "other words", None, "", None], [3, 3, 9, 4, 5, 6, None])
    kept = near.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect() if r["text"]) == [(3, text), (4, "other words")]
    assert kept.count() == 5


def test_empty_table(docs):
    assert near.near_copies(docs([])).count() == 0
    assert near.one_of_each(docs([])).count() == 0

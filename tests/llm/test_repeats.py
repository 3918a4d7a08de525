from __future__ import annotations

import random
import re
from collections import Counter

from tillweave.llm import repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts):
    have = [WORD.findall(t or "") for t in texts]
    size = repeats.WINDOW
    seen = Counter(tuple(w[i : i + size]) for w in have for i in range(len(w) - size + 1))
    out = []
    for w in have:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_cover_holds_every_difference():
    assert {(a - b) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER} == set(range(repeats.PERIOD))


def sample():
    rng = random.Random(2)
    word = lambda: rng.choice(["der", "die", "é ", "the\n", "of\t", "Of"]) + str(rng.randint(0, 30))
    make = lambda n: [word() for _ in range(n)]
    shared = [make(n) for n in (33, 34, 35, 36, 70, 120)]
    texts = [None, "", " \n ", "one", " ".join(make(34)), "a " * 200, "a " * 35, "a " * 34]
    for _ in range(80):
        parts = make(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            parts += rng.choice(shared)[rng.choice([0, 0, 1, 5]) :] + make(rng.randint(0, 30))
        texts.append(" ".join(parts))
    return texts + [texts[20]] * 3 + [" ".join(shared[5])] * 40


def test_equals_brute_force_in_any_partitioning(docs, spark):
    texts = sample()
    want = brute(texts)
    for parts in (1, 5):
        rows = repeats.remove_repeats(docs(texts).repartition(parts)).collect()
        found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in rows}
        assert [found[i] for i in range(len(texts))] == want and len(rows) == len(texts)


def test_repeated_rows_null_ids_and_empty_table(docs):
    text = " ".join(map(str, range(40)))
    rows = repeats.remove_repeats(docs([text, text, "a b", "a b"], [1, 1, None, None])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"], r["kept"]) for r in rows) == [(0, 0, "a b")] * 2 + [(1, 40, "")] * 2
    assert repeats.remove_repeats(docs([])).count() == 0

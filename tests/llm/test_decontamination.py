from __future__ import annotations

import random
import re

from tillweave.llm.decontamination import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    out = []
    for text in texts:
        have, hit, found = words(text), set(), set()
        for item, body in items:
            of = words(body)
            size = min(10, len(of))
            windows = {tuple(of[i : i + size]) for i in range(len(of) - size + 1)} if size else set()
            for i in range(len(have) - size + 1):
                if size and tuple(have[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(item)
        out.append((len(have), sorted(hit), sorted(found)))
    return out


def run(docs, bench, **more):
    found = {}
    for row in decontaminate(docs, bench, **more).collect():
        hit = [i for b, e in row["spans"] for i in range(b, e)]
        found.setdefault(row["doc_id"], []).append((row["n_words"], hit, sorted(row["items"])))
    return found


def sample():
    rng = random.Random(5)
    vocabulary = ["a", "b", "é", "Cd", "7"]
    make = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", ".\n"]) for _ in range(n))
    items = [(i, make(rng.choice([1, 2, 6, 9, 10, 11, 30]) + 3)) for i in range(40)]
    items += [(90, None), (91, ""), (92, "..."), (93, "rare word"), (94, items[0][1])]
    texts = [None, "", "-- --", "A rare WORD here", items[5][1], "x " * 5000 + items[7][1]]
    for _ in range(60):
        parts = [make(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            body = words(rng.choice(items)[1])
            at = rng.randint(0, max(0, len(body) - 1))
            parts += [" ".join(body[at : at + rng.randint(5, 20)]), make(rng.randint(0, 8))]
        texts.append(" ".join(parts))
    return texts + texts[-3:], items


def test_equals_brute_force_with_one_and_with_several_blocks(spark, docs):
    texts, items = sample()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts, items)
    for block_bytes in (1 << 20, 300):
        found = run(docs(texts).repartition(3), bench, block_bytes=block_bytes)
        assert [found[i] for i in range(len(texts))] == [[x] for x in want]


def test_repeated_ids_empty_tables_and_null_ids(spark, docs):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    twice = run(docs(["one two three", "one two three", "none"], [7, 7, None]), bench)
    assert twice[7] == [(3, [0, 1, 2], [1])] * 2 and twice[None] == [(1, [], [])]
    assert run(docs([]), bench) == {}
    none = spark.createDataFrame([], "item_id long, text string")
    assert run(docs(["one two three"]), none)[0] == [(3, [], [])]

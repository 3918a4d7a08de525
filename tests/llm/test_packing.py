from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from tillweave.llm import packing

FILE = path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_plan_holds_exactly_the_histogram(lengths):
    histogram = np.bincount(lengths, minlength=65) if lengths else np.zeros(65, int)
    plan = packing.pack_histogram(histogram, 64)
    used = Counter(x for one, n in plan for x in one for _ in range(n))
    assert used == Counter(lengths)
    assert all(sum(one) <= 64 and n > 0 for one, n in plan)


def test_plan_is_tight():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(6, 1, 20_000).astype(int) + 1, 2048)
    plan = packing.pack_histogram(np.bincount(lengths, minlength=2049), 2048)
    assert sum(n for _, n in plan) <= 1.002 * -(-int(lengths.sum()) // 2048)


def check(rows, texts):
    library = Tokenizer.from_file(FILE)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        have = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in have] == list(range(-(-len(ids) // 2048)))
        for r in have:
            part = ids[r["piece"] * 2048 : (r["piece"] + 1) * 2048]
            assert (r["start"], r["length"]) == (r["piece"] * 2048, len(part))
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    return len(by_sequence)


def test_pieces_and_places(docs):
    rng = random.Random(4)
    texts = [None, "", " ", "word " * 7000, "<|endoftext|> x"]
    texts += [" ".join(rng.choice(["the", "tion", "é"]) for _ in range(rng.randint(1, 3000))) for _ in range(120)]
    texts += ["same text"] * 60
    rows = packing.pack(docs(texts).repartition(3), FILE, rows_per_group=10).collect()
    total = sum(r["length"] for r in rows)
    assert check(rows, texts) <= -(-total // 2048) + 2


def test_empty_table_and_repeated_rows(docs):
    assert packing.pack(docs([]), FILE).count() == 0
    rows = packing.pack(docs(["a", "a"], [1, 1]), FILE).collect()
    assert sorted(r["offset"] for r in rows) == [0, 2] and len({r["sequence_id"] for r in rows}) == 1

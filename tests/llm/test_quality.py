from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from tillweave.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            hit.update(range(i, i + 8))
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            n < 20 or 100 * len(hit) > 30 * n)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def verdicts(rows, most, share):
    lines, texts = defaultdict(set), defaultdict(set)
    norm = lambda x: " ".join(WORD.findall(lower(x)))
    for text, host in rows:
        texts[host].add(text)
        for x in (text or "").split("\n"):
            if norm(x):
                lines[host, norm(x)].add(text)
    out = []
    for text, host in rows:
        common = {k for (h, k), v in lines.items() if h == host and len(v) > most and len(v) > share * len(texts[host])}
        lost = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if norm(x) in common)
        b = base(text)
        left = "\n".join(x for x in (text or "").split("\n") if norm(x) not in common)
        out.append((*b, lost, not b[5] and (b[0] - lost) * 2 >= b[0], left))
    return out


def sample():
    rng = random.Random(6)
    word = lambda: rng.choice(["Ä", "b|", "c#d", "Ee", "f"]) + str(rng.randint(0, 99))
    line = lambda n: rng.choice([" ", "\t"]).join(word() for _ in range(n))
    footer = [line(12), line(30)]
    rows = [(None, "s0"), ("", "s0"), (" \n\t", None), (line(25), None), ("a b c d e f g h " * 30, "s1"), ("x " * 20_000, "s1")]
    for i in range(90):
        parts = [line(rng.randint(0, 15)) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.4:
            parts.append(rng.choice([footer[0], footer[0].upper(), " " + footer[1]]))
        if rng.random() < 0.3:
            parts.append(parts[0])
        rows.append(("\n".join(parts), rng.choice(["s0", "s1", None])))
    return rows + [rows[-1]] * 12


def test_equals_brute_force(spark):
    rows = sample()
    frame = spark.createDataFrame([(i, t, h, "x") for i, (t, h) in enumerate(rows)], "doc_id long, text string, source string, key string")
    judged = quality.judge(frame.repartition(3), most_documents=6, most_share=0.05)
    found = {r["doc_id"]: r for r in judged.collect()}
    want = verdicts(rows, 6, 0.05)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_common_words", "kept"]
    assert [tuple(found[i][x] for x in names) for i in range(len(rows))] == [x[:-1] for x in want]
    assert 5 < sum(x[6] > 0 for x in want) and any(x[5] != (not x[7]) for x in want)
    cleaned = quality.without_common_lines(frame, judged)
    assert cleaned.columns == frame.columns
    assert sorted((r["doc_id"], r["text"]) for r in cleaned.collect()) == [(i, x[-1]) for i, x in enumerate(want) if x[7]]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, source string")
    assert quality.judge(frame).count() == 0


def test_the_limit_is_the_same_for_hosts_of_every_size(spark):
    footer = "all rights reserved by the owners of this site"
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"{words} {i}" + f"\n{footer}" * (i < 21)) for i in range(21_500)]
    frame = spark.createDataFrame([(i, t, "hot") for i, t in rows], "doc_id long, text string, source string")
    small = frame.where("doc_id < 30").selectExpr("doc_id + 100000 as doc_id", "text", "'small' as source")
    judged = quality.judge(frame.unionByName(small))
    found = judged.where("n_common_words > 0").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in found) == [*range(21), *range(100_000, 100_021)]

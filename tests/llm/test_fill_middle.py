from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillweave.llm import fill_middle
from tillweave.llm.fill_middle import Sentinels, arrange, fill_in_middle, rebuild, restored, rotate, scan_cuts


def expected(doc_id, text):
    text = text or ""
    n, h = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (n, "plain", None, None, text)
    p, m, s = text[:low], text[low:high], text[high:]
    if h4 % 100 < 20:
        return (n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}")
    return (n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}")


def held(rows):
    return {r["doc_id"]: (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows}


def test_every_form_as_by_brute_force_and_back(docs):
    rng = random.Random(5)
    texts = ["".join(rng.choice("aé日😀 <P>\nS") for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    texts += ["", None, "<P> stays", "a<S", "<", "😀", "x" * 3]
    table = docs(texts)
    done = restored(fill_in_middle(table)).collect()
    assert held(done) == {i: expected(i, t) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["restored"] for r in done} == {i: t or "" for i, t in enumerate(texts)}
    assert {r["form"] for r in done} == {"plain", "psm", "spm"}


def test_null_keys_repeated_rows_and_empty_tables(docs):
    rows = fill_in_middle(docs(["one two three", "one two three", "four"], ids=[7, 7, None])).collect()
    assert sorted((r["output"] for r in rows)) == sorted([expected(7, "one two three")[4]] * 2 + [expected(None, "four")[4]])
    empty = docs(["x"]).where("false")
    assert restored(fill_in_middle(empty)).count() == 0
    with pytest.raises(ValueError, match="already"):
        restored(fill_in_middle(empty), name="form")


def test_long_texts_are_scanned_and_rotated_by_steps(docs, monkeypatch):
    text = "né 日本 " * 300_000
    row = restored(fill_in_middle(docs([text], ids=[3]))).first()
    assert row["restored"] == text
    assert (row["n"], row["form"], row["prefix_chars"], row["middle_chars"], row["output"]) == expected(3, text)
    monkeypatch.setattr(fill_middle, "_STEP", 3)
    data = np.frombuffer("aé日😀b".encode(), np.uint8)
    assert [scan_cuts(data, (i, i)) for i in range(6)] == [(x, x) for x in (0, 1, 3, 6, 10, 11)]
    for cut in range(12):
        block = bytearray(range(12))
        rotate(block, 1, max(cut, 1), 12)
        assert list(block) == [0, *range(max(cut, 1), 12), *range(1, max(cut, 1))]


def test_other_sentinels_hold_what_makes_them_findable():
    marks = Sentinels(b"\x01a", b"\x01bc", b"\x01d")
    for form in ("psm", "spm", "plain"):
        block = arrange(b"01234567", (2, 5), form, marks)
        assert rebuild(bytes(block), form, marks) == b"01234567"
    assert arrange(b"01234567", (2, 5), "spm", marks) == b"\x01bc567\x01a01\x01d234"
    for bad in ((b"<P>", b"<P>", b"<M>"), (b"", b"b", b"c"), (b"ab", b"b", b"c")):
        with pytest.raises(ValueError, match="sentinels"):
            Sentinels(*bad)


def test_only_named_columns_are_read(docs):
    table = docs(["one two", "three"]).withColumn("n", F.lit(9)).withColumn("output", F.lit("z"))
    assert held(fill_in_middle(table).collect()) == {i: expected(i, t) for i, t in enumerate(["one two", "three"])}

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from tillweave.llm import planes
from tillweave.operators.materialize import scratch_path

FILE = path("word_bpe_49k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from(["bit", "byte"]))
def test_blocks_round_trip(ids, kind):
    payload = planes.encode_block(np.array(ids, np.uint32), kind)
    assert planes.decode_block(payload).tolist() == ids


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        planes.decode_block(b"none" + bytes(40))


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_files_give_back_every_document(spark, docs, kind):
    rng = random.Random(8)
    texts = [None, "", " ", "word " * 900]
    texts += [" ".join(rng.choice(["the", "tion", "é"]) for _ in range(rng.randint(1, 90))) for _ in range(100)]
    frame = docs(texts).repartition(4)
    folder = scratch_path(spark, "planes")
    planes.write_ids(frame, folder, FILE, block_ids=256, planes=kind)
    library = Tokenizer.from_file(FILE)
    want, at = [], 0
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        at += len(ids)
    found = planes.read_ids(spark, folder, "long").collect()
    assert sorted(tuple(bytes(x) if isinstance(x, bytearray) else x for x in row) for row in found) == want
    index = spark.read.parquet(f"{folder}/kind=chunk")
    assert index.agg({"n": "sum"}).first()[0] == at


def test_empty_table_repeated_and_null_keys(spark, docs):
    for texts, ids in (([], None), (["a", "a", "b", None], [2, 2, None, None])):
        folder = scratch_path(spark, "planes")
        planes.write_ids(docs(texts, ids), folder, FILE)
        rows = planes.read_ids(spark, folder, "long", ids=False).collect()
        assert len(rows) == len(texts)
        assert sorted(r["start"] for r in rows) == [0, 2, 3, 5][: len(rows)] or sorted(r["start"] for r in rows) == [0, 1, 3, 5]

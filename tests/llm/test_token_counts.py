from __future__ import annotations

import random

from public_tokenizers import path
from tokenizers import Tokenizer

from tillweave.llm.token_counts import count_tokens

PARTS = ["'s", "'re", "'LL", "a", "B", "é", "|", ">", "<|endoftext|>", "<|ENDOFTEXT|>", "H̱", "Á", "́",
         "1", "²", "€", ",", ".", "'", "-", "(", " ", "\n", "\x1c", " ", "İ", "ß", "word", "the", "日", "\x00", "🤖", "<|"]


def test_counts_equal_the_library(docs):
    rng = random.Random(11)
    texts = [None, "", " \n", "aaaa" * 50, "word " * 30_000, "x" * 20_000, *(chr(c) + "a" for c in range(0x80, 0x180))]
    texts += ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    texts += texts[-2:]
    file = path("word_bpe_49k.json")
    library = Tokenizer.from_file(file)
    want = [(len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for t in texts]
    rows = count_tokens(docs(texts), file).collect()
    found = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in rows}
    assert [found[i] for i in range(len(texts))] == want


def test_empty_table_and_repeated_ids(docs):
    file = path("word_bpe_49k.json")
    assert count_tokens(docs([]), file).count() == 0
    assert len(count_tokens(docs(["a", "a"], [1, 1]), file).collect()) == 2

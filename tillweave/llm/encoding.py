"""Token ids of whole texts by the tokenizers library, inside Spark tasks.

Only for tokenizers whose pre-tokens never cross white space and whose ids don't depend on it, as those that drop
white space (``word_bpe_49k.json``): a text's ids are then those of its space-free chunks in order. Each distinct
chunk is given to the library once; special strings are never cut and so keep the library's default. A chunk of
nothing but letters below U+0100 is one pre-token, which goes to the library's model in lower case.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tillweave.llm.textwords import Memo, Words, read_chunks, sums_per_text


def latin_letters(tokenizer: Tokenizer) -> dict[int, str]:
    """What the library's byte-level step makes of each letter below U+0100."""
    letters = (chr(x) for x in range(0x80, 0x100) if chr(x).isalpha())
    return {ord(x): tokenizer.pre_tokenizer.pre_tokenize_str(x)[0][0] for x in letters}


def _library(path: str):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    model, letters = tokenizer.model, latin_letters(tokenizer)

    def ids(chunk: bytes) -> list[int]:
        text = chunk.decode("utf-8", "replace")
        if chunk.isalpha():  # of bytes: ASCII letters
            return [token.id for token in model.tokenize(text.lower())]
        if text.isalpha() and max(text) < "\u0100":
            return [token.id for token in model.tokenize(text.lower().translate(letters))]
        return tokenizer.encode(text, add_special_tokens=False).ids

    def compute(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        each = [ids(chunk) for chunk in chunks]
        return np.array(list(map(len, each)), np.int64), np.array([i for x in each for i in x], np.int32)

    return compute


@cache
def chunk_ids(path: str) -> Memo:
    """One memo per worker process and vocabulary file."""
    return Memo(_library(path))


def token_ids(path: str, texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """The chunks of the texts, the ids of all texts in a row, and where each text's ids begin (and the end)."""
    words = read_chunks(texts)
    size, ids = chunk_ids(path)(words)
    first = np.zeros(len(words.first), np.int64)
    first[1:] = np.cumsum(sums_per_text(size, words.first))
    return words, ids, first

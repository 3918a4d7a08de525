"""Token counts by rank-synchronous merging of numpy arrays.

The pre-tokens of a batch are held as one ragged array of symbols. In each round every sequence finds the lowest rank
among its neighbouring pairs, and all occurrences of that pair are merged at once in all sequences; sequences without
a mergeable pair drop out with the number of symbols left, which is their number of tokens. Ranks come from the
merges of a public vocabulary file; normalising and cutting into pre-tokens is that file's own definition.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows give repeated results. Columns of the input other than
the two named are ignored, so clashing names don't matter.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillweave.llm.encoding import latin_letters
from tillweave.llm.textwords import Memo, pieces, ragged, read_chunks, sums_per_text

_NONE = np.iinfo(np.int64).max
#: The cuts of printable lower-case ASCII under the vocabulary's own pattern, which the library applies to all else.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_PRINTABLE = re.compile(rb"[!-~]+")


class RankMerger:
    """Merges of one vocabulary file, applied to many sequences at a time."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in merges]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        result = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.result = key[order], order.astype(np.int64), result[order]
        self.vocab = vocab
        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.cutter = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.letters = latin_letters(tokenizer)
        special = [x["content"] for x in spec.get("added_tokens", [])]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.marks = tuple({x[:2].encode() for x in special})

    def pre_tokens(self, chunk: bytes) -> tuple[int, list[str]]:
        """How many special tokens a space-free chunk holds, and its pre-tokens."""
        if _PRINTABLE.fullmatch(chunk) and not any(mark in chunk for mark in self.marks):
            return 0, _ASCII.findall(chunk.decode().lower())
        text = chunk.decode("utf-8", "replace")
        if text.isalpha() and max(text) < "\u0100":
            return 0, [text.lower().translate(self.letters)]
        parts = self.special.split(text) if self.special else [text]
        cuts: list[str] = []
        for part in parts[::2]:
            if part:
                cuts.extend(x for x, _ in self.cutter.pre_tokenize_str(self.normalizer.normalize_str(part)))
        return len(parts) // 2, cuts

    def symbols(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The first symbols of pre-tokens as one ragged array, and the length of each."""
        size = np.array([len(x) for x in tokens], np.int64)
        vocab, suffix = self.vocab, self.suffix
        flat = np.array([vocab[c] for x in tokens for c in (*x[:-1], x[-1] + suffix)], np.int64)
        return flat, size

    def counts(self, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The number of symbols that are left of each (non-empty) sequence when nothing can be merged any more."""
        out = size.copy()
        alive = np.flatnonzero(size > 1)
        sym = flat[ragged((np.cumsum(size) - size)[alive], size[alive])]
        size = size[alive]
        while len(alive):
            first = np.cumsum(size) - size
            last = first + size - 1
            pair = np.empty(len(sym), np.int64)
            pair[:-1] = sym[:-1] << 32 | sym[1:]
            pair[last] = -1
            at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
            rank = np.where(self.key[at] == pair, self.rank[at], _NONE)
            best = np.minimum.reduceat(rank, first)
            hit = (rank == np.repeat(best, size)) & (rank < _NONE)
            # Of overlapping occurrences, as in "aaa", every second one counts, from the left.
            run = np.flatnonzero(hit)
            begins = np.r_[True, np.diff(run) > 1] if len(run) else np.empty(0, bool)
            place = np.arange(len(run)) - np.maximum.accumulate(np.where(begins, np.arange(len(run)), 0))
            run = run[place % 2 == 0]
            sym[run] = self.result[at[run]]
            keep = np.ones(len(sym), bool)
            keep[run + 1] = False
            left = np.add.reduceat(keep, first)
            out[alive] = left
            going = (best < _NONE) & (left > 1)
            sym = sym[keep & np.repeat(going, size)]
            alive, size = alive[going], left[going]
        return out

    def chunk_counts(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.pre_tokens(chunk) for chunk in chunks]
        flat, size = self.symbols([x for _, tokens in cut for x in tokens])
        each = np.array([len(tokens) for _, tokens in cut], np.int64)
        total = sums_per_text(self.counts(flat, size), np.r_[0, np.cumsum(each)])
        total += np.array([n for n, _ in cut], np.int64)
        return np.ones(len(chunks), np.int64), total


@cache
def _memo(path: str) -> Memo:
    return Memo(RankMerger(path).chunk_counts)


def count_tokens(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens) of every row; no shuffle. ``vocabulary``: a file that every executor has."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(vocabulary)
        for piece in pieces(batches, "text"):
            words = read_chunks(piece.column(1))
            _, tokens = memo(words)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(np.diff(words.offsets)), pa.array(sums_per_text(tokens, words.first))],
                ["key", "n_bytes", "n_tokens"],
            )

    out = rows.mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("key", key)

"""Words of whole texts as numpy arrays, for functions that run inside ``mapInArrow`` tasks.

A column of texts arrives as one UTF-8 buffer with offsets. Words are found and hashed over the whole buffer at once:
every byte value has a fixed random 64-bit number, a word's hash is the polynomial of its bytes' numbers modulo 2**64,
taken as a difference of running sums and then mixed. Hashes depend on nothing but the word's bytes, so they are the
same in every task. Two different words or windows are taken as equal with a probability of about 2**-64.

A null text has no words. A text may be longer than a piece; it is then a piece of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

PIECE_BYTES = 4 << 20
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
_set = getattr(ctypes.CDLL(None), "mallopt", None)
_CHUNK = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = np.asarray(x, _U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and ``base ** -i`` modulo 2**64 for i below n; an odd base has an inverse."""
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n, b, _U)
        steps[:1] = 1
        both.append(np.cumprod(steps, dtype=_U))
    return both[0], both[1]


_BYTE_NUMBERS = mix(np.arange(1, 257, dtype=_U) * _U(0x632BE59BD9B4E019))
_POWER, _INVERSE = _powers(_BASE, _CHUNK)
_window_powers: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true for the bytes in the given closed ranges."""
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


#: Separators of words ``[^\x20\x09-\x0D]+``.
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Separators of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased.
NON_ALPHANUMERIC = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A))
_AS_IS = np.arange(256, dtype=np.uint8)
_LOWER = _AS_IS + np.where(byte_set((0x41, 0x5A)), 32, 0).astype(np.uint8)


@dataclass
class Words:
    """The words of some texts: text i has the words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashed: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def bytes_of(self, at: int) -> bytes:
        return self.data[self.start[at] : self.end[at]].tobytes()

    def windows(self, length: int, which: int = 0) -> np.ndarray:
        """Hashes of the windows of ``length`` words that start at each word, in or out of its text."""
        return window_hashes(self.hashed, length, which)

    def window_fits(self, length: int) -> np.ndarray:
        """For each word, whether a window that starts there ends within its text."""
        return np.arange(len(self.hashed)) + length <= np.repeat(self.first[1:], self.counts)


def window_hashes(hashed: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hashes of ``length`` consecutive values from each place; what reaches past the end has no meaning."""
    n = len(hashed)
    known = _window_powers.get(which)
    if known is None or known[0] < n + 1:
        size = max(1 << 20, n + 1)
        known = _window_powers[which] = (size, *_powers(_WINDOW_BASES[which], size))
    sums = np.zeros(n + 1, _U)
    np.cumsum(hashed * known[1][:n], out=sums[1:])
    ends = np.minimum(np.arange(n) + length, n)
    return mix((sums[ends] - sums[:n]) * known[2][:n] + _U(length))


def _hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), _U)
    at = 0
    while at < len(start):
        low = start[at]
        upto = max(int(np.searchsorted(end, low + _CHUNK, "right")), at + 1)
        s, e = start[at:upto] - low, end[at:upto] - low
        size = int(e[-1])
        power, inverse = (_POWER, _INVERSE) if size <= _CHUNK else _powers(_BASE, size)
        sums = np.zeros(size + 1, _U)
        np.cumsum(_BYTE_NUMBERS[data[low : low + size]] * power[:size], out=sums[1:])
        out[at:upto] = (sums[e] - sums[s]) * inverse[s]
        at = upto
    return mix(out)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and each text's offsets; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, places, data = texts.buffers()
    offsets = np.zeros(1, np.int64)
    if len(texts):
        offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def read_words(
    texts: pa.Array, separators: np.ndarray = SPACES, lower: bool = False, kinds: np.ndarray | None = None
) -> Words:
    """Words between separators. With ``kinds``, a table of bits for each byte, a word is also cut between two bytes
    of which the first has bit 1 and the second bit 2, or the first has bit 4 and the second bit 8; the caller then
    hashes them."""
    data, offsets = flat(texts)
    if lower:
        data = _LOWER[data]
    inside = ~separators[data]
    linked = np.zeros(len(data) + 1, bool)  # whether the bytes before and at a place belong to one word
    linked[1:-1] = inside[:-1] & inside[1:]
    linked[offsets[:-1]] = False
    if kinds is not None:
        kind = kinds[data]
        linked[1:-1] &= (kind[:-1] & (kind[1:] >> 1) & 5) == 0
    start = np.flatnonzero(inside & ~linked[:-1])
    end = np.flatnonzero(inside & ~linked[1:]) + 1
    hashed = _hash_words(data, start, end) if kinds is None else np.empty(0, _U)
    return Words(data, offsets, start, end, hashed, np.searchsorted(start, offsets))


#: How bytes cut a chunk: ASCII letters end before and begin after any punctuation but "'" and "|".
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x21:0x7F] = 6
_KINDS[ord("'")] = 2
_KINDS[ord("|")] = 0
_KINDS[0x30:0x3A] = 0
_KINDS[_LETTERS] = 9


def read_chunks(texts: pa.Array) -> Words:
    """Space-free chunks whose tokens don't depend on what surrounds them; those of nothing but ASCII letters count
    as equal whatever their case (the vocabulary is one of lower case)."""
    words = read_words(texts, kinds=_KINDS)
    others = np.zeros(len(words.data) + 1, np.int32)
    np.cumsum(~_LETTERS[words.data], out=others[1:])
    mixed = others[words.end] > others[words.start]
    exact = _hash_words(words.data, words.start[mixed], words.end[mixed])
    words.hashed = _hash_words(_LOWER[words.data], words.start, words.end)
    words.hashed[mixed] = exact
    return words


def pieces(batches: Iterable[pa.RecordBatch], text: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece hold about ``most`` bytes, or one text."""
    try:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            _, offsets = flat(column)
            at = 0
            while at < len(column):
                upto = max(int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1, at + 1)
                yield batch.slice(at, upto - at)
                at = upto
            del batch, column, offsets
    finally:
        give_back()


def give_back() -> None:
    """Return what a task has freed to the system: workers wait for other tasks, and would keep it meanwhile."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def keep_freed(most: int = 64 << 20) -> None:
    """Let a worker use again what it freed, up to ``most`` bytes, before the system has it back: arrays of some MB would
    otherwise be cleared by the system each time they are made. ``give_back`` returns it."""
    if _set is not None:
        _set(-1, most)  # M_TRIM_THRESHOLD
        _set(-3, min(most, 32 << 20))  # M_MMAP_THRESHOLD


def segments(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Regroup batches sorted by ``key`` so that all rows of a key come in one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        first = int(np.searchsorted(keys, keys[-1], "left"))
        held_key = held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() if held else None
        if first or held and held_key != keys[0]:
            cut = first if first else 0
            done = [*held, batch.slice(0, cut)] if cut else held
            yield joined(done)
            held = []
        held.append(batch.slice(first))
    if held:
        yield joined(held)


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


class Memo:
    """Values of words, computed once per distinct word and kept up to a number of words.

    ``compute`` takes the bytes of some words and returns how many values each has, and all values in a row. What is
    kept only saves time: when ``most`` words are exceeded, it starts anew with the words at hand.
    """

    def __init__(self, compute, most: int = 1 << 19) -> None:
        self.compute, self.most = compute, most
        self.forget()

    def forget(self) -> None:
        self.known = np.empty(0, _U)
        self.begin, self.size = np.empty(0, np.int32), np.empty(0, np.int32)
        self.values: list[np.ndarray] = []
        self.total = 0

    def _missing(self, distinct: np.ndarray) -> np.ndarray:
        found = np.searchsorted(self.known, distinct)
        missing = np.ones(len(distinct), bool)
        inside = found < len(self.known)
        missing[inside] = self.known[found[inside]] != distinct[inside]
        return missing

    def __call__(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """How many values each word has, and the values of all words in order."""
        inverse, distinct = pd.factorize(words.hashed)
        sample = np.empty(len(distinct), np.int64)
        sample[inverse[::-1]] = np.arange(len(inverse))[::-1]
        missing = self._missing(distinct)
        if len(self.known) + int(missing.sum()) > self.most:
            self.forget()
            missing = self._missing(distinct)
        if missing.any():
            order = np.flatnonzero(missing)[np.argsort(distinct[missing])]
            size, values = self.compute([words.bytes_of(at) for at in sample[order]])
            at = np.searchsorted(self.known, distinct[order])
            self.begin = np.insert(self.begin, at, np.cumsum(size) - size + self.total)
            self.size = np.insert(self.size, at, size)
            self.known = np.insert(self.known, at, distinct[order])
            self.values = [np.concatenate([*self.values, values.astype(np.int32)])]
            self.total += len(values)
        found = np.searchsorted(self.known, distinct)
        size = self.size[found][inverse].astype(np.int64)
        begin = self.begin[found][inverse].astype(np.int64)
        return size, self.values[0][ragged(begin, size)] if self.values else np.empty(0, np.int32)


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``begin[i] .. begin[i] + size[i] - 1`` of all i in a row."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begin - (ends - size), size)


def sums_per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of one value per word over each text's words."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]

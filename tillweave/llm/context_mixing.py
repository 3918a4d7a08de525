"""Language-model scores by logistic context mixing, with a unigram score beside them.

A text is a sequence of tokens, its words (runs of anything but white space, A-Z in lower case) and an end. Tokens are
coded as binary decisions: the most frequent words, the end and an escape by a Huffman code of their counts. Three
predictors know how often a decision went either way: the decision alone, after the last word, and after the last two.
Their log odds are mixed by weights that a gate picks by how much the longer contexts have seen, and the mix is refined
by what actually happened after mixes like it. After an escape a word of training is coded by its count, less a
discount; what the discount takes off is the chance of a new word, which is spelled: the bits of its bytes and a closing
space are decisions of the same mix, alone (after the last byte), after the last two bytes and after the last four.

Contexts are counted in full, over the whole corpus, so what is gathered grows with it; they don't share counts (words
are told apart by 64-bit hashes). A task cuts its texts into pieces and packs the grams of a piece (contexts, symbol,
number of the text, times) into byte planes, one payload for each bucket of contexts, so that one shuffle of some 6 bytes
a token brings all counts of a context together. There the counts at every decision on the way to a symbol are summed,
each distinct gram is costed once, and what goes back is a sum for each text of each payload. A frequent context's rows
are salted by the context before it; each bucket with a part of them is given the counts after the context, which are
summed beforehand. Rows of one pair of contexts are together: at most one of each text and symbol.

Weights and refinement are fitted in each bucket of contexts, to every training occurrence in it: a decision is predicted
from all occurrences but itself, and counted by its gate and its rounded log odds; the weights are those under which
these counts are likeliest, by Newton's method. All that follows a pair of contexts is in one bucket, so its probabilities
add up to one. A bucket's counts don't depend on the order of its rows. Each training word outside the vocabulary counts
once among the spelled ones.

Broadcast are the most frequent words (``VOCABULARY``, of those met twice) with their code, the counts of decisions
alone. The other words of each text meet their counts in a shuffle join.

Null and empty texts are the end alone. Very long texts are scored whole (such a text is a piece of its own). Repeated
rows are scored alike, and counted each in training. Without training texts every count is 0 and the model is an
untrained one. An empty table gives an empty result. Only the columns named are read. Nothing depends on how rows are
dealt to tasks, up to the order in which a text's costs are added.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.llm.textwords import Words, give_back, joined, keep_freed, mix, pieces, ragged, read_words, sums_per_text
from tillweave.operators.materialize import small_batches, stage, tidy

VOCABULARY = (1 << 16) - 2
_U = np.uint64
_END = np.uint64(0x1D8E4E27C47D124F)  # stands for the end among word hashes
_START = np.uint64(0x3C6EF372FE94F82B)
_BYTE_NODES = 1 << 16  # (byte before, bits of the byte so far)
TAUGHT_ROWS = 1 << 18
_GATES = 32
_INPUTS = 3
_STEPS = 33
_LEVEL = 2 * _STEPS**_INPUTS  # cells of a gate: the step of each input, and the bit
_ROUNDS = 12
_SPELLED = -1  # stands for the checksum of a text where a word is meant
_GROUP_ROWS = 1 << 18
_BUCKET_ROWS = 1 << 19
_CHUNK_ROWS = 1 << 16
_BATCH_BYTES = 4 << 20
_COUNTED_ROWS = 1 << 19


@dataclass
class Code:
    """Of each symbol where its decisions begin and how many. Of all decisions, packed into one number each, the bit
    (1 bit), the path from the node that leads four decisions (4 bits, 1 to 15), that node (28 bits) and the node of
    the decision itself (the rest)."""

    begin: np.ndarray
    size: np.ndarray
    packed: np.ndarray

    @cached_property
    def paths(self) -> np.ndarray:
        """The bits of each symbol, from the top of a number on."""
        depth = (np.arange(len(self.packed)) - np.repeat(self.begin, self.size)).astype(_U)
        return np.bitwise_or.reduceat((self.packed & 1).astype(_U) << (_U(63) - depth), self.begin)

    @cached_property
    def ranks(self) -> np.ndarray:
        """Places of the symbols in the order of their paths."""
        out = np.empty(len(self.paths), np.int64)
        out[np.argsort(self.paths, kind="stable")] = np.arange(len(out))
        return out


def huffman(counts: list[int]) -> Code:
    n = len(counts)
    heap = [(max(c, 1), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    up, side = [0] * (2 * n), [0] * (2 * n)
    free = n
    while len(heap) > 1:
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        up[i] = up[j] = free
        side[j] = 1
        heapq.heappush(heap, (a + b, free))
        free += 1
    size, nodes, bits, leads, paths = [], [], [], [], []
    for i in range(n):
        steps = []
        while i != free - 1:
            steps.append((up[i] - n, side[i]))
            i = up[i]
        steps.reverse()
        size.append(len(steps))
        lead = path = 0
        for at, (node, bit) in enumerate(steps):
            if at % 4 == 0:
                lead, path = node, 1
            nodes.append(node)
            bits.append(bit)
            leads.append(lead)
            paths.append(path)
            path = 2 * path + bit
    sizes = np.array(size, np.int64)
    node, bit, lead, path_to = (np.array(x, np.int64) for x in (nodes, bits, leads, paths))
    return Code(np.cumsum(sizes) - sizes, sizes, node << 33 | lead << 5 | path_to << 1 | bit)


@dataclass
class Coder:
    """The vocabulary by word hash, ascending, with its counts, those of all other words and of ends, and its code; the
    symbols after the words are the escape and the end."""

    hashes: np.ndarray
    counts: np.ndarray
    rest: int
    ends: int
    code: Code

    @property
    def total(self) -> int:
        return int(self.counts.sum()) + self.rest + self.ends

    @cached_property
    def places(self) -> pd.Index:
        return pd.Index(np.r_[self.hashes, _END])

    def symbols(self, hashed: np.ndarray) -> np.ndarray:
        n = len(self.hashes)
        at = self.places.get_indexer(hashed)
        at[at == n] = n + 1
        at[at < 0] = n
        return at


def make_coder(hashes: np.ndarray, counts: np.ndarray, words: int, ends: int) -> Coder:
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    rest = words - int(counts.sum())
    return Coder(hashes, counts, rest, ends, huffman([*counts.tolist(), rest, ends]))


_F = np.float32
#: The probability that stands for each step of the mix before anything is known.
_CENTRE = (1 / (1 + np.exp(-(np.arange(_STEPS) - _STEPS // 2) / 2.0))).astype(_F)


def _levels(seen: np.ndarray) -> np.ndarray:
    """How much a context has seen: nothing, 1 or 2, up to 9, more."""
    return (seen > 0).astype(np.uint8) + (seen > 2) + (seen > 9)


def _mixed(x: Sequence[np.ndarray], weights: np.ndarray, gate: np.ndarray) -> np.ndarray:
    odds = x[0] * weights[:, 0].take(gate)
    for k in range(1, _INPUTS):
        odds += x[k] * weights[:, k].take(gate)
    return np.clip(odds, -14, 14, out=odds)


def _step(odds: np.ndarray) -> np.ndarray:
    most = _STEPS // 2
    return np.clip(np.rint(odds * 2), -most, most).astype(np.int64) + most


@dataclass
class Model:
    """What was learned, ready for scoring: weights and refinement."""

    weights: np.ndarray
    after: np.ndarray

    def mixed_cost(self, x: Sequence[np.ndarray], gate: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """log10 of the probability of each decision: half the mix, half what followed such mixes."""
        odds = _mixed(x, self.weights, gate)
        own = self.after.ravel().take(gate * _STEPS + _step(odds))
        p = np.clip((1 / (1 + np.exp(-odds)) + own) / 2, _F(1e-6), _F(1 - 1e-6))
        return np.log(np.where(bits == 1, p, 1 - p)) * _F(1 / math.log(10))


def make_model(weights: np.ndarray, after: np.ndarray) -> Model:
    own = (after[:, :, 1] + 20 * _CENTRE) / (after.sum(2) + 20)
    return Model(weights.astype(_F), own.astype(_F))


def fitted(cells: np.ndarray) -> Model:
    """The model of some cells: how often decisions of each gate, steps of the inputs and bit were seen."""
    seen = cells.reshape(-1, 2)
    at = np.flatnonzero(seen.any(axis=1))
    zeros, ones = seen[at].T
    gate = at // _STEPS**_INPUTS
    x = np.stack([at // _STEPS**k % _STEPS for k in reversed(range(_INPUTS))]) / 2 - _STEPS // 2 / 2
    start = np.tile([0.6, 0.3, 0.3], (_GATES, 1))
    weights = start.copy()
    for _ in range(_ROUNDS):
        p = 1 / (1 + np.exp(-_mixed(x, weights, gate)))
        error, sure = ones - (zeros + ones) * p, (zeros + ones) * p * (1 - p)
        # The start counts as much as some decisions do.
        slope = np.stack([np.bincount(gate, error * a, _GATES) for a in x], 1) - 20 * (weights - start)
        bend = np.stack([[np.bincount(gate, sure * a * b, _GATES) for a in x] for b in x]).T + 20 * np.eye(_INPUTS)
        weights += np.clip(np.linalg.solve(bend, slope[:, :, None])[:, :, 0], -0.5, 0.5)
    place = (gate * _STEPS + _step(_mixed(x, weights, gate))) * 2
    after = np.bincount(place, zeros, 2 * _GATES * _STEPS) + np.bincount(place + 1, ones, 2 * _GATES * _STEPS)
    return make_model(weights, after.reshape(_GATES, _STEPS, 2))


def _begins(values: np.ndarray) -> np.ndarray:
    return np.r_[True, values[1:] != values[:-1]][: len(values)]


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end after each text's words, and where each text begins (and the end)."""
    n = len(words.first) - 1
    first = words.first + np.arange(n + 1)
    out = np.full(first[-1], _END, _U)
    inside = np.ones(len(out), bool)
    inside[first[1:] - 1] = False
    out[inside] = words.hashed
    return out, first


# --- word counts ------------------------------------------------------------------------------------------------


def _counted(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Rows of (token, n, word) with those of a token as one."""
    batch = joined(held)
    codes, distinct = pd.factorize(batch.column(0).to_numpy())
    if len(distinct) == len(codes):
        return batch
    sample = np.zeros(len(distinct), np.int64)
    sample[codes] = np.arange(len(codes))
    n = np.bincount(codes, batch.column(1).to_numpy(), len(distinct)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(n), batch.column(2).take(pa.array(sample))], batch.schema.names)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keep_freed()
    held, size = [], 0
    for piece in pieces(batches, "text"):
        words = read_words(piece.column(1), lower=True)
        learned = piece.column(0).to_numpy(zero_copy_only=False)
        codes, distinct = pd.factorize(words.hashed)
        sample = np.zeros(len(distinct), np.int64)
        sample[codes] = np.arange(len(codes))
        n = np.bincount(codes, np.repeat(learned, words.counts), len(distinct))
        start, length = words.start[sample], (words.end - words.start)[sample]
        # The end is spelled by no word.
        ends = np.r_[0, np.cumsum(length), length.sum()].astype(np.int32)
        data = [None, pa.py_buffer(ends), pa.py_buffer(words.data[ragged(start, length)])]
        spelled = pa.BinaryArray.from_buffers(pa.binary(), len(distinct) + 1, data)
        counted = [np.r_[distinct, _END].view(np.int64), np.r_[n, learned.sum()].astype(np.int64)]
        held.append(pa.RecordBatch.from_arrays([*map(pa.array, counted), spelled], ["token", "n", "word"]))
        size += len(distinct)
        if size > _COUNTED_ROWS:
            yield _counted(held)
            held, size = [], 0
    if held:
        yield _counted(held)


def token_table(texts: DataFrame) -> DataFrame:
    """(token, n, word): hashes of all tokens of (learned, text), how often each is in those learned, and its bytes."""
    # A task has counted its tokens, so that they are sorted after the shuffle only.
    counts = texts.mapInArrow(_count_words, "token long, n long, word binary").repartition("token")
    return counts.groupBy("token").agg(F.sum("n").alias("n"), F.first("word").alias("word"))


# --- grams in packed form ---------------------------------------------------------------------------------------


def byte_code(coder: Coder) -> Code:
    """The code of ``coder`` and, behind its symbols, one of eight decisions for each (byte before, byte)."""
    code, n = coder.code, len(coder.code.size)
    value = np.arange(256)
    steps = []
    for bit in range(8):
        so_far = (1 << bit) | (value >> (8 - bit))
        steps.append((np.arange(256)[:, None] << 8 | so_far) + max(n, 2) << 33 | value >> (7 - bit) & 1)
    packed = np.stack(steps, axis=2).ravel()
    begin = len(code.packed) + 8 * np.arange(1 << 16)
    return Code(np.r_[code.begin, begin], np.r_[code.size, np.full(1 << 16, 8)], np.r_[code.packed, packed])


@dataclass
class Plan:
    """What all tasks share: the codes, how often each decision went 0 and 1, into how many parts the rows after a
    context are salted, and the number of buckets.

    A context is a code: a word of the vocabulary, n for any other (its hash beside it), n + 1 for the start of a text,
    and from n + 2 on two bytes of a word that is spelled."""

    coder: Coder
    code: Code
    first: np.ndarray
    salts: np.ndarray
    buckets: int

    @property
    def escape(self) -> int:
        return len(self.coder.hashes)

    @property
    def symbols(self) -> int:
        return len(self.coder.code.size)

    @cached_property
    def code_keys(self) -> np.ndarray:
        return mix(np.arange(len(self.salts)).astype(_U) * _START + _U(1))

    def keys(self, code: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = self.code_keys[code]
        other = np.flatnonzero(code == self.escape)
        out[other] = mix(word[other])
        return out

    def groups(self, grams: Grams) -> np.ndarray:
        out = self.keys(grams.before, grams.before_word)
        salts = self.salts[grams.before]
        hot = np.flatnonzero(salts > 1)
        out[hot] += mix(self.keys(grams.earlier[hot], grams.earlier_word[hot])) % salts[hot].astype(_U)
        return mix(out)


@dataclass
class Grams:
    """Symbols after two contexts: how often (``times``) in a text (``doc``, a number within the piece)."""

    before: np.ndarray
    before_word: np.ndarray
    earlier: np.ndarray
    earlier_word: np.ndarray
    symbol: np.ndarray
    doc: np.ndarray
    times: np.ndarray

    def take(self, at: np.ndarray | slice) -> Grams:
        return Grams(*(x[at] for x in vars(self).values()))


def _planes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(data: np.ndarray, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = data[: n * width].reshape(width, n).T
    return out.view("<i8").ravel()


_WIDTHS = (3, 3, 3, 4, 5)


def pack(grams: Grams, escape: int) -> bytes:
    """Byte planes of the columns, and the hashes of the escaped words among the contexts, under zstandard."""
    columns = (grams.before, grams.earlier, grams.symbol, grams.doc, grams.times)
    parts = [np.array([len(grams.doc)], "<u8").tobytes()]
    parts += [_planes(x, width) for x, width in zip(columns, _WIDTHS, strict=True)]
    parts += [grams.before_word[grams.before == escape].tobytes(), grams.earlier_word[grams.earlier == escape].tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(payload: bytes, escape: int) -> Grams:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    n, at, columns = int(data[:8].view("<u8")[0]), 8, []
    for width in _WIDTHS:
        columns.append(_from_planes(data[at:], n, width))
        at += n * width
    before, earlier, symbol, doc, times = columns
    words = []
    for code in (before, earlier):
        word, escaped = np.zeros(n, _U), code == escape
        size = 8 * int(escaped.sum())
        word[escaped] = np.frombuffer(data[at : at + size].tobytes(), _U)
        words.append(word)
        at += size
    return Grams(before, words[0], earlier, words[1], symbol, doc, times)


def token_grams(hashed: np.ndarray, first: np.ndarray, coder: Coder) -> Grams:
    """One row of each token of some texts (an end after each), those of equal contexts and symbol of a text as one
    wherever they meet; ascending by contexts and symbol."""
    n = len(coder.hashes)
    symbol = coder.symbols(hashed)
    codes, words = [symbol], [hashed]
    for _ in range(2):
        code, word = np.r_[n + 1, codes[-1][:-1]], np.r_[_U(0), words[-1][:-1]]
        code[first[:-1]] = n + 1
        codes.append(code)
        words.append(word)
    rows = Grams(codes[1], words[1], codes[2], words[2], symbol, np.repeat(np.arange(len(first) - 1), np.diff(first)), symbol)
    # 17 bits are enough for a code; the text's own number is compared below.
    key = (rows.before << 47 | rows.earlier << 30 | rows.symbol << 13).view(_U) | (rows.doc & 8191).astype(_U)
    order = np.argsort(key)
    new = _begins(key[order])
    # Only rows of equal keys can be of other words or texts.
    like = np.flatnonzero(~new)
    a, b = order[like], order[like - 1]
    for x in (rows.before_word, rows.earlier_word, rows.doc):
        new[like] |= x[a] != x[b]
    starts = np.flatnonzero(new)
    out = rows.take(order[starts])
    out.times = np.diff(np.r_[starts, len(key)])
    return out


def byte_grams(words: list[bytes]) -> tuple[np.ndarray, ...]:
    """(number of the word, two bytes before, two bytes before these, byte) of words' bytes and a closing space."""
    data = np.frombuffer(b"".join(x + b" " for x in words), np.uint8).astype(np.int64)
    size = np.array([len(x) + 1 for x in words], np.int64)
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
    back = [np.where(place >= k, np.roll(data, k), 0) for k in (1, 2, 3, 4)]
    return word, back[0] | back[1] << 8, back[2] | back[3] << 8, data


def _of_bytes(plan: Plan, before: np.ndarray, earlier: np.ndarray, byte: np.ndarray, doc: np.ndarray, times: np.ndarray) -> Grams:
    none, pairs = np.zeros(len(byte), _U), plan.escape + 2
    return Grams(before + pairs, none, earlier + pairs, none, plan.symbols + ((before & 255) << 8 | byte), doc, times)


#: bucket, number of the piece of texts, what the payload is, and the payload.
_ROWS = "bucket int, piece long, kind int, payload binary"
_HELD, _LEARNED, _DIRECTORY, _OWN = range(4)
_EVERY = 1 << 20


def _rows(buckets: list[int], piece: int, kind: int | list[int], payloads: list[bytes]) -> pa.RecordBatch:
    n = len(buckets)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(buckets, pa.int32()),
            pa.array([piece] * n, pa.int64()),
            pa.array([kind] * n if isinstance(kind, int) else kind, pa.int32()),
            pa.array(payloads, pa.binary()),
        ],
        ["bucket", "piece", "kind", "payload"],
    )


def _chosen(plan: Plan, grams: Grams, share: int) -> np.ndarray:
    """Places of the rows in that part (of ``_EVERY``) of all groups."""
    return np.flatnonzero(plan.groups(grams) % _U(_EVERY) < _U(share))


def _dealt(plan: Plan, grams: Grams, piece: int, kind: int | np.ndarray, share: int | None) -> pa.RecordBatch:
    """Rows of a piece by kind (one of all grams, or each gram's) and bucket; with ``share``, those of that part of all
    groups, in bucket 0."""
    if share is not None:
        at = _chosen(plan, grams, share)
        return _rows([0] if len(at) else [], piece, kind, [pack(grams.take(at), plan.escape)] if len(at) else [])
    bucket = (plan.groups(grams) >> _U(20)) % _U(plan.buckets) + _U(plan.buckets) * _U(kind)
    bucket = bucket.astype(np.uint16 if plan.buckets * (_LEARNED + 1) < 1 << 16 else np.uint32)
    grams = grams.take(np.argsort(bucket, kind="stable"))
    sizes = np.bincount(bucket)
    found = np.flatnonzero(sizes)
    ends = np.cumsum(sizes[found])
    payloads = [pack(grams.take(slice(e - n, e)), plan.escape) for e, n in zip(ends, sizes[found], strict=True)]
    return _rows((found % plan.buckets).tolist(), piece, (found // plan.buckets).tolist(), payloads)


def _number() -> Iterator[int]:
    return itertools.count(TaskContext.get().partitionId() << 32)


def _directory(plan: Plan, piece: int, row: np.ndarray, again: np.ndarray) -> pa.RecordBatch:
    payload = row.astype("<i8").tobytes() + again.astype("<i8").tobytes()
    return _rows([piece % plan.buckets], piece, _DIRECTORY, [payload])


def _pack_texts(plan_of: Callable[[], Plan]):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        plan = plan_of()
        for piece, batch in zip(_number(), pieces(batches, "text")):
            hashed, first = tokens(read_words(batch.column(3), lower=True))
            learned = batch.column(2).to_numpy(zero_copy_only=False)
            grams = token_grams(hashed, first, plan.coder)
            yield _dealt(plan, grams, piece, np.where(learned, _LEARNED, _HELD)[grams.doc], None)
            yield _directory(plan, piece, batch.column(0).to_numpy(), batch.column(1).to_numpy())

    return packed


def _pack_words(plan_of: Callable[[], Plan]):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = plan_of()
        for piece, batch in zip(_number(), pieces(batches, "word")):
            word, before, earlier, byte = byte_grams(batch.column(1).to_pylist())
            yield _dealt(plan, _of_bytes(plan, before, earlier, byte, word, np.ones(len(word), np.int64)), piece, _HELD, None)
            token = batch.column(0).to_numpy()
            yield _directory(plan, piece, token, np.full(len(token), _SPELLED))

    return packed


def _pack_counts(plan_of: Callable[[], Plan]):
    """Counts of bytes from their table; they belong to no text."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = plan_of()
        for batch in batches:
            gram, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            grams = _of_bytes(plan, gram >> 24, gram >> 8 & 0xFFFF, gram & 255, np.zeros(len(gram), np.int64), n)
            yield _dealt(plan, grams, -1, _LEARNED, None)

    return packed


def _pack_own(plan_of: Callable[[], Plan]):
    """The counts after each salted context, once for each bucket that has a part of its rows."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = plan_of()
        for batch in batches:
            for before, after in zip(batch.column(0).to_numpy(), batch.column(1), strict=True):
                if plan.salts[before] == 1:
                    continue
                code = np.array([before])
                group = mix(plan.keys(code, np.zeros(1, _U)) + np.arange(plan.salts[before]).astype(_U))
                buckets = np.unique((group >> _U(20)) % _U(plan.buckets)).tolist()
                symbol, n = (after.values.field(i).to_numpy() for i in (0, 1))
                payload = np.r_[before, symbol, n].astype("<i8").tobytes()
                payload = zstandard.ZstdCompressor(level=1).compress(payload)
                yield _rows(buckets, -1, _OWN, [payload] * len(buckets))

    return packed


def _split_rows(n_tokens: int) -> int:
    """Beyond how many rows a context is salted. On smaller input a 512th of all rows is split as well, so that buckets
    are even."""
    return min(_GROUP_ROWS, max(n_tokens // 512, 1 << 12))


def _survey(symbol: np.ndarray, first: np.ndarray, learned: np.ndarray, hot: np.ndarray, escape: int) -> pa.Array:
    """(pair, n): how often symbols come after the contexts marked in ``hot``, in the texts that are learned."""
    before = np.r_[escape + 1, symbol[:-1]]
    before[first[:-1]] = escape + 1
    at = np.flatnonzero(hot[before])
    codes, distinct = pd.factorize(before[at] << 20 | symbol[at])
    n = np.bincount(codes, np.repeat(learned, np.diff(first))[at], len(distinct)).astype(np.int64)
    return pa.StructArray.from_arrays([pa.array(distinct.astype(np.int64)), pa.array(n)], ["pair", "n"])


def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "word"):
        word, before, earlier, byte = byte_grams(batch.column(1).to_pylist())
        codes, distinct = pd.factorize(before << 24 | earlier << 8 | byte)
        n = np.bincount(codes, (batch.column(0).to_numpy() > 0)[word], len(distinct)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(distinct.astype(np.int64)), pa.array(n)], ["gram", "n"])


# --- the model --------------------------------------------------------------------------------------------------


@dataclass
class _Turn:
    """The decisions of one depth, of the rows that have one there (``at`` among all, ascending)."""

    at: np.ndarray
    place: np.ndarray  # of the decision in the code
    bit: np.ndarray
    n: np.ndarray
    went: np.ndarray  # how often it went 0, and 1, after the context of the row


def _turns(code: Code, new: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> Iterator[_Turn]:
    """Depth by depth the decisions of rows, of which those of a context (it begins at each ``new``) are in the order of
    their paths: rows that share the decisions so far are then next to one another."""
    path, size, begin, n = code.paths[symbol], code.size[symbol].astype(np.uint8), code.begin[symbol], n.astype(float)
    differ = path[1:] ^ path[:-1]
    # Without the bit after the highest a number is not rounded up to a power of 2.
    shared = np.r_[-1, 64 - np.frexp((differ & ~(differ >> _U(1))).astype(float))[1]].astype(np.int8)
    shared[new] = -1
    at = np.arange(len(path))
    for depth in range(int(size.max(initial=0))):
        if depth >= size.min():
            left = np.flatnonzero(size > depth)
            path, size, begin, n, shared, at = (x.take(left) for x in (path, size, begin, n, shared, at))
        bit = (path >> _U(63 - depth)).astype(np.uint8) & 1
        first = shared < depth
        starts = np.flatnonzero(first)
        ones = np.add.reduceat(n * bit, starts)
        went = np.stack([np.add.reduceat(n, starts) - ones, ones]).astype(_F)
        if len(starts) < len(at):
            went = went.take(np.cumsum(first) - 1, axis=1)
        yield _Turn(at, begin + depth, bit, n, went)


def _odds(went: np.ndarray) -> np.ndarray:
    return np.log((went[1] + _F(0.4)) / (went[0] + _F(0.4)))


def _gate(spelled: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return (spelled * 4 + one) * 4 + two


def _pair(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mix(context ^ mix(symbol.astype(_U)))


@dataclass
class Merged:
    """The distinct grams of a bucket, those of equal contexts together, with their counts in training, and the counts
    after the nearer contexts (``own_...``), ascending by context."""

    one: np.ndarray
    two: np.ndarray
    symbol: np.ndarray
    n: np.ndarray
    own_one: np.ndarray
    own_symbol: np.ndarray
    own_n: np.ndarray

    def chunks(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first gram, end, places of the own counts after their nearer contexts, of each gram's own among these) of
        some grams at a time, all those of ``two`` together."""
        at = 0
        ends = np.r_[np.flatnonzero(self.two[1:] != self.two[:-1]) + 1, len(self.two)]
        while at < len(self.two):
            upto = int(ends[min(np.searchsorted(ends, at + _CHUNK_ROWS), len(ends) - 1)])
            one, symbol = self.one[at:upto], self.symbol[at:upto]
            ones = np.unique(one)
            low = np.searchsorted(self.own_one, ones)
            own = ragged(low, np.searchsorted(self.own_one, ones, "right") - low)
            # Each gram's symbol has an own count after its ``one``, with as many decisions.
            yield at, upto, own, pd.Index(_pair(self.own_one[own], self.own_symbol[own])).get_indexer(_pair(one, symbol))
            at = upto


def _by_paths(order: np.ndarray, context: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """That order of rows with those of equal contexts, which it brings together, by ``rank``."""
    new = _begins(context[order])
    several = np.flatnonzero(~(new & np.r_[new[1:], True]))
    rows = order[several]
    order[several] = rows[np.argsort(np.cumsum(new)[several] << 32 | rank[rows])]
    return order


def _by_contexts(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """An order that brings equal ``two`` together, and ``one`` nearly so."""
    key = (one >> _U(44) << _U(44)) | (two >> _U(20))
    order = np.argsort(key)
    key, two_of = key[order], two[order]
    mingled = (key[1:] == key[:-1]) & (two_of[1:] != two_of[:-1])
    return np.lexsort((two, one)) if mingled.any() else order


def merged(plan: Plan, rows: Grams, learned: np.ndarray, owns: list[np.ndarray]) -> tuple[Merged, np.ndarray]:
    """The grams of some rows, and of each row the place of its gram."""
    one = plan.keys(rows.before, rows.before_word)
    two = mix(one ^ mix(plan.keys(rows.earlier, rows.earlier_word) + _U(1)))
    codes, distinct = pd.factorize(_pair(two, rows.symbol))
    n = np.bincount(codes, rows.times * learned, len(distinct))
    sample = np.zeros(len(distinct), np.int64)
    sample[codes] = np.arange(len(codes))
    one, two, symbol, before = one[sample], two[sample], rows.symbol[sample], rows.before[sample]
    order = _by_paths(_by_contexts(one, two), two, plan.code.ranks[symbol])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    cold = np.flatnonzero(plan.salts[before] == 1)
    own_codes, own_distinct = pd.factorize(_pair(one[cold], symbol[cold]))
    own_sample = np.zeros(len(own_distinct), np.int64)
    own_sample[own_codes] = cold
    own = [(one[own_sample], symbol[own_sample], np.bincount(own_codes, n[cold], len(own_distinct)))]
    for given in owns:
        size = len(given) // 2
        key = plan.keys(given[:1], np.zeros(1, _U))
        own.append((np.repeat(key, size), given[1 : 1 + size], given[1 + size :].astype(float)))
    own_one, own_symbol, own_n = (np.concatenate(x) for x in zip(*own, strict=True))
    by = _by_paths(np.argsort(own_one), own_one, plan.code.ranks[own_symbol])
    return Merged(one[order], two[order], symbol[order], n[order], own_one[by], own_symbol[by], own_n[by]), place[codes]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(piece, kind, payload) of each bucket in turn."""
    held, current = [], None
    for batch in batches:
        for bucket, *row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if bucket != current and held:
                yield held
                held = []
            current = bucket
            held.append(row)
    if held:
        yield held


@dataclass
class _Bucket:
    """The rows of a bucket, whether they were learned from, the payload of each and the piece of each payload, and the
    counts given for salted contexts."""

    rows: Grams
    learned: np.ndarray
    payload: np.ndarray
    piece: np.ndarray
    owns: list[np.ndarray]


def _read(plan: Plan, payloads: list[tuple]) -> _Bucket | None:
    """What the (piece, kind, payload) hold; each is let go once it is read."""
    columns, sizes, pieces_of, learned, owns = [[] for _ in Grams.__annotations__], [], [], [], []
    unzipped = zstandard.ZstdDecompressor().decompress
    while payloads:
        piece, kind, payload = payloads.pop()
        if kind == _OWN:
            owns.append(np.frombuffer(unzipped(payload), "<i8"))
        elif kind in (_HELD, _LEARNED):
            grams = unpack(payload, plan.escape)
            for held, column in zip(columns, vars(grams).values(), strict=True):
                held.append(column)
            sizes.append(len(grams.doc))
            pieces_of.append(piece)
            learned.append(kind == _LEARNED)
    if not sizes:
        return None
    whole = []
    for held in columns:
        whole.append(np.concatenate(held))
        held.clear()
    numbers = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    return _Bucket(Grams(*whole), np.array(learned)[numbers], numbers, np.array(pieces_of, np.int64), owns)


def _without(went: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Counts without one occurrence of the decision itself; of those that were not seen in training nothing is asked."""
    return np.maximum(went - np.stack([1 - bit, bit]).astype(_F), 0)


def _alone(plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """By the place of a decision in the code, its log odds alone, and what these and the bit add to a cell."""
    node, bit = plan.code.packed >> 33, plan.code.packed & 1
    step = _step(_odds(_without(plan.first[:, None], np.array([[0], [1]]))))
    return _odds(plan.first)[node], (2 * _STEPS**2 * step[bit, node] + bit).astype(np.int32)


def _priced(plan: Plan, symbol: np.ndarray, alone: np.ndarray, decided: list[tuple], model: Model) -> np.ndarray:
    """Costs of some grams by (gate, log odds after one, and two contexts) of their decisions, depth by depth."""
    costs = np.zeros(len(symbol))
    size, begin, path = plan.code.size[symbol].astype(np.uint8), plan.code.begin[symbol], plan.code.paths[symbol]
    for depth, (gate, one, two) in enumerate(decided):
        at = np.flatnonzero(size > depth)
        bit = (path[at] >> _U(63 - depth)).astype(np.uint8) & 1
        costs[at] += model.mixed_cost((alone.take(begin[at] + depth), one, two), gate.astype(np.int64), bit)
    return costs


def _decided(plan: Plan, some: Merged, at: int, upto: int, own: np.ndarray, place: np.ndarray) -> Iterator[tuple]:
    """Depth by depth (decisions, their gates, log odds after one, and after two contexts, and a function that gives the
    cells of what is left without one occurrence) of the grams from ``at`` to ``upto``."""
    spelled = some.symbol[at:upto] >= plan.symbols
    number = some.own_one[own]
    owns = _turns(plan.code, _begins(number), some.own_symbol[own], some.own_n[own])
    level, odds, cell = np.empty(len(own), np.uint8), np.empty(len(own), _F), np.empty(len(own), np.int64)
    for turn in _turns(plan.code, _begins(some.two[at:upto]), some.symbol[at:upto], some.n[at:upto]):
        after = next(owns)
        level[after.at], odds[after.at] = _levels(after.went[0] + after.went[1]), _odds(after.went)
        there, strange = place.take(turn.at), spelled.take(turn.at)
        gate = _gate(strange.astype(np.uint8), level.take(there), _levels(turn.went[0] + turn.went[1]))

        def cells(turn=turn, after=after, there=there, strange=strange):
            less = _without(after.went, after.bit)
            cell[after.at] = _levels(less[0] + less[1]) * np.int64(4 * _LEVEL) + _step(_odds(less)) * (2 * _STEPS)
            less = _without(turn.went, turn.bit)
            twos = _levels(less[0] + less[1]) * np.int64(_LEVEL) + _step(_odds(less)) * 2
            return cell.take(there) + twos + strange * (16 * _LEVEL)

        yield turn, gate, odds.take(there), _odds(turn.went), cells


def _bucket_costs(plan: Plan, some: Merged, alone: np.ndarray, alone_cells: np.ndarray, model: Model | None) -> np.ndarray:
    """Costs of the grams of a bucket, by ``model`` or else by one that is fitted to their occurrences in training."""
    held, cells = [], np.zeros(_GATES * _LEVEL)
    costs = np.empty(len(some.two))
    for at, upto, own, place in some.chunks():
        decided = []
        for turn, gate, one, two, cells_of in _decided(plan, some, at, upto, own, place):
            decided.append((gate, one, two))
            if model is None:
                np.add.at(cells, cells_of() + alone_cells.take(turn.place), turn.n)
        held.append((at, upto, decided))
        if model is not None:
            costs[at:upto] = _priced(plan, some.symbol[at:upto], alone, held.pop()[2], model)
    if held:
        model = fitted(cells)
    while held:
        at, upto, decided = held.pop()
        costs[at:upto] = _priced(plan, some.symbol[at:upto], alone, decided, model)
    return costs


def _coster(plan_of: Callable[[], Plan], model_of: Callable[[], Model | None]):
    """Costs of the rows of each bucket, by the given model or else by one that is fitted to the bucket."""

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        plan, given = plan_of(), model_of()
        alone, alone_cells = _alone(plan)
        try:
            for payloads in _buckets(batches):
                for piece, kind, payload in payloads:
                    if kind == _DIRECTORY:
                        row, again = np.frombuffer(payload, "<i8").reshape(2, -1)
                        yield _costs(np.full(len(row), piece), np.arange(len(row)), np.zeros(len(row)), row, again)
                bucket = _read(plan, payloads)
                if bucket is None:
                    continue
                grams, place = merged(plan, bucket.rows, bucket.learned, bucket.owns)
                doc, times, number, piece = bucket.rows.doc, bucket.rows.times, bucket.payload, bucket.piece
                del bucket
                costs = _bucket_costs(plan, grams, alone, alone_cells, given)
                del grams
                codes, of = pd.factorize(number.astype(np.int64) << 40 | doc)
                sums = np.bincount(codes, costs[place] * times, len(of))
                asked = np.flatnonzero(piece[of >> 40] >= 0)
                of, sums = of[asked], sums[asked]
                yield _costs(piece[of >> 40], of & (1 << 40) - 1, sums)
                del place, doc, times, number, costs, codes, of, sums
                give_back()  # a bucket takes much of a worker's memory
        finally:
            give_back()

    return cost


_COSTS = "piece long, doc int, cost double, row long, again long"


def _costs(piece, doc, cost, row=None, again=None) -> pa.RecordBatch:
    none = pa.nulls(len(doc), pa.int64())
    ends = [none if x is None else pa.array(x, pa.int64()) for x in (row, again)]
    columns = [pa.array(piece, pa.int64()), pa.array(doc, pa.int32()), pa.array(cost, pa.float64()), *ends]
    return pa.RecordBatch.from_arrays(columns, ["piece", "doc", "cost", "row", "again"])


def taught_share(rows: int, most: int = TAUGHT_ROWS) -> int:
    """The part (of ``_EVERY``) of all groups that has about ``most`` rows, or all. No score is made from a part."""
    return _EVERY if rows <= most else max(most * _EVERY // rows, 1)


def sequence_costs(
    rows: DataFrame, words: DataFrame, survey: DataFrame, coder: Coder, n_rows: int, n_tokens: int
) -> DataFrame:
    """(row, again, cost): log10 of the probability of each text of ``rows`` (row, again, learned, text), the spelling
    of words outside the vocabulary left out, and of the spelling of each of ``words`` (token, n, word) whose ``n`` is
    0 (``row`` is its token, ``again`` is -1). ``survey`` (pair, n) has the counts of ``_survey`` of all texts, those of
    every context that is salted among them."""
    context = rows.sparkSession.sparkContext
    counts = words.select("n", "word").mapInArrow(_byte_counts, "gram long, n long")
    with tidy(rows.sparkSession):
        counts = stage(counts.groupBy("gram").agg(F.sum("n").alias("n")), "lm_bytes")
    pair = F.expr("shiftright(gram, 24)")
    of_bytes = F.expr(f"(shiftright(gram, 24) & 255) * 256 + (gram & 255) + {len(coder.code.size)}").alias("symbol")
    totals = counts.groupBy(of_bytes).agg(F.sum("n").alias("n")).toArrow()  # 2**16 rows at most
    n_bytes = counts.count()
    code, symbols = byte_code(coder), len(coder.code.size)
    symbol = np.r_[np.arange(symbols), totals["symbol"].to_numpy()]
    n = np.r_[coder.counts, coder.rest, coder.ends, totals["n"].to_numpy()]
    size = code.size[symbol]
    step = code.packed.take(ragged(code.begin[symbol], size))
    nodes = max(symbols, 2) + _BYTE_NODES
    first = np.bincount((step >> 33) * 2 + (step & 1), np.repeat(n, size), 2 * nodes).reshape(-1, 2).T.astype(_F)
    seen = np.r_[coder.counts, 1, n_rows, np.full(1 << 16, n_bytes // 3)]
    salts = np.maximum(-(-seen // _split_rows(n_tokens)), 1)
    held = context.broadcast(Plan(coder, code, first, salts, max(-(-(n_tokens + n_bytes) // _BUCKET_ROWS), 1)))
    plan = lambda: held.value
    hot = survey.groupBy("pair").agg(F.sum("n").alias("n"))
    hot = hot.select(F.expr("shiftright(pair, 20)").alias("before"), F.expr("pair & 1048575").alias("symbol"), "n")
    if salts[-1] > 1:
        own = counts.groupBy((pair + len(coder.hashes) + 2).alias("before"), of_bytes).agg(F.sum("n").alias("n"))
        hot = hot.unionByName(own)
    # A vocabulary and 2 symbols at most after each.
    with tidy(rows.sparkSession):
        hot = stage(hot.groupBy("before").agg(F.collect_list(F.struct("symbol", "n")).alias("after")), "lm_own")
    counts = counts.where("n > 0")
    dealt = rows.mapInArrow(_pack_texts(plan), _ROWS)
    dealt = dealt.unionByName(words.where("n = 0").select("token", "word").mapInArrow(_pack_words(plan), _ROWS))
    dealt = dealt.unionByName(counts.mapInArrow(_pack_counts(plan), _ROWS))
    dealt = dealt.unionByName(hot.mapInArrow(_pack_own(plan), _ROWS))
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
    costs = dealt.mapInArrow(_coster(plan, lambda: None), _COSTS).groupBy("piece", "doc")
    return costs.agg(F.max("row").alias("row"), F.max("again").alias("again"), F.sum("cost").alias("cost")).drop("piece", "doc")


# --- scores -----------------------------------------------------------------------------------------------------


def _scorer(coder_of: Callable[[], Coder], total: int, distinct: int, hot: np.ndarray):
    """Counts and base scores of texts, and their other tokens; a survey of each piece is with its first text."""
    scale = math.log10(total + 0.5 * (distinct + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        coder = coder_of()
        counts = np.r_[coder.counts, 0]
        for piece in pieces(batches, "text"):
            words = read_words(piece.column(4), lower=True)
            hashed, first = tokens(words)
            n = len(first) - 1
            text = np.repeat(np.arange(n), np.diff(first))
            symbol = coder.symbols(hashed)
            # Tokens with a broadcast count here; the others (the end as well) are counted for the join.
            held = symbol < len(coder.hashes)
            base = np.log10(counts[np.where(held, symbol, len(counts) - 1)] + 0.5) - scale
            of, other = text[~held], hashed[~held]
            codes, distinct = pd.factorize(mix(other ^ mix(of.astype(_U))))  # in the order of texts
            sample = np.zeros(len(distinct), np.int64)
            sample[codes] = np.arange(len(codes))
            places = pa.array(np.searchsorted(of[sample], np.arange(n + 1)).astype(np.int32))
            rare = pa.StructArray.from_arrays(
                [pa.array(other[sample].view(np.int64)), pa.array(np.bincount(codes, minlength=len(distinct)))], ["token", "n"]
            )
            learned = piece.column(3).to_numpy(zero_copy_only=False)
            after = _survey(symbol, first, learned, hot, len(coder.hashes))
            at_first = pa.array(np.r_[0, np.full(n, len(after))].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *piece.columns[:3],
                    pa.array(np.diff(words.offsets)),
                    pa.array(np.diff(first)),
                    pa.array(sums_per_text(held, first)),
                    pa.array(np.bincount(text[held], base[held], n).astype(float)),
                    pa.ListArray.from_arrays(places, rare),
                    pa.ListArray.from_arrays(at_first, after),
                ],
                ["row", "again", "key", "n_bytes", "n_tokens", "known", "base", "rare", "after"],
            )

    return score


def score_texts(
    docs: DataFrame,
    *,
    training: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: int = VOCABULARY,
) -> DataFrame:
    """(key, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row.

    ``training`` is a condition on the rows to learn from, all by default.
    ``log10((c + 0.5) / (N + 0.5 * (V + 1)))`` over the tokens, c being a token's count in training, N all tokens and V
    the distinct ones there; ``score`` is the model's log10 probability, both with the end.
    """
    spark, end = docs.sparkSession, int(_END.view(np.int64))
    learned = F.coalesce(F.lit(True) if training is None else training, F.lit(False)).alias("learned")
    with tidy(spark):
        met = stage(token_table(docs.select(learned, F.col(text).alias("text"))), "lm_counts")
    counts = met.where("n > 0").select("token", "n")
    total, distinct, ends, once, twice = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.count("*"),
        F.coalesce(F.sum(F.when(F.col("token") == end, F.col("n"))), F.lit(0)),
        F.count(F.when(F.col("n") == 1, 1)),
        F.count(F.when(F.col("n") == 2, 1)),
    ).first()
    words = counts.where(F.col("token") != end)
    best = words.where("n > 1").orderBy(F.desc("n"), "token").limit(vocabulary).toArrow()  # at most `vocabulary` rows
    coder = make_coder(
        best["token"].to_numpy().view(_U), best["n"].to_numpy().astype(np.int64), total - ends, ends
    )
    held_coder = spark.sparkContext.broadcast(coder)
    # Each word outside the vocabulary, once, with all its occurrences in training.
    spelled = met.where(F.col("token") != end)
    if best.num_rows:
        least, last = best["n"][-1].as_py(), best["token"][-1].as_py()
        spelled = spelled.where((F.col("n") < least) | (F.col("n") == least) & (F.col("token") > last))
    # Rows are told apart by a hash of key and text and a checksum of the text.
    rows = docs.select(
        F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("row"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("again"),
        learned,
        F.col(text).alias("text"),
        F.col(key).alias("key"),
    )
    kind = rows.schema["key"].dataType.simpleString()
    # Of all contexts that may be salted; there are more tokens than those of training.
    hot = np.r_[coder.counts > _split_rows(total), False, True]
    scored = stage(  # without a shuffle
        rows.select("row", "again", "key", "learned", "text").mapInArrow(
            _scorer(lambda: held_coder.value, total, distinct, hot),
            f"row long, again long, key {kind}, n_bytes long, n_tokens long, known long, base double, "
            "rare array<struct<token:long,n:long>>, after array<struct<pair:long,n:long>>",
        ),
        "lm_scores",
    )
    survey = scored.select(F.inline("after"))
    scored = scored.drop("after")
    n_rows, n_tokens = scored.agg(F.count("*"), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    costs = sequence_costs(rows.drop("key"), spelled, survey, coder, n_rows, n_tokens)
    with small_batches(spark, _BATCH_BYTES), tidy(spark):
        costs = stage(costs, "lm_costs")
    spelling = costs.where(F.col("again") == _SPELLED).select(F.col("row").alias("token"), "cost")
    # Repeated rows have the same costs.
    mixed = costs.where(F.col("again") != _SPELLED).groupBy("row", "again").agg(F.min("cost").alias("mixed"))
    # After an escape a word of training by its count, less the discount that words met once and twice suggest, or, by
    # what was taken off, a new word and its spelling.
    c = F.coalesce(F.col("c"), F.lit(0))
    bottom = math.log10(total + 0.5 * (distinct + 1))
    discount = (once + 0.5) / (once + 2 * twice + 1)
    rare = distinct - (ends > 0) - len(coder.hashes)
    new = math.log10((discount * rare + 0.5) / (coder.rest + 0.5))
    known = F.log10(c - discount) - math.log10(coder.rest + 0.5)
    which = F.when(F.col("token") == end, 0.0).when(c > 0, known).otherwise(F.coalesce("cost", F.lit(0.0)) + new)
    rest = (
        scored.select("row", "again", F.explode("rare").alias("r"))
        .select("row", "again", "r.token", "r.n")
        .join(counts.select("token", F.col("n").alias("c")), "token", "left")
        .join(spelling, "token", "left")
        .groupBy("row", "again")
        .agg(
            F.sum(F.col("n") * (F.log10(c + 0.5) - bottom)).alias("rest"),
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rest_known"),
            F.sum(F.col("n") * which).alias("spelling"),
        )
    )
    copies = scored.groupBy("row", "again").agg(F.count("*").alias("copies"))
    rest = rest.join(copies, ["row", "again"]).join(mixed, ["row", "again"])
    rest = rest.withColumn("score", F.col("mixed") + F.col("spelling") / F.col("copies"))
    return scored.drop("rare").join(rest, ["row", "again"], "left").select(
        F.col("key").alias(key),
        "n_bytes",
        "n_tokens",
        (F.col("known") + F.coalesce(F.col("rest_known") / F.col("copies"), F.lit(0)).cast("long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce(F.col("rest") / F.col("copies"), F.lit(0.0))).alias("base_score"),
        "score",
        (-F.col("score") * math.log2(10) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )

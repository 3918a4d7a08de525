"""Ranked lexical search by an Aho-Corasick scan of whole documents, without a document index.

Items (queries) and documents consist of terms, maximal runs of ASCII letters and digits and of non-ASCII characters,
A-Z lower-cased. All distinct terms of the items, a guard before and after each, form one automaton; in a text whose
other characters have become guards it finds exactly the whole terms, those that share a guard included, and its
outputs are the numbers of terms, which map to the items that have them. Two scans of the documents: the first counts
documents and terms and the documents of each term, the second the occurrences of each term in each document, from
which scores follow:

    w = floor(1000 ln((2 N + 2) / (2 df + 1))),  m = 100 - b + ((b n N) div L),
    score = sum over the item's terms, repeats included, of w ((10^9 tf) div (1000 tf + 8 m)),

N documents with a term, L their terms, n a document's, df the documents with a term, tf its occurrences in one; b = 75.
Integers of 64 bits.

Every task keeps for each item the ``top`` best documents that it met; those meet by (item, hash of the key) and then
by item, so an item that all documents match gathers ``top`` rows for each task and never a list of its documents.

Items come in blocks whose texts hold about ``block_bytes``; a block's terms and their items, which the texts bound,
are broadcast, and each block scans the documents on its own. An item longer than a block is a block of its own.
Texts are scanned in stretches that end at a guard, so a text of any length takes memory of a stretch.

Null and empty texts have no terms: such documents are never found, such items find none. Rows count as they are:
a repeated document is found as often as it is there, a repeated item is ranked as often. Equal scores go by
ascending key, a null key first. Empty tables give an empty result. Only the columns named are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain
from math import floor, log

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillweave.llm.textwords import NON_ALPHANUMERIC, flat, pieces, ragged
from tillweave.operators.materialize import stage

TOP = 10
LENGTH_PERCENT = 75
BLOCK_BYTES = 2 << 20
STRETCH = 4 << 20
_CELLS = 1 << 19  # scores held at once
_SALTS = 64
_GUARD = 0x20

#: What each byte becomes: A-Z lower-cased, whatever is in no term a guard.
_NORMAL = np.where(NON_ALPHANUMERIC, _GUARD, np.arange(256)).astype(np.uint8)
_NORMAL[0x41:0x5B] = np.arange(0x61, 0x7B)


@dataclass(frozen=True)
class Block:
    """Some items: their ids, the distinct terms, and for term i the items ``item[first[i]:first[i + 1]]``, each of
    which has it ``times`` times."""

    ids: pa.Array
    terms: list[bytes]
    first: np.ndarray
    item: np.ndarray
    times: np.ndarray


def make_block(ids: list, texts: list[str | None], kind: pa.DataType) -> Block:
    held: dict[bytes, Counter[int]] = {}
    for number, text in enumerate(texts):
        data = _NORMAL[np.frombuffer((text or "").encode(), np.uint8)].tobytes()
        for term in data.split():
            held.setdefault(term, Counter())[number] += 1
    terms = sorted(held)
    pairs = [pair for term in terms for pair in sorted(held[term].items())]
    item, times = np.array(pairs, np.int64).reshape(-1, 2).T
    first = np.cumsum([0, *(len(held[term]) for term in terms)])
    return Block(pa.array(ids, kind), terms, first, item, times)


def guarded(terms: list[bytes]) -> ahocorasick.Automaton:
    """The automaton of all terms between guards; bytes stand as characters below 256."""
    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word(f" {term.decode('latin-1')} ", number)
    found.make_automaton()
    return found


def _stretches(data: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cut at guards into stretches of about ``most`` bytes; both ends of each are guards."""
    begin, last = 0, len(data) - 1
    while begin < last:
        end, size = last, most
        while begin + size < last:
            guards = np.flatnonzero(data[begin + 1 : begin + size + 1] == _GUARD)
            if len(guards):
                end = begin + 1 + int(guards[-1])
                break
            size *= 2  # inside one long term
        yield begin, end
        begin = end


def occurrences(
    found: ahocorasick.Automaton, texts: pa.Array, stretch: int = STRETCH
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many terms each text has; and (text, number of a term, how often), in order, of the automaton's terms."""
    data, offsets = flat(texts)
    data = np.insert(_NORMAL[data], offsets, _GUARD)  # one before each text, one at the end
    before = offsets + np.arange(len(offsets))  # the guards before the texts
    inside = data != _GUARD
    n_terms = np.diff(np.searchsorted(np.flatnonzero(inside[1:] & ~inside[:-1]), before))
    size = max(len(found), 1)
    keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for begin, end in _stretches(data, stretch) if len(found) else ():
        matches = found.iter(data[begin : end + 1].tobytes().decode("latin-1"))
        ends, terms = np.fromiter(chain.from_iterable(matches), np.int64).reshape(-1, 2).T
        text = np.searchsorted(before, begin + ends - 1, "right") - 1
        key, n = np.unique(text * size + terms, return_counts=True)
        keys.append(key)
        counts.append(n)
    pair, at = np.unique(np.concatenate(keys), return_inverse=True)
    often = np.zeros(len(pair), np.int64)
    np.add.at(often, at, np.concatenate(counts))
    return n_terms, pair // size, pair % size, often


def statistics(docs: DataFrame, terms: Broadcast[Block]) -> tuple[int, int, np.ndarray]:
    """N, L and the df of each term, from one scan."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = terms.value
        found, known = guarded(block.terms), len(block.terms)
        totals = np.zeros(known + 2, np.int64)
        for piece in pieces(batches, "text"):
            n_terms, _, term, _ = occurrences(found, piece.column(1))
            totals[:known] += np.bincount(term, minlength=known)
            totals[known] += np.count_nonzero(n_terms)
            totals[known + 1] += n_terms.sum()
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["number", "n"])

    known = len(terms.value.terms)
    totals = np.zeros(known + 2, np.int64)
    sums = docs.mapInArrow(count, "number long, n long").groupBy("number").agg(F.sum("n").alias("n"))
    for row in sums.collect():  # a row for each term of the block, and two
        totals[row["number"]] = row["n"]
    return int(totals[known]), int(totals[known + 1]), totals[:known]


class Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.least = np.ones(items, np.int64)  # a document needs that score to count
        self.rows: pa.Table | None = None

    def add(self, item: np.ndarray, score: np.ndarray, key: pa.Array) -> None:
        rows = pa.table({"item": pa.array(item), "score": pa.array(score), "key": key})
        rows = pa.concat_tables([self.rows, rows]) if self.rows is not None else rows
        order = [("item", "ascending"), ("score", "descending"), ("key", "ascending")]
        rows = rows.take(pc.sort_indices(rows, sort_keys=order, null_placement="at_start"))
        items = rows["item"].to_numpy()
        rank = np.arange(len(items)) - np.searchsorted(items, items)
        self.rows = rows.filter(pa.array(rank < self.top)).combine_chunks()
        full = rank == self.top - 1
        self.least[items[full]] = rows["score"].to_numpy()[full]


def _groups(size: np.ndarray, items: int) -> Iterator[tuple[int, int]]:
    """Cut texts, of which each adds ``size`` numbers to scores, so that a group's work is bounded, or one text."""
    sums, at = np.cumsum(size), 0
    while at < len(size):
        before = sums[at - 1] if at else 0
        upto = min(at + max(_CELLS // max(items, 1), 1), int(np.searchsorted(sums, before + 2 * _CELLS, "right")))
        yield at, max(upto, at + 1)
        at = max(upto, at + 1)


def add_scores(best: Best, block: Block, weight: np.ndarray, key: pa.Array, m: np.ndarray, found: tuple) -> None:
    """Score the texts of one piece; ``found`` as from ``occurrences``, without the first."""
    text, term, often = (x[weight[found[1]] > 0] for x in found)
    value = weight[term] * ((1_000_000_000 * often) // (1000 * often + 8 * m[text]))
    size = (block.first[1:] - block.first[:-1])[term]
    items, texts = len(block.ids), len(m)
    per_text = np.zeros(texts, np.int64)
    np.add.at(per_text, text, size)
    for low, high in _groups(per_text, items):
        a, b = np.searchsorted(text, [low, high])
        at = ragged(block.first[:-1][term[a:b]], size[a:b])
        scores = np.zeros((high - low, items), np.int64)
        cell = np.repeat((text[a:b] - low) * items, size[a:b]) + block.item[at]
        np.add.at(scores.reshape(-1), cell, np.repeat(value[a:b], size[a:b]) * block.times[at])
        least = best.least
        if high - low > best.top:
            least = np.maximum(least, np.partition(scores, high - low - best.top, axis=0)[high - low - best.top])
        row, item = np.nonzero(scores >= least)
        if len(row):
            best.add(item, scores[row, item], key.take(pa.array(row + low)))


def _ranked(docs: DataFrame, block: Block, top: int, length_percent: int, kind: str, item_kind: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    n_docs, n_terms, df = statistics(docs, shared)
    weight = np.array([floor(1000 * log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        found, best = guarded(held.terms), Best(len(held.ids), top)
        for piece in pieces(batches, "text"):
            n, *rest = occurrences(found, piece.column(1))
            m = 100 - length_percent + length_percent * n * n_docs // max(n_terms, 1)
            add_scores(best, held, weight, piece.column(0), m, tuple(rest))
        if best.rows is not None:
            number = best.rows["item"].combine_chunks()
            columns = [number, held.ids.take(number), *(best.rows[x].combine_chunks() for x in ("key", "score"))]
            yield pa.RecordBatch.from_arrays(columns, ["number", "item", "key", "score"])

    met = docs.mapInArrow(scan, f"number long, item {item_kind}, key {kind}, score long")
    order = [F.col("score").desc(), F.col("key").asc_nulls_first()]
    met = met.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(_SALTS)))
    for by in (["number", "salt"], ["number"]):
        met = met.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    return met.select("item", "rank", "key", "score")


def _blocks(rows: DataFrame, block_bytes: int, kind: pa.DataType) -> Iterator[tuple[Block, bool]]:
    """The items by blocks, read one partition after the other; and whether the block is the last."""
    ids, texts, size = [], [], 0
    for row in rows.toLocalIterator():
        more = len((row["text"] or "").encode())
        if ids and size + more > block_bytes:
            yield make_block(ids, texts, kind), False
            ids, texts, size = [], [], 0
        ids.append(row["item"])
        texts.append(row["text"])
        size += more
    yield make_block(ids, texts, kind), True


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    length_percent: int = LENGTH_PERCENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item, rank, key, score): each item's ``top`` best documents of a score above 0."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    asked = items.select(F.col(item).alias("item"), F.col(item_text).alias("text"))
    kind, item_kind = (x.dataType.simpleString() for x in (docs.schema[key], items.schema[item]))
    parts: list[DataFrame] = []
    for block, last in _blocks(asked, block_bytes, to_arrow_type(items.schema[item].dataType)):
        ranked = _ranked(rows, block, top, length_percent, kind, item_kind)
        # Of several blocks each is done before the next is sent.
        parts.append(ranked if last and not parts else stage(ranked, "ranked"))
    return reduce(DataFrame.union, parts).toDF(item, "rank", key, "score")

"""Benchmark decontamination by winnowing.

A window is ``length`` consecutive words of a benchmark item; a shorter item is one window of all its words. Words are
runs of letters, digits and non-ASCII characters, A-Z lower-cased. Of the k-gram hashes in every ``length - k + 1``
consecutive places the smallest (the rightmost of equal ones) is kept as a fingerprint, for items and for documents
alike, so that any span of ``length`` words that both share leaves a fingerprint in common. Each hit, a pair of places
with the same fingerprint, is extended word by word in both directions, and counts if the shared span has ``length``
words at least. Items shorter than a window have no such guarantee; their few words are looked up as they are, one
length at a time.

Benchmarks come in blocks of bounded size, each of which is sent to all tasks, and every document is compared with
every block; a benchmark of one block, the usual case, needs one pass over the documents and no shuffle. With several
blocks, the documents and what was found so far are written between the passes.

Null and empty texts, documents or items, have no words and no hits. Repeated documents give repeated rows; repeated
items each count. Only the columns named are read, so others may clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillweave.llm.textwords import NON_ALPHANUMERIC, Words, pieces, read_words, window_hashes
from tillweave.operators.materialize import stage

LENGTH = 10
GRAM = 5
BLOCK_BYTES = 8 << 20


def winnow(grams: np.ndarray, first: np.ndarray, fits: np.ndarray, span: int) -> np.ndarray:
    """Places of the smallest gram of every ``span`` consecutive places of one text, the rightmost of equal ones.

    ``first[i]`` is the place where the text of place i begins, ``fits`` whether a whole gram starts at a place.
    """
    n = len(grams)
    if not n:
        return np.empty(0, np.int64)
    best = np.arange(n)
    known = grams.copy()
    for back in range(1, span):
        # `known` is the smallest gram of the last places of the same text up to here.
        earlier = np.arange(n) - back
        better = (earlier >= first) & (grams[np.maximum(earlier, 0)] < known)
        best[better] = earlier[better]
        known[better] = grams[earlier[better]]
    whole = fits & (np.arange(n) - first >= span - 1)
    return np.unique(best[whole])


@dataclass(frozen=True)
class Block:
    """Items of a benchmark: word hashes in a row, the place where each item begins, fingerprints and short items."""

    ids: pa.Array
    hashed: np.ndarray
    first: np.ndarray
    prints: np.ndarray
    places: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]


def _fingerprints(words: Words, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    grams = words.windows(gram)
    first = np.repeat(words.first[:-1], words.counts)
    places = winnow(grams, first, words.window_fits(gram), length - gram + 1)
    return grams[places], places


def make_block(items: pa.Table, length: int = LENGTH, gram: int = GRAM) -> Block:
    """A block of the table (item, text)."""
    words = read_words(items["text"], NON_ALPHANUMERIC, lower=True)
    prints, places = _fingerprints(words, length, gram)
    order = np.argsort(prints, kind="stable")
    short = {}
    for size in range(1, length):
        at = np.flatnonzero(words.counts == size)
        if len(at):
            whole = window_hashes(words.hashed, size)[words.first[at]]
            by = np.argsort(whole, kind="stable")
            short[size] = (whole[by], at[by])
    return Block(items["item"].combine_chunks(), words.hashed, words.first, prints[order], places[order], short)


def _equal_ranges(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (place in ``wanted``, place in ``sorted_keys``) of equal values."""
    low = np.searchsorted(sorted_keys, wanted, "left")
    size = np.searchsorted(sorted_keys, wanted, "right") - low
    mine = np.repeat(np.arange(len(wanted)), size)
    return mine, np.arange(len(mine)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)


def _extend(words: Words, block: Block, a: np.ndarray, b: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many words agree from (a, b) on, one after the other in the direction of ``step``, up to ``most``."""
    text = words.text
    item = np.searchsorted(block.first, b, "right") - 1
    reach = np.zeros(len(a), np.int64)
    going = np.arange(len(a))
    for far in range(1, most + 1):
        x, y = a[going] + step * far, b[going] + step * far
        inside = (x >= words.first[text[a[going]]]) & (x < words.first[text[a[going]] + 1])
        inside &= (y >= block.first[item[going]]) & (y < block.first[item[going] + 1])
        x, y = np.where(inside, x, 0), np.where(inside, y, 0)
        going = going[inside & (words.hashed[x] == block.hashed[y])]
        reach[going] = far
        if not len(going):
            break
    return reach


def hits(words: Words, block: Block, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, item) of spans of the texts that hold windows of the block's items."""
    begin, end, item = [np.empty(0, np.int64)] * 3
    if len(block.prints) and len(words.hashed):
        prints, places = _fingerprints(words, length, gram)
        mine, theirs = _equal_ranges(block.prints, prints)
        a, b = places[mine], block.places[theirs]
        # A longer shared span is found at several fingerprints; each covers its surroundings.
        back = _extend(words, block, a, b, -1, length - 1)
        ahead = _extend(words, block, a, b, 1, length + gram)
        enough = back + ahead + 1 >= length
        begin, end = (a - back)[enough], (a + ahead + 1)[enough]
        item = (np.searchsorted(block.first, b[enough], "right") - 1).astype(np.int64)
    for size, (keys, at) in block.short.items():
        mine, theirs = _equal_ranges(keys, words.windows(size))
        mine, theirs = mine[fits := words.window_fits(size)[mine]], theirs[fits]
        begin, end = np.r_[begin, mine], np.r_[end, mine + size]
        item = np.r_[item, at[theirs]]
    return begin, end, item


def covered(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
    with_text: bool = False,
) -> DataFrame:
    """(key, n_words, spans, items) of every row: word spans that benchmark windows cover, and the items' ids.

    ``spans`` are disjoint [begin, end) in order, ``items`` distinct. ``with_text`` adds the texts as ``text``.
    """
    held = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        F.expr("cast(array() as array<struct<begin:bigint,end:bigint>>)").alias("spans"),
    )
    item_kind = benchmark.schema[item].dataType.simpleString()
    held = held.withColumn("items", F.expr(f"cast(array() as array<{item_kind}>)"))
    schema = StructType().add("key", held.schema["key"].dataType).add("text", "string").add("n_words", "long")
    schema = schema.add("spans", held.schema["spans"].dataType)
    schema = schema.add("items", held.schema["items"].dataType).add("found", held.schema["items"].dataType)
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, item, item_text, block_bytes)
    for at, count, items in blocks:
        shared = context.broadcast(make_block(items, length, gram))
        last = at == count - 1

        def look(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, "text"):
                yield _results(piece, shared.value, length, gram, with_text or not last)

        held = held.select("key", "text", "spans", "items").mapInArrow(look, schema)
        held = held.withColumn("items", F.concat("items", "found"))
        if not last:  # one block at a time is held by a task
            held = stage(held, "decontamination")
    texts = ["text"] if with_text else []
    return held.select(F.col("key").alias(key), "n_words", "spans", F.array_distinct("items").alias("items"), *texts)


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[tuple[int, int, pa.Table]]:
    """The items in blocks whose texts hold about ``block_bytes``; the driver has one block at a time."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    part = F.pmod(F.xxhash64(F.col("item").cast("string"), "text"), F.lit(count))
    for at in range(count):
        yield at, count, (rows.where(part == at) if count > 1 else rows).toArrow()


def _results(piece: pa.RecordBatch, block: Block, length: int, gram: int, more: bool) -> pa.RecordBatch:
    words = read_words(piece.column(1), NON_ALPHANUMERIC, lower=True)
    begin, end, item = hits(words, block, length, gram)
    n = len(words.first) - 1
    known, row = piece.column(2).flatten(), pc.list_parent_indices(piece.column(2)).to_numpy()
    spans = [words.first[row] + known.field(x).to_numpy() for x in range(2)]
    hit = covered(np.r_[begin, spans[0]], np.r_[end, spans[1]], len(words.hashed))
    linked = np.zeros(len(hit) + 1, bool)
    linked[1:-1] = hit[:-1] & hit[1:]
    linked[words.first[:-1]] = False
    opens, closes = np.flatnonzero(hit & ~linked[:-1]), np.flatnonzero(hit & ~linked[1:]) + 1
    of = np.searchsorted(words.first, opens, "right") - 1
    merged = pa.StructArray.from_arrays(
        [pa.array(opens - words.first[of]), pa.array(closes - words.first[of])], ["begin", "end"]
    )
    pair = np.unique((np.searchsorted(words.first, begin, "right") - 1) * max(len(block.ids), 1) + item)
    holder, which = pair // max(len(block.ids), 1), pair % max(len(block.ids), 1)
    at = lambda x: pa.array(np.searchsorted(x, np.arange(n + 1)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            piece.column(0),
            piece.column(1) if more else pa.nulls(n, pa.string()),
            pa.array(words.counts),
            pa.ListArray.from_arrays(at(of), merged),
            piece.column(3),
            pa.ListArray.from_arrays(at(holder), block.ids.take(pa.array(which))),
        ],
        ["key", "text", "n_words", "spans", "items", "found"],
    )

"""Removal of word spans that repeat anywhere in the corpus, by difference-cover anchors.

A window of ``WINDOW`` consecutive words repeats if the same words also start at another place of any document. Hashing
every window of a large corpus costs too much, so first only the short windows ("anchors") that start at places whose
number modulo ``PERIOD`` is in a difference cover are compared. Any two places, whatever their remainders, reach cover
places together within ``PERIOD`` steps, so two equal windows always hold an equal pair of anchors. Then anchors that
occur twice are extended: the full windows that contain one are hashed and compared in turn. What is equal there is
removed; both comparisons are one shuffle each, without groups, caps or samples.

Words are runs of anything but white space (0x20, 0x09-0x0D). A null or empty text has no words; a text shorter than a
window loses none. Very long texts are handled whole. Rows are told apart by key and text; a row that is there twice
repeats itself, so all its windows do. Only the columns named are read, so others may clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillweave.llm.shared_keys import SCHEMA, keyed, repeated_places
from tillweave.llm.textwords import PIECE_BYTES, Words, flat, pieces, read_words, sums_per_text

WINDOW = 35
PERIOD = 21
#: Every remainder modulo 21 is a difference of two of these.
COVER = (0, 1, 4, 14, 16)


def _numbers(words: Words) -> np.ndarray:
    """Each word's number in its text."""
    return np.arange(len(words.hashed)) - np.repeat(words.first[:-1], words.counts)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    length = WINDOW - PERIOD + 1
    covered = np.isin(np.arange(PERIOD), COVER)
    for piece in pieces(batches, "text"):
        words = read_words(piece.column(1))
        number = _numbers(words)
        long_enough = np.repeat(words.counts >= WINDOW, words.counts)
        at = np.flatnonzero(covered[number % PERIOD] & long_enough & words.window_fits(length))
        yield keyed(words.windows(length)[at], piece.column(0).to_numpy()[words.text[at]], number[at])


def spread_spans(lists: pa.Array, words: Words, before: int, after: int) -> np.ndarray:
    """Which words are within ``before`` words in front of, or ``after`` behind, a place listed for their text."""
    row = pc.list_parent_indices(lists).to_numpy()
    place = words.first[row] + lists.flatten().to_numpy()
    change = np.zeros(len(words.hashed) + 1, np.int64)
    np.add.at(change, np.maximum(place - before, words.first[row]), 1)
    np.add.at(change, np.minimum(place + after + 1, words.first[row + 1]), -1)
    return np.cumsum(change[:-1]) > 0


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts compressed, for their shuffle."""
    compressor = zstandard.ZstdCompressor(level=1)
    for piece in pieces(batches, "text"):
        data, offsets = flat(piece.column(2))
        body, at = data.tobytes(), offsets.tolist()
        texts = [compressor.compress(body[low:high]) for low, high in zip(at, at[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([*piece.columns[:2], pa.array(texts, pa.binary())], ["row", "key", "text"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    decompressor = zstandard.ZstdDecompressor()
    for part in pieces(batches, "text", PIECE_BYTES // 4):
        texts = pa.array([decompressor.decompress(x) for x in part.column(2).to_pylist()], pa.large_binary())
        whole = pa.RecordBatch.from_arrays([*part.columns[:2], texts, part.column(3)], ["row", "key", "text", "places"])
        yield from pieces([whole], "text")


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in _unpacked(batches):
        words = read_words(piece.column(2))
        near = spread_spans(piece.column(3), words, PERIOD - 1, 0)
        at = np.flatnonzero(near & words.window_fits(WINDOW))
        yield keyed(words.windows(WINDOW)[at], piece.column(0).to_numpy()[words.text[at]], _numbers(words)[at])


def _kept(original: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _unpacked(batches):
            yield _rest(piece, original)

    return read


def _rest(piece: pa.RecordBatch, original: bool) -> pa.RecordBatch:
    words = read_words(piece.column(2))
    gone = spread_spans(piece.column(3), words, 0, WINDOW - 1)
    removed = sums_per_text(gone, words.first)
    texts = []
    for i, n in enumerate(removed.tolist()):
        low, high = words.offsets[i], words.offsets[i + 1]
        body = words.data[low:high].tobytes()
        if n or not original:
            at = words.first[i] + np.flatnonzero(~gone[words.first[i] : words.first[i + 1]])
            begin, end = (words.start[at] - low).tolist(), (words.end[at] - low).tolist()
            body = b" ".join([body[x:y] for x, y in zip(begin, end, strict=True)])
        texts.append(body)
    columns = [piece.column(1), pa.array(words.counts), pa.array(removed), pa.array(texts, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["key", "n_words", "n_removed", "kept"])


def _listed(places: DataFrame) -> DataFrame:
    return places.groupBy(F.col("owner").alias("row")).agg(F.collect_list("place").alias("places"))


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", original: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept) of every row; ``kept`` is the remaining words joined by single spaces.

    With ``original``, texts that lose nothing stay as they are, white space included (a null becomes empty).
    """
    rows = docs.select(
        F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("row"), F.col(key).alias("key"), F.col(text).alias("text")
    )
    kind = rows.schema["key"].dataType
    anchors = repeated_places(rows.select("row", "text").mapInArrow(_anchors, SCHEMA))
    # Texts are shuffled once, by row: both joins read the same exchange. The lists are the small side.
    # (The inner join would add the condition, which never fails, to its own exchange alone.)
    packed = rows.mapInArrow(_packed, StructType().add("row", "long").add("key", kind).add("text", "binary")).where("row is not null")
    near = packed.join(_listed(anchors).hint("shuffle_hash"), "row").select("row", "key", "text", "places")
    windows = repeated_places(near.mapInArrow(_windows, SCHEMA))
    marked = packed.join(_listed(windows).hint("shuffle_hash"), "row", "left").select(
        "row", "key", "text", F.coalesce("places", F.expr("cast(array() as array<int>)")).alias("places")
    )
    schema = StructType().add("key", kind).add("n_words", "long").add("n_removed", "long").add("kept", "string")
    out = marked.mapInArrow(_kept(original), schema)
    return out.withColumnRenamed("key", key)

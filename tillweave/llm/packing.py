"""Best-fit packing of documents into sequences of a fixed number of tokens, by length patterns.

Documents are cut only where they exceed a sequence. What remains is a histogram of lengths, at most one bin per
possible length, whatever the corpus. Patterns of up to three lengths that fill a sequence exactly are enumerated, and
non-negative least squares tells how often each should be used to use up the histogram; the counts are rounded down,
limited to what is there, and the residual is packed best-fit by decreasing length, still as counts per length. The
plan is thus made from the histogram alone in the driver; the pieces are then numbered within their length in
parallel, and a piece's number decides its sequence and its place there.

A null or empty text has an end id only and is packed like any other; so are repeated rows, each on its own. An empty
table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillweave.llm.encoding import token_ids
from tillweave.llm.textwords import pieces
from tillweave.operators.materialize import stage

CONTEXT = 2048
_STEPS = 300


def fill_patterns(lengths: np.ndarray, context: int) -> np.ndarray:
    """Rows of three lengths, 0 for none, in descending order, that add up to a full sequence."""
    here = np.zeros(context + 1, bool)
    here[lengths] = True
    a, b = np.meshgrid(lengths, np.r_[0, lengths], indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = context - a - b
    fits = (a >= b) & (b >= c) & (c >= 0)
    a, b, c = a[fits], b[fits], c[fits]
    known = (c == 0) | here[c]
    return np.stack([a[known], b[known], c[known]], 1)


def pattern_counts(patterns: np.ndarray, histogram: np.ndarray, steps: int = _STEPS) -> np.ndarray:
    """Non-negative least squares by accelerated projected gradients: uses of each pattern that fit the histogram."""
    target = histogram.astype(float)
    target[0] = 0

    def used(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(patterns[:, k], x, len(histogram)) for k in range(3))
        out[0] = 0
        return out

    def back(y: np.ndarray) -> np.ndarray:
        return y[patterns].sum(1)

    # The largest eigenvalue, by power iteration, bounds the step.
    y = np.ones(len(patterns))
    for _ in range(20):
        y = back(used(y))
        y /= np.linalg.norm(y) or 1
    bound = 1.05 * np.linalg.norm(back(used(y))) + 1e-12
    x = ahead = np.zeros(len(patterns))
    pace = 1.0
    for _ in range(steps):
        after = np.maximum(ahead - back(used(ahead) - target) / bound, 0)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = after + (pace - 1) / faster * (after - x)
        x, pace = after, faster
    return x


def best_fit(histogram: np.ndarray, context: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: (lengths of a sequence, how many such sequences)."""
    open_: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    done: list[tuple[tuple[int, ...], int]] = []
    space = np.zeros(context + 1, np.int64)  # open sequences by space left
    for length in range(context, 0, -1):
        left = int(histogram[length])
        while left:
            fitting = np.flatnonzero(space[length:])
            at = int(fitting[0]) + length if len(fitting) else context
            if not len(fitting):
                held, n = (), -(-left // (context // length))
            else:
                held, n = next(iter(open_[at].items()))
            each = min(at // length, left)  # a sequence at hand is filled before the next
            n = min(n, left // each)
            if len(fitting):
                open_[at][held] -= n
                space[at] -= n
                if not open_[at][held]:
                    del open_[at][held]
            left -= n * each
            full, rest = held + (length,) * each, at - length * each
            if rest:
                open_[rest][full] += n
                space[rest] += n
            else:
                done.append((full, n))
    done.extend((held, n) for by in open_.values() for held, n in by.items() if n)
    return done


def pack_histogram(histogram: np.ndarray, context: int) -> list[tuple[tuple[int, ...], int]]:
    """How many sequences of which lengths hold exactly the pieces of the histogram (index: length)."""
    left = histogram.astype(np.int64).copy()
    plan: list[tuple[tuple[int, ...], int]] = []
    if left[context]:
        plan.append(((context,), int(left[context])))
        left[context] = 0
    lengths = np.flatnonzero(left)
    patterns = fill_patterns(lengths[lengths > 0], context) if len(lengths) else np.empty((0, 3), np.int64)
    if len(patterns):
        wanted = np.floor(pattern_counts(patterns, left) + 1e-6).astype(np.int64)
        for at in np.argsort(-wanted, kind="stable"):
            if not wanted[at]:
                break
            pattern = tuple(int(x) for x in patterns[at] if x)
            n = min(int(wanted[at]), *(int(left[x]) // pattern.count(x) for x in pattern))
            if n > 0:
                for x in pattern:
                    left[x] -= n
                plan.append((pattern, n))
    return plan + best_fit(left, context)


@dataclass(frozen=True)
class Slots:
    """For each length, by number within the length: where a piece goes."""

    begin: np.ndarray  # of a length's slots in the arrays below
    first: np.ndarray  # number of the first piece of a slot
    sequence: np.ndarray  # its sequence; the next pieces of the slot go to the next sequences
    offset: np.ndarray


def slots(plan: list[tuple[tuple[int, ...], int]], context: int) -> Slots:
    rows, taken, sequence = [], np.zeros(context + 1, np.int64), 0
    for lengths, n in plan:
        offset = 0
        for length in lengths:
            rows.append((length, int(taken[length]), sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Slots(np.searchsorted(table[:, 0], np.arange(context + 2)), *table[:, 1:].T)


def cut_pieces(docs: DataFrame, vocabulary: str, *, key: str, text: str, context: int, end_id: int) -> DataFrame:
    """(key, row, piece, start, length, ids_crc32) of every piece of every row; ``row`` is a hash of key and text."""
    rows = docs.select(
        F.col(key).alias("key"), F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("row"), F.col(text).alias("text")
    )
    kind = rows.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for part in pieces(batches, "text"):
            _, ids, first = token_ids(vocabulary, part.column(2))
            body = ids.astype("<u4").tobytes()
            of, piece, start, length, crc = [], [], [], [], []
            for i, (low, high) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                whole = body[4 * low : 4 * high] + end
                for number, at in enumerate(range(0, len(whole), 4 * context)):
                    held = whole[at : at + 4 * context]
                    of.append(i)
                    piece.append(number)
                    start.append(at // 4)
                    length.append(len(held) // 4)
                    crc.append(zlib.crc32(held))
            at = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(at),
                    part.column(1).take(at),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ],
                ["key", "row", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(cut, f"key {kind}, row long, piece int, start long, length long, ids_crc32 long")


def number_within(rows: DataFrame, by: str, unique: list[str], groups: int) -> DataFrame:
    """Adds ``number``, 0 to n - 1 within each value of ``by``, without bringing a value's rows together.

    Rows are numbered within (value, hash group), and a group's numbers begin after those of the groups before.
    """
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*unique), F.lit(groups)).cast("int"))
    counts = dealt.groupBy(by, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(by, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(by, "_part").orderBy(*unique)) - 1
    numbered = dealt.withColumn("_place", place).join(counts, [by, "_part"])
    return numbered.withColumn("number", F.col("_before") + F.col("_place")).drop("_part", "_place", "_before")


def pack(
    docs: DataFrame,
    vocabulary: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    context: int = CONTEXT,
    end_id: int = 0,
    rows_per_group: int = 200_000,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row."""
    cut = stage(cut_pieces(docs, vocabulary, key=key, text=text, context=context, end_id=end_id), "pack_pieces")
    found = cut.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most `context` rows
    histogram = np.zeros(context + 1, np.int64)
    for row in found:
        histogram[row["length"]] = row["n"]
    plan = slots(pack_histogram(histogram, context), context)
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    groups = max(64, int(histogram.sum()) // rows_per_group)
    numbered = number_within(cut, "length", ["row", "piece"], groups).select(
        "key", "piece", "start", "length", "ids_crc32", "number"
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = shared.value
        for batch in batches:
            length, number = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.empty(len(length), np.int64)
            for one in np.unique(length):
                mine = length == one
                low, high = to.begin[one], to.begin[one + 1]
                at[mine] = low + np.searchsorted(to.first[low:high], number[mine], "right") - 1
            sequence = to.sequence[at] + number - to.first[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(to.offset[at])],
                ["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = docs.schema[key].dataType.simpleString()
    out = numbered.mapInArrow(
        place, f"key {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return out.withColumnRenamed("key", key)

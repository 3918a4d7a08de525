"""Fill-in-middle transformation by block rotations in place, and its exact inverse.

A text of n code points is cut at two places below n + 1 that two numbers choose, which come from a SHA-256 of the
document's key. The cuts are scanned for in the UTF-8 bytes, the sentinels are inserted in a bytearray
(prefix sentinel, prefix, middle sentinel, middle, suffix sentinel, suffix), and the blocks are brought into the order
of the form by a rotation: each of two neighbouring segments is reversed, then both together, in place and by steps of
bounded size. Restoring finds the sentinels, rotates by the other amount and deletes them.

Forms: ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) and ``plain`` (as it is). A text that holds a
sentinel stays plain, so that the sentinels of an output are found without doubt: a sentinel begins with ``<`` and has
no other, so none can arise where two parts meet.

Null texts count as empty, empty texts stay plain. A text of any length is one bytearray; nothing else of its size is
held but the output. A null key draws the numbers of an empty key. Repeated rows are transformed alike, each row alone;
an empty table gives an empty result. Only the columns named are read, so others may clash. No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillweave.llm.textwords import flat, pieces

_STEP = 1 << 20


@dataclass(frozen=True)
class Sentinels:
    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    def __post_init__(self) -> None:
        begins = {mark[:1] for mark in self}
        if not all(self) or len(set(self)) < 3 or any(first in mark[1:] for first in begins for mark in self):
            raise ValueError("sentinels must differ, and hold the first byte of any only at their beginning")

    def __iter__(self) -> Iterator[bytes]:
        return iter((self.prefix, self.suffix, self.middle))


SENTINELS = Sentinels()


def reverse(data: np.ndarray, begin: int, end: int) -> None:
    """Reverse ``data[begin:end]`` in place, by exchanging blocks of its two ends."""
    while end - begin > 1:
        size = min(_STEP, (end - begin) // 2)
        head = data[begin : begin + size].copy()
        data[begin : begin + size] = data[end - size : end][::-1]
        data[end - size : end] = head[::-1]
        begin, end = begin + size, end - size


def rotate(block: bytearray, begin: int, cut: int, end: int) -> None:
    """Exchange the neighbouring segments ``begin:cut`` and ``cut:end`` in place, by three reversals."""
    data = np.frombuffer(block, np.uint8)
    reverse(data, begin, cut)
    reverse(data, cut, end)
    reverse(data, begin, end)


def code_points(data: np.ndarray) -> int:
    return sum(int(np.count_nonzero(data[at : at + _STEP] & 0xC0 != 0x80)) for at in range(0, len(data), _STEP))


def scan_cuts(data: np.ndarray, wanted: tuple[int, int]) -> tuple[int, int]:
    """The byte places where the code points of the two ascending numbers begin; the number of all: the end."""
    found, before = [], 0
    for at in range(0, len(data), _STEP):
        starts = np.flatnonzero(data[at : at + _STEP] & 0xC0 != 0x80)
        while len(found) < len(wanted) and wanted[len(found)] < before + len(starts):
            found.append(at + int(starts[wanted[len(found)] - before]))
        before += len(starts)
        if len(found) == len(wanted):
            break
    first, second = found + [len(data)] * (len(wanted) - len(found))
    return first, second


def arrange(text: bytes, cuts: tuple[int, int], form: str, marks: Sentinels = SENTINELS) -> bytearray:
    """The text with sentinels, its three parts (cut at byte places) in the order of the form."""
    block = bytearray(text)
    if form == "plain":
        return block
    first, second = cuts
    block[second:second] = marks.suffix
    block[first:first] = marks.middle
    block[0:0] = marks.prefix
    middle = len(marks.prefix) + first
    suffix = second + len(marks.prefix) + len(marks.middle)
    rotate(block, middle if form == "psm" else 0, suffix, len(block))
    return block


def rebuild(output: bytes, form: str, marks: Sentinels = SENTINELS) -> bytearray:
    """The text that ``arrange`` made the output of, by the inverse rotation."""
    block = bytearray(output)
    if form == "plain":
        return block
    prefix, suffix, middle = (block.index(mark) for mark in marks)
    if form == "psm":  # the suffix is block[suffix:middle], and goes behind the middle
        rotate(block, suffix, middle, len(block))
        middle, suffix = suffix, suffix + len(block) - middle
    else:  # the suffix is block[:prefix], and goes to the end
        rotate(block, 0, prefix, len(block))
        prefix, middle, suffix = 0, middle - prefix, len(block) - prefix
    del block[suffix : suffix + len(marks.suffix)]
    del block[middle : middle + len(marks.middle)]
    del block[: len(marks.prefix)]
    return block


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, bytes]]:
    data, offsets = flat(column)
    for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield data[low:high], data[low:high].tobytes()


def draws(key: Column, seed: int) -> Column:
    """Four unsigned 32-bit numbers from the SHA-256 of the seed and the key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)))


def fill_in_middle(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 1,
    changed_percent: int = 90,
    spm_percent: int = 20,
    marks: Sentinels = SENTINELS,
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row, in code points; null counts for plain ones."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), draws(F.col(key), seed).alias("draws"))

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            numbers = piece.column(2).flatten().to_numpy().reshape(-1, 4).tolist()
            counts, forms, prefixes, middles, outputs = [], [], [], [], []
            for (data, body), (h1, h2, h3, h4) in zip(_texts(piece.column(1)), numbers, strict=True):
                n, form, cuts, prefix, middle = code_points(data), "plain", (0, 0), None, None
                if n and h3 % 100 < changed_percent and not any(mark in body for mark in marks):
                    form = "spm" if h4 % 100 < spm_percent else "psm"
                    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                    cuts, prefix, middle = scan_cuts(data, (low, high)), low, high - low
                counts.append(n)
                forms.append(form)
                prefixes.append(prefix)
                middles.append(middle)
                outputs.append(bytes(arrange(body, cuts, form, marks)))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(forms, pa.string()),
                    pa.array(prefixes, pa.int64()),
                    pa.array(middles, pa.int64()),
                    pa.array(outputs, pa.binary()).view(pa.string()),
                ],
                ["key", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    schema = f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(transform, schema).withColumnRenamed("key", key)


def restored(
    transformed: DataFrame,
    *,
    output: str = "output",
    form: str = "form",
    name: str = "restored",
    marks: Sentinels = SENTINELS,
) -> DataFrame:
    """The rows with the text rebuilt from output and form alone as a further column; null output or form: empty."""
    if name in transformed.columns:
        raise ValueError(f"there is a column {name} already")
    schema = StructType([*transformed.schema.fields, StructField(name, StringType())])

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, output):
            forms = piece.column(piece.schema.get_field_index(form)).to_pylist()
            bodies = _texts(piece.column(piece.schema.get_field_index(output)))
            texts = [bytes(rebuild(body, how or "plain", marks)) for (_, body), how in zip(bodies, forms, strict=True)]
            columns = [*piece.columns, pa.array(texts, pa.binary()).view(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*piece.schema.names, name])

    return transformed.mapInArrow(rebuilt, schema)

"""Quality rules: counts of each text, and lines that too many documents of a host share.

Lines are cut at newlines and normalised (A-Z in lower case, words joined by one space); their hashes are counted once
per distinct text and host. A line is common on a host if more than ``most_documents`` of its distinct texts have it,
however large the host is; with ``most_share`` these must also be more than that share of all its texts. Common lines go;
a document is rejected if less than ``least_left`` of its words are left, or if its own counts fail. Texts that are equal are one document here: copies are left to
deduplication and don't make their own lines common.

A null or empty text has zero counts and fails the rule on words. A null host is a host of its own. Repeated rows are
judged alike. Very long texts are counted whole. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm.textwords import Words, byte_set, mix, pieces, read_words, sums_per_text
from tillweave.operators.materialize import stage

_U = np.uint64
_NEWLINE = byte_set((0x0A, 0x0A))
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_CONTINUES = byte_set((0x80, 0xBF))
REPEAT = 8


def _running(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _repeated_words(words: Words) -> np.ndarray:
    """How many words of each text lie in windows of 8 words that the text has twice or more."""
    fits = np.flatnonzero(words.window_fits(REPEAT))
    seen = pd.Series(mix(words.windows(REPEAT)[fits] ^ mix(words.text[fits].astype(_U))))
    starts = fits[seen.duplicated(keep=False).to_numpy()]
    change = np.zeros(len(words.hashed) + 1, np.int64)
    change[starts] += 1
    np.add.at(change, starts + REPEAT, -1)
    return sums_per_text(np.cumsum(change[:-1]) > 0, words.first)


def _lines(texts: pa.Array, words: Words) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word: their exact hashes and texts, hashes of their normalised words, and numbers of words."""
    lines = read_words(texts, _NEWLINE)
    lower = read_words(texts, lower=True).hashed
    low, high = np.searchsorted(words.start, lines.start), np.searchsorted(words.start, lines.end)
    full = high > low
    low, high, text = low[full], high[full], lines.text[full]
    # A line's words are hashed as a sequence: each with its number in the line.
    place = np.arange(len(lower)) - np.repeat(low, high - low) if len(low) else np.empty(0, np.int64)
    sums = np.zeros(len(lower) + 1, _U)
    np.cumsum(mix(lower ^ mix(place.astype(_U))), out=sums[1:])
    return lines.hashed[full], text, mix(sums[high] - sums[low]), high - low


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        texts = piece.column(3)
        words = read_words(texts)
        n = len(words.first) - 1
        points, symbols = _running(~_CONTINUES[words.data]), _running(_SYMBOLS[words.data])
        exact, text, line, size = _lines(texts, words)
        again = pd.Series(mix(exact ^ mix(text.astype(_U)))).duplicated().to_numpy()
        # Distinct normalised lines of each text, with all the words they hold there.
        held = pd.DataFrame({"text": text, "line": line.view(np.int64), "words": size}).groupby(["text", "line"]).sum()
        held = held.reset_index()
        places = pa.array(np.searchsorted(held["text"].to_numpy(), np.arange(n + 1)).astype(np.int32))
        of = pa.StructArray.from_arrays([pa.array(held["line"].to_numpy()), pa.array(held["words"].to_numpy())], ["line", "words"])
        yield pa.RecordBatch.from_arrays(
            [
                *piece.columns[:3],
                pa.array(words.counts),
                pa.array(sums_per_text(points[words.end] - points[words.start], words.first)),
                pa.array(symbols[words.offsets[1:]] - symbols[words.offsets[:-1]]),
                pa.array(np.bincount(text[again], minlength=n)),
                pa.array(_repeated_words(words)),
                pa.ListArray.from_arrays(places, of),
            ],
            ["key", "host", "content", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"],
        )


def common_lines(lines: DataFrame, texts: DataFrame, most_documents: int, most_share: float) -> DataFrame:
    """(host, line) on more texts of a host than both limits allow; ``lines`` (host, content, line) may repeat."""
    totals = texts.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    counts = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > most_documents)
    return counts.join(totals, "host").where(F.col("n") > F.col("texts") * most_share).select("host", "line")


def judge(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    most_documents: int = 20,
    most_share: float = 0.0,
    least_left: float = 0.5,
) -> DataFrame:
    """Counts and verdict of every row; ``common`` are the hashes of its lines to be removed."""
    rows = docs.select(
        F.col(key).alias("key"),
        F.xxhash64(host).alias("host"),  # null-safe
        F.xxhash64(text).alias("content"),
        F.col(text).alias("text"),
    )
    kind = rows.schema["key"].dataType.simpleString()
    measured = stage(
        rows.mapInArrow(
            _measure,
            f"key {kind}, host long, content long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, lines array<struct<line:long,words:long>>",
        ),
        "quality",
    )
    # Equal texts of one host share their lines' fate, so lines are kept once for them.
    texts = measured.select("host", "content", "lines").dropDuplicates(["host", "content"])
    lines = texts.select("host", "content", F.explode("lines").alias("l")).select("host", "content", "l.line", "l.words")
    common = common_lines(lines.select("host", "content", "line"), measured, most_documents, most_share)
    lost = (
        lines.join(common, ["host", "line"])
        .groupBy("host", "content")
        .agg(F.sum("words").alias("n_common_words"), F.collect_set("line").alias("common"))
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_common_words")
    return (
        measured.drop("lines")
        .join(lost, ["host", "content"], "left")
        .withColumn("n_common_words", F.coalesce("n_common_words", F.lit(0)))
        .withColumn("common", F.coalesce("common", F.expr("cast(array() as array<long>)")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (left >= least_left * F.col("n_words")))
        .withColumnRenamed("key", key)
    )


def without_common_lines(docs: DataFrame, judged: DataFrame, *, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` whose verdict is to keep them, their texts without the common lines."""
    fate = judged.where("kept").select("host", "content", "common").dropDuplicates(["host", "content"])
    fate = fate.select(F.col("host").alias("_host"), F.col("content").alias("_content"), F.col("common").alias("_common"))
    same = (F.xxhash64(docs[host]) == F.col("_host")) & (F.xxhash64(docs[text]) == F.col("_content"))
    rows = docs.join(fate, same).drop("_host", "_content")
    at = rows.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            texts, common = piece.column(at), piece.column(piece.num_columns - 1)
            words = read_words(texts)
            _, of, line, _ = _lines(texts, words)
            bad = pd.MultiIndex.from_arrays([pc.list_parent_indices(common).to_numpy(), common.flatten().to_numpy()])
            gone = pd.MultiIndex.from_arrays([of, line.view(np.int64)]).isin(bad) if len(bad) else np.zeros(len(of), bool)
            number = np.arange(len(of)) - np.searchsorted(of, of)
            out = texts.to_pylist()
            for row in np.unique(of[gone]).tolist():
                drop, kept, at_line = set(number[(of == row) & gone].tolist()), [], 0
                for one in out[row].split("\n"):
                    full = bool(one.strip(" \t\n\v\f\r"))
                    if not (full and at_line in drop):
                        kept.append(one)
                    at_line += full
                out[row] = "\n".join(kept)
            columns = piece.columns[:-1]
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, piece.schema.names[:-1])

    return rows.mapInArrow(clean, docs.schema)

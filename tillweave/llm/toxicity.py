"""A linear classifier of toxic texts on character n-grams, scaled by naive Bayes log-count ratios.

Features are the n-grams of 3 to 8 characters of a text's words, a space at either end of a word included, A-Z in lower
case, hashed to 2**20 numbers; a text has a feature or hasn't. For each feature the training texts with it are counted
by label, and the log ratio of its (smoothed) shares is its scale. Features that ``least`` training texts have and whose
counts tell the labels apart beyond chance (the chi-squared statistic exceeds ``level``; the default is a chance of
1 in 1,000) are kept, however many; the others say nothing that the sample could show. A logistic regression with a
ridge penalty is fitted on the scaled features. Scores need the text only.

Fitting uses at most ``sample`` labelled rows (by a hash of the key; a documented bound), whole texts each; the driver
holds the numbers of their kept features, a few for each text. The model, of 2**20 features at most, is broadcast.
Scoring reads every text once, without a shuffle; the words of a piece share their features through a memo.

Null and empty texts get the score of a text without features, very long ones are read whole. Without labelled rows of
both labels every score is 0. Labels other than 0 and 1 are ignored; a document with several labels counts with each.
Repeated rows are scored alike; an empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.llm.textwords import NON_ALPHANUMERIC, Memo, Words, mix, pieces, read_words, window_hashes
from tillweave.operators.materialize import stage

SIZES = (3, 4, 5, 6, 7, 8)
SLOTS = 1 << 20
SAMPLE = 20_000
LEVEL = 10.83  # of the chi-squared statistic with one degree of freedom
LEAST = 3
_PIECE = 1 << 19
_MEMO = 1 << 19
_U = np.uint64


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The slots of each word's n-grams: how many, and all in a row."""
    text = " " + " ".join(x.decode("utf-8", "replace").replace(" ", "_") for x in words) + " "
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    space = points == 32
    spaces = np.zeros(len(points) + 1, np.int64)
    np.cumsum(space, out=spaces[1:])
    hashed = mix(points.astype(_U))
    owner, slot = [], []
    for n in SIZES:
        begin = np.arange(max(len(points) - n + 1, 0))
        inner = spaces[begin + n - 1] - spaces[begin + 1]  # spaces that are neither first nor last
        begin = begin[inner == 0]
        owner.append(spaces[begin + 1] - 1)
        slot.append((window_hashes(hashed, n)[begin] % _U(SLOTS)).astype(np.int32))
    owners, slots = np.concatenate(owner), np.concatenate(slot)
    order = np.argsort(owners, kind="stable")
    return np.bincount(owners, minlength=len(words)), slots[order]


@dataclass(frozen=True)
class Model:
    slots: np.ndarray  # of the kept features, ascending
    weights: np.ndarray  # ratio times coefficient
    bias: float

    def word_features(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the kept features of each word."""
        size, slots = word_grams(words)
        at = np.minimum(np.searchsorted(self.slots, slots), max(len(self.slots) - 1, 0))
        kept = self.slots[at] == slots if len(self.slots) else np.zeros(len(slots), bool)
        owner = np.repeat(np.arange(len(words)), size)[kept]
        return np.bincount(owner, minlength=len(words)), at[kept].astype(np.int32)


def text_features(words: Words, memo: Memo, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) of all texts, in order of the text."""
    first = ~pd.Series(mix(words.hashed ^ mix(words.text.astype(_U)))).duplicated().to_numpy()
    once = Words(words.data, words.offsets, words.start[first], words.end[first], words.hashed[first], words.first)
    size, features = memo(once)
    pair = np.repeat(words.text[first], size) * n_features + features
    pair = np.sort(pd.unique(pair))
    return pair // n_features, pair % n_features


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = Memo(word_grams, 1 << 17)
    totals = np.zeros((2, SLOTS), np.int64)
    for piece in pieces(batches, "text", _PIECE):
        text, slot = text_features(read_words(piece.column(1), NON_ALPHANUMERIC, lower=True), memo, SLOTS)
        label = piece.column(0).to_numpy()
        for one in (0, 1):
            totals[one] += np.bincount(slot[label[text] == one], minlength=SLOTS)
    used = np.flatnonzero(totals.sum(0))
    yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(x[used]) for x in totals)], ["slot", "n0", "n1"])


def _logistic(text: np.ndarray, feature: np.ndarray, value: np.ndarray, label: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps; the bias is the last coefficient."""
    n, width = len(label), len(value)
    parts = [slice(at, at + (1 << 19)) for at in range(0, len(text), 1 << 19)]  # bounds what a step holds at once

    def margin(w: np.ndarray) -> np.ndarray:
        scaled = value * w[:-1]
        return sum((np.bincount(text[p], scaled[feature[p]], n) for p in parts), np.full(n, w[-1]))

    def slope(error: np.ndarray) -> np.ndarray:
        sums = sum((np.bincount(feature[p], error[text[p]], width) for p in parts), np.zeros(width))
        return np.r_[value * sums, error.sum()]

    v = np.ones(width + 1)
    for _ in range(15):
        v = slope(margin(v))
        v /= np.linalg.norm(v) or 1
    step = 1 / (0.25 * np.linalg.norm(slope(margin(v))) * 1.1 / n + ridge + 1e-12)
    w = ahead = np.zeros(width + 1)
    pace = 1.0
    for _ in range(400):
        gradient = slope(1 / (1 + np.exp(-margin(ahead))) - label) / n
        gradient[:-1] += ridge * ahead[:-1]
        after = ahead - step * gradient
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, w, pace = after + (pace - 1) / faster * (after - w), after, faster
    return w[:-1], float(w[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    usable: Column | None = None,
    sample: int = SAMPLE,
    level: float = LEVEL,
    least: int = LEAST,
    ridge: float = 1e-4,
) -> Model:
    """Fit on the labelled rows; ``usable`` is a condition on the labels' key, for rows that must not be learned."""
    labelled = labels.where(F.col(label).isin(0, 1))
    if usable is not None:
        labelled = labelled.where(usable)
    labelled = labelled.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    chosen = labelled.orderBy(F.xxhash64(F.col("_key").cast("string")), "_key", "_label").limit(sample)
    rows = docs.join(F.broadcast(chosen), docs[key] == F.col("_key")).select(
        F.col("_label").alias("label"), F.col(text).alias("text")
    )
    rows = stage(rows, "labelled")
    shares = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return Model(np.empty(0, np.int32), np.empty(0), -np.inf)
    # Sums over hashed slots: a fixed number of them.
    a, c = F.col("n1"), F.col("n0")
    b, d = shares[1] - a, shares[0] - c
    chi = sum(shares.values()) * F.pow(a * d - b * c, 2) / ((a + b) * (c + d) * (a + c) * (b + d) + 1)
    counts = rows.mapInArrow(_counts, "slot long, n0 long, n1 long").groupBy("slot")
    counts = counts.agg(F.sum("n0").cast("double").alias("n0"), F.sum("n1").cast("double").alias("n1"))
    kept = counts.where((a + c >= least) & (chi > level)).toPandas().sort_values("slot")
    ratio = np.log((kept["n1"] + 1) / (kept["n1"].sum() + len(kept))) - np.log(
        (kept["n0"] + 1) / (kept["n0"].sum() + len(kept))
    )
    model = Model(kept["slot"].to_numpy().astype(np.int32), ratio.to_numpy(), 0.0)
    number = np.dtype("<u2" if len(model.slots) <= 1 << 16 else "<u4")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(model.word_features, 1 << 18)
        for piece in pieces(batches, "text", _PIECE):
            words = read_words(piece.column(1), NON_ALPHANUMERIC, lower=True)
            of, feature = text_features(words, memo, max(len(model.slots), 1))
            places = np.searchsorted(of, np.arange(piece.num_rows + 1))
            data = feature.astype(number)
            lists = pa.array([data[a:b].tobytes() for a, b in zip(places, places[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([piece.column(0), lists], ["label", "features"])

    held = rows.mapInArrow(vectors, "label int, features binary").toArrow()  # at most `sample` rows
    # In an order that depends on nothing but the rows, as the last digits of sums do.
    held = held.take(pc.sort_indices(held, sort_keys=[("label", "ascending"), ("features", "ascending")]))
    lists, label_of = held["features"].combine_chunks(), held["label"].to_numpy().astype(float)
    del held
    size = pc.binary_length(lists).to_numpy() // number.itemsize
    _, places, data = lists.buffers()
    first, last = np.frombuffer(places, np.int32)[[lists.offset, lists.offset + len(lists)]]
    feature = np.frombuffer(data, np.uint8)[first:last].view(number) if last > first else np.empty(0, number)
    of = np.repeat(np.arange(len(size), dtype=np.int32), size)
    weight, bias = _logistic(of, feature, model.weights, label_of, ridge)
    return Model(model.slots, model.weights * weight, bias)


def scores_of(texts: pa.Array, model: Model, memo: Memo) -> np.ndarray:
    words = read_words(texts, NON_ALPHANUMERIC, lower=True)
    of, feature = text_features(words, memo, max(len(model.slots), 1))
    total = np.bincount(of, model.weights[feature], len(texts)) if len(of) else np.zeros(len(texts))
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-(total + model.bias)))


def score(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, score) of every row, with the columns of ``keep``; score is the probability of label 1."""
    columns = [F.col(name).alias(f"c{i}") for i, name in enumerate((key, *keep))]
    rows = docs.select(*columns, F.col(text).alias("text"))
    at = len(columns)
    shared: Broadcast[Model] = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(shared.value.word_features, _MEMO)
        for piece in pieces(batches, "text", 2 * _PIECE):
            found = scores_of(piece.column(at), shared.value, memo)
            yield pa.RecordBatch.from_arrays([*piece.columns[:at], pa.array(found)], [*piece.schema.names[:at], "score"])

    types = ", ".join(f"c{i} {docs.schema[name].dataType.simpleString()}" for i, name in enumerate((key, *keep)))
    out = rows.mapInArrow(scored, f"{types}, score double")
    return out.toDF(key, *keep, "score")


def without_toxic(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score below the threshold, as they are."""
    shared: Broadcast[Model] = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(shared.value.word_features, _MEMO)
        for piece in pieces(batches, text, 2 * _PIECE):
            found = scores_of(piece.column(piece.schema.get_field_index(text)), shared.value, memo)
            yield piece.filter(pa.array(found < threshold))

    return docs.mapInArrow(kept, docs.schema)

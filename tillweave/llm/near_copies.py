"""Similarity join of documents on word shingles, by chosen paths.

A document is the set of its shingles, ``SHINGLE`` consecutive words each; one of fewer words is the one shingle of all
its words, one without words is the empty set and similar to nothing. Documents of equal sets are one node with a
number of copies, so copies never meet as pairs.

In each of several independent runs a node goes to a bucket for every shingle whose random number falls below
``1 / (similarity * size)``: one that two similar sets share is chosen by both, or not, together. Buckets of more than
``limit`` nodes are split in the same way by a further shingle. In small buckets all nodes are compared: sizes and
one-permutation sketches first, then the exact sets. Runs are repeated as often as the target recall needs for a pair
at the very threshold at the last level; more similar pairs are missed far less. Buckets that are still too large at
the last level, such as those of thousands of near copies, are compared exactly block by block.

A pair meets in several buckets. It counts in the smallest of its common buckets only, which both nodes know, so links
are counted without a table of pairs; what leaves a bucket is a number of links and one edge for each node.

Results per row: ``class_id``, the smallest key that is reached over links; ``n_links``, the other rows at the
similarity or above (copies included); ``copy_of``, the smallest key with the same set; ``n_copies``, the rows with it.
Null and empty texts have themselves as class and no links. Repeated rows are copies of each other. Null keys are
allowed; a class of null keys only has a null id. Columns other than the two named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm.components import components
from tillweave.llm.textwords import Words, mix, pieces, ragged, read_words, segments
from tillweave.operators.materialize import stage

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.9995
LIMIT = 1000
LEVELS = 2
#: Rows of 8 bytes that may be sent to every task.
BROADCAST_ROWS = 2_000_000
_BINS = 64
_U = np.uint64
_TOP = float(1 << 64)


def runs_for(recall: float, levels: int) -> int:
    """Runs until a pair at the threshold, which shares one chosen shingle per level on average, is met."""
    met = 1.0
    for _ in range(levels):
        met = 1 - math.exp(-met)
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts in a row, and where each text's begin (and the end)."""
    hashed = words.windows(SHINGLE)
    text = words.text
    keep = words.window_fits(SHINGLE)
    for size in range(1, SHINGLE):
        short = np.flatnonzero(words.counts == size)
        at = words.first[short]
        hashed[at] = words.windows(size)[at]
        keep[at] = True
    hashed, text = hashed[keep], text[keep]
    fresh = ~pd.Series(mix(hashed ^ mix(text.astype(_U)))).duplicated().to_numpy()
    hashed, text = hashed[fresh], text[fresh]
    return hashed, np.searchsorted(text, np.arange(len(words.first)))


def _chosen(shingles: np.ndarray, size: np.ndarray, seed: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which shingles a node of ``size`` shingles follows under a seed, and the paths they lead to."""
    number = mix(shingles ^ seed)
    follow = number.astype(np.float64) < _TOP / (similarity * np.maximum(size, 1))
    return np.flatnonzero(follow), mix(number[follow] + _U(1))


def _sketches(shingles: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """One byte for each of 64 bins: 0 if no shingle falls there, else a hash of the smallest."""
    number = mix(shingles ^ _U(0x5DEECE66D))
    least = np.full(n * _BINS, np.iinfo(np.uint64).max, _U)
    np.minimum.at(least, text * _BINS + (number >> _U(58)).astype(np.int64), number)
    out = (mix(least) % _U(255) + _U(1)).astype(np.uint8)
    out[least == np.iinfo(np.uint64).max] = 0
    return out.reshape(n, _BINS)


def _fixed(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    places = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(rows))])


def _lists(values: np.ndarray, text: np.ndarray, n: int) -> pa.Array:
    order = np.argsort(text, kind="stable")
    places = np.searchsorted(text[order], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(values[order].view(np.int64)))


def _members(similarity: float, runs: int):
    seeds = mix(np.arange(1, runs + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            shingles, first = shingle_sets(read_words(piece.column(2)))
            size = np.diff(first)
            n = len(size)
            text = np.repeat(np.arange(n), size)
            sums = np.zeros(len(shingles) + 1, _U)
            np.cumsum(mix(shingles ^ _U(0xA5A5A5A5)), out=sums[1:])
            node = mix(sums[first[1:]] - sums[first[:-1]] + size.astype(_U))
            at, paths = zip(*(_chosen(shingles, size[text], seed, similarity) for seed in seeds), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    piece.column(1),
                    pa.array(node.view(np.int64), mask=size == 0),
                    pa.array(size),
                    _fixed(_sketches(shingles, text, n)),
                    _lists(np.concatenate(paths), text[np.concatenate(at)], n),
                ],
                ["row", "key", "node", "size", "sketch", "paths"],
            )

    return read


def _set_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        shingles, first = shingle_sets(read_words(piece.column(1)))
        shingles = shingles[np.lexsort((shingles, np.repeat(np.arange(len(first) - 1), np.diff(first))))]
        body = pa.py_buffer(shingles)
        sets = pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((first * 8).astype(np.int32)), body])
        yield pa.RecordBatch.from_arrays([piece.column(0), sets], ["node", "shingles"])


def _numbers(shingles: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed sets of a column in a row, and where each begins (and the end)."""
    places = np.frombuffer(shingles.buffers()[1], np.int32)[shingles.offset : shingles.offset + len(shingles) + 1]
    data = np.frombuffer(shingles.buffers()[2], np.uint8)[places[0] : places[-1]]
    return np.frombuffer(data.tobytes(), _U), (places - places[0]) // 8


def _split(similarity: float):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                shingles, first = _numbers(part.column(2))
                size = np.diff(first).astype(np.int64)
                path = part.column(0).to_numpy().view(_U)
                chosen, paths = _chosen(shingles, np.repeat(size, size), mix(np.repeat(path, size)), similarity)
                of = np.searchsorted(first, chosen, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths.view(np.int64)), part.column(1).take(pa.array(of))], ["path", "node"]
                )

    return read


def _pairs(group: np.ndarray, side: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group, in pieces: all of a whole bucket, those across the two blocks of a split one."""
    n = len(group)
    partners = np.searchsorted(group, group, "right") - np.arange(n) - 1
    upto = np.cumsum(partners)
    at = 0
    while at < n:
        end = max(int(np.searchsorted(upto, upto[at] - partners[at] + most, "right")), at + 1)
        count = partners[at:end]
        x = np.repeat(np.arange(at, end), count)
        y = ragged(np.arange(at, end) + 1, count)
        apart = (side[x] == 0) | (side[x] != side[y])
        yield x[apart], y[apart]
        at = end


def _alike(x, y, size: np.ndarray, sketch: np.ndarray, similarity: float) -> np.ndarray:
    """Pairs that sizes and sketches don't rule out: the estimate is less than 4.5 standard errors too low."""
    low, high = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
    close = np.flatnonzero(low >= similarity * high - 1e-9)
    a, b = sketch[x[close]], sketch[y[close]]
    used = np.maximum(((a | b) > 0).sum(1), 1)
    share = ((a == b) & (a > 0)).sum(1) / used
    return close[share >= similarity - 4.5 * np.sqrt(similarity * (1 - similarity) / used)]


def _sketch_rows(column: pa.Array) -> np.ndarray:
    places = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[places[0] : places[-1]].reshape(len(column), _BINS)


def _candidates(similarity: float):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in segments(batches, "group"):
            group, side, size = (rows.column(i).to_numpy() for i in (0, 2, 4))
            sketch = _sketch_rows(rows.column(5))
            met = np.zeros(rows.num_rows, bool)
            for x, y in _pairs(group, side):
                good = _alike(x, y, size, sketch, similarity)
                met[x[good]] = met[y[good]] = True
            yield rows.select(["group", "bucket", "side", "node"]).filter(pa.array(met))

    return read


def _bucket_table(column: pa.Array) -> np.ndarray:
    """Ascending bucket numbers of each row, filled up with the largest number."""
    size = pc.list_value_length(column).to_numpy()
    out = np.full((len(column), int(size.max(initial=1))), np.iinfo(np.int64).max)
    out[np.arange(out.shape[1]) < size[:, None]] = column.flatten().to_numpy()
    return np.sort(out, 1)


def _first_common(x: np.ndarray, y: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """The smallest bucket that both rows of each pair know."""
    out = np.empty(len(x), np.int64)
    step = max(1, (1 << 22) // buckets.shape[1] ** 2)
    for at in range(0, len(x), step):
        a, b = buckets[x[at : at + step]], buckets[y[at : at + step]]
        both = (a[:, :, None] == b[:, None, :]).any(2)
        out[at : at + step] = a[np.arange(len(a)), both.argmax(1)]
    return out


def _counting(similarity: float):
    """Rows of (group, bucket, side, node, size, sketch, buckets) in whose bucket one of their pairs counts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in segments(batches, "group"):
            group, bucket, side, size = (rows.column(i).to_numpy() for i in (0, 1, 2, 4))
            sketch, buckets = _sketch_rows(rows.column(5)), _bucket_table(rows.column(6))
            met = np.zeros(rows.num_rows, bool)
            for x, y in _pairs(group, side):
                good = _alike(x, y, size, sketch, similarity)
                good = good[_first_common(x[good], y[good], buckets) == bucket[x[good]]]
                met[x[good]] = met[y[good]] = True
            yield rows.select(["group", "bucket", "side", "node"]).filter(pa.array(met))

    return read


def _verified(similarity: float):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in segments(batches, "group"):
            group, bucket, side, node, size, copies = (rows.column(i).to_numpy() for i in range(6))
            sketch = _sketch_rows(rows.column(6))
            buckets = _bucket_table(rows.column(7))
            shingles, first = _numbers(rows.column(8))
            links = np.zeros(rows.num_rows, np.int64)
            root = np.arange(rows.num_rows)

            def top(i: int) -> int:
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for x, y in _pairs(group, side):
                good = _alike(x, y, size, sketch, similarity)
                good = good[_first_common(x[good], y[good], buckets) == bucket[x[good]]]
                for i, j in zip(x[good].tolist(), y[good].tolist(), strict=True):
                    shared = len(
                        np.intersect1d(
                            shingles[first[i] : first[i + 1]], shingles[first[j] : first[j + 1]], assume_unique=True
                        )
                    )
                    if shared >= similarity * (size[i] + size[j] - shared) - 1e-9:
                        links[i] += copies[j]
                        links[j] += copies[i]
                        a, b = top(i), top(j)
                        root[max(a, b)] = min(a, b)
            linked = np.flatnonzero(links)
            tops = node[[top(i) for i in linked.tolist()]] if len(linked) else node[:0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[linked]), pa.array(links[linked]), pa.array(tops)], ["node", "links", "root"]
            )

    return read


def _sized(rows: DataFrame) -> DataFrame:
    """Distinct (path, node) with the number of nodes of the path, for paths of two nodes or more."""
    distinct = rows.distinct()
    sizes = distinct.groupBy("path").agg(F.count("*").alias("nodes")).where("nodes > 1")
    return distinct.join(sizes, "path")


def _grouped(rows: DataFrame, limit: int) -> DataFrame:
    """(group, bucket, side, node): whole buckets, and for large ones every two blocks of about half the limit."""
    half = max(limit // 2, 1)
    count = F.when(F.col("nodes") <= limit, 1).otherwise(F.ceil(F.col("nodes") / half)).cast("int")
    block = F.pmod(F.xxhash64("node", "path"), F.col("_count")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_count") - 1))
    low, high = F.least("_block", "_other"), F.greatest("_block", "_other")
    return (
        rows.withColumn("_count", count)
        .withColumn("_block", block)
        .withColumn("_other", other)
        .select(
            F.when(F.col("_count") == 1, F.col("path")).otherwise(F.xxhash64("path", low, high)).alias("group"),
            F.col("path").alias("bucket"),
            F.when(low == high, 0).when(F.col("_block") == low, 1).otherwise(2).alias("side"),
            "node",
        )
    )


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("group").sortWithinPartitions("group")


def near_copies(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    limit: int = LIMIT,
    levels: int = LEVELS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(row, key, class_id, n_links, copy_of, n_copies) of every row; ``row`` is a hash of key and text."""
    texts = docs.select(
        F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("row"), F.col(key).alias("key"), F.col(text).alias("text")
    )
    kind = texts.schema["key"].dataType.simpleString()
    runs = runs_for(recall, levels)
    members = stage(
        texts.mapInArrow(
            _members(similarity, runs),
            f"row long, key {kind}, node long, size long, sketch binary, paths array<long>",
        ),
        "near_members",
    )
    nodes = stage(
        members.where("node is not null")
        .groupBy("node")
        .agg(
            F.count("*").alias("copies"),
            F.min("row").alias("row"),
            F.min("key").alias("copy_of"),
            F.first("size").alias("size"),
            F.first("sketch").alias("sketch"),
        ),
        "near_nodes",
    )
    paths = members.where("node is not null").select(F.explode("paths").alias("path"), "node")
    level = stage(_sized(paths), "near_level")
    ends = [level.where(F.col("nodes") <= limit)]
    large = level.where(F.col("nodes") > limit)
    looks = "group long, bucket long, side int, node long"

    def compared(rows: DataFrame) -> DataFrame:
        held = _grouped(rows, limit).join(nodes.select("node", "size", "sketch"), "node")
        held = _dealt(held.select("group", "bucket", "side", "node", "size", "sketch"))
        return held.mapInArrow(_candidates(similarity), looks)

    found = [stage(compared(ends[0]), "near_found")]
    # Texts are read once more, for the nodes that have a candidate or are in a bucket that must be split.
    wanted = stage(
        found[0].select("node").union(large.select("node")).distinct().join(nodes.select("node", "row"), "node"),
        "near_wanted",
    )
    small = wanted.count() <= broadcast_rows
    chosen = wanted.select("row", "node")
    sets = stage(
        texts.select("row", "text")
        .join(F.broadcast(chosen) if small else chosen, "row")
        .select("node", "text")
        .mapInArrow(_set_reader, "node long, shingles binary"),
        "near_sets",
    ).dropDuplicates(["node"])
    for _ in range(1, levels):
        if large.isEmpty():
            break
        split = large.select("path", "node").join(sets, "node").select("path", "node", "shingles")
        level = stage(_sized(split.mapInArrow(_split(similarity), "path long, node long")), "near_level")
        found.append(stage(compared(level.where(F.col("nodes") <= limit)), "near_found"))
        large = level.where(F.col("nodes") > limit)
    if not large.isEmpty():
        found.append(stage(compared(large), "near_found"))
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    every = every.distinct()
    known = every.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))
    known = stage(nodes.select("node", "size", "copies", "sketch").join(known, "node"), "near_known")
    # Sets go only where one of their pairs counts.
    light = every.join(known, "node").select("group", "bucket", "side", "node", "size", "sketch", "buckets")
    every = stage(_dealt(light).mapInArrow(_counting(similarity), looks), "near_counting")
    rows = every.join(known.join(sets, "node"), "node").select(
        "group", "bucket", "side", "node", "size", "copies", "sketch", "buckets", "shingles"
    )
    links = stage(_dealt(rows).mapInArrow(_verified(similarity), "node long, links long, root long"), "near_links")
    label = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("node", "copies", "copy_of").join(label, "node", "left").join(counted, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    classes = named.groupBy("label").agg(F.min("copy_of").alias("class_id"))
    named = named.join(classes, "label").select("node", "copies", "copy_of", "links", "class_id")
    return members.select("row", "key", "node").join(named, "node", "left").select(
        "row",
        F.col("key").alias(key),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("copy_of")).alias("copy_of"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def one_of_each(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", broadcast_rows: int = BROADCAST_ROWS, **options
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row with the smallest key, once."""
    found = stage(near_copies(docs, key=key, text=text, broadcast_rows=broadcast_rows, **options), "near_rows")
    linked = found.where("n_links > 0")
    # Rows are chosen by their hash; those that are there more than once are told apart at the end. A class may lack
    # an id if all its keys are null, so classes are grouped null-safe.
    best = linked.groupBy("class_id").agg(F.min(F.struct(F.col(key).alias("k"), "row")).alias("b")).select("b.row")
    often = linked.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row")
    gone = linked.select("row").distinct().join(best, "row", "left_anti").union(often).distinct()
    once = often.join(best, "row", "left_semi")
    gone, once = stage(gone, "near_gone"), stage(once, "near_once")

    def side(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if rows.count() <= broadcast_rows else rows

    rows = docs.select(F.struct(*docs.columns).alias("_doc"), F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("row"))
    single = rows.join(side(gone), "row", "left_anti")
    repeated = rows.join(side(once), "row", "left_semi").dropDuplicates(["row"])
    return single.union(repeated).select("_doc.*")

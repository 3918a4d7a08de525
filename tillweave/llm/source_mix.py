"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words. Sources share the words of the mix by weight; a source gives ``most_copies``
times its size at most, and what it can't give is shared anew by weight among the others, until none is above. Within a
source every document has the same expected number of copies, target over size. Documents are laid in a row by size
(equal sizes by a hash of the key), their expected copies are summed along the row from one random offset below 1 on,
which comes from a hash of seed and source, and a document is emitted once for each whole number that its part of the
sum crosses. As neighbours are of nearly equal size, the words taken miss the target by the size of the source's
largest document at most, and a document has the expected number of copies rounded down or up.

The row is laid by ranges of (source, size, hash, key), written once; ranges are numbered on their own and begin where
those before end. So a source of any size is spread over all tasks, and nothing but one row for each range and source
is gathered for it. Targets are found by one sum over sources for each round of sharing; the driver holds two numbers.

Null texts and texts without words have size 0, and copies like others; sources without words have target 0 and no
copies. A null source is one like others, the last. Repeated rows count and are drawn each; rows equal in source,
size and key may swap their places. An empty table gives an empty result. Only the columns named are read, so others
may clash. Very long texts are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.llm.textwords import SPACES, flat, pieces
from tillweave.operators.materialize import stage

WEIGHTS = (5.0, 2.0, 1.0)
_OFFSETS = 1 << 16  # the offset is a multiple of 1 / 65536, so that sums along a row are exact for long


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        data, offsets = flat(piece.column(piece.num_columns - 1))
        inside = ~SPACES[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        places = offsets[:-1][offsets[:-1] < len(data)]
        begins[places] = inside[places]
        first = np.searchsorted(np.flatnonzero(begins), offsets)
        columns = [*piece.columns[:-1], pa.array(np.diff(first).astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, [*piece.schema.names[:-1], "size"])


def _number(text: Column, digits: int) -> Column:
    """A number from the first hex digits of a text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def in_a_row(rows: DataFrame, source: Column, order: list[str], ranges: int, label: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in written ranges of (source, order), with ``part`` and ``place``; and a table (part, group, first,
    before) with the first place of each source in a range and how many of its rows the ranges before hold."""
    keys = [F.col("group").asc_nulls_last(), *(F.col(name).asc_nulls_last() for name in order)]
    laid = rows.withColumn("group", source).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    # A place holds the number of the range and, in its lower 33 bits, the number of the row there.
    laid = stage(laid.withColumn("place", F.monotonically_increasing_id()), label)
    laid = laid.withColumn("part", F.shiftright("place", 33))
    parts = laid.groupBy("part", "group").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return laid, parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")


def targets(sized: DataFrame, weights: tuple[float, ...], most_copies: int, ranges: int) -> DataFrame:
    """(source, source_size, target) of every source of the table (source, size); the weights repeat along them."""
    sums = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix_sources")
    laid, parts = in_a_row(sums, F.lit(0), ["source"], ranges, "mix_order")
    numbered = laid.join(F.broadcast(parts.drop("group")), "part")  # `parts` has one row for each range
    number = (F.col("before") + F.col("place") - F.col("first")) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (number + 1).cast("int"))
    weighed = stage(numbered.select("source", "source_size", weight.alias("weight")), "mix_weights")
    most = F.col("source_size") * F.lit(most_copies)
    unit, open_ = 0.0, F.lit(True)
    while True:  # a round closes a source at least, mostly many
        total, given, share = weighed.agg(
            F.sum("source_size"), F.sum(F.when(~open_, most)), F.sum(F.when(open_, F.col("weight")))
        ).first()
        more = ((total or 0) - (given or 0)) / share if share else 0.0
        if more <= unit:
            break
        unit = more
        open_ = F.lit(unit) * F.col("weight") <= most
    target = F.when(open_, F.lit(unit) * F.col("weight")).otherwise(most).cast("double")
    return weighed.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most_copies: int = 3,
    seed: int = 1,
    rows_per_range: int = 1_000_000,
) -> DataFrame:
    """(key, source, size, source_size, target, copies, taken) of every row; ``taken`` is size times copies."""
    rows = docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    sized = rows.mapInArrow(_sizes, f"key {kind}, source string, size long")
    draw = _number(F.coalesce(F.col("key").cast("string"), F.lit("")), 15)
    # `row` tells equal rows apart, so that many of them still fill several ranges.
    sized = stage(sized.withColumn("draw", draw).withColumn("row", F.monotonically_increasing_id()), "mix_sizes")
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(usual, ceil(sized.count() / rows_per_range))
    aims = targets(sized, weights, most_copies, usual)
    laid, parts = in_a_row(sized, F.col("source"), ["size", "draw", "key", "row"], ranges, "mix_rows")
    offset = _number(F.concat(F.lit(str(seed)), F.coalesce(F.concat(F.lit(":"), "source"), F.lit(""))), 4) / F.lit(_OFFSETS)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    begins = parts.join(aims, F.col("group").eqNullSafe(F.col("source"))).select(
        F.col("part").alias("_part"),
        F.col("group").alias("_group"),
        (F.col("before") - F.col("first")).alias("shift"),
        "source_size",
        "target",
        offset.alias("offset"),
        rate.alias("rate"),
    )
    same = (F.col("part") == F.col("_part")) & F.col("group").eqNullSafe(F.col("_group"))
    number = F.col("place") + F.col("shift")  # of the document in its source's row, from 0
    crossed = F.floor((number + 1) * F.col("rate") + F.col("offset")) - F.floor(number * F.col("rate") + F.col("offset"))
    drawn = laid.join(begins, same).withColumn("copies", crossed)
    return drawn.select(
        F.col("key").alias(key), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def emit(docs: DataFrame, *, text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: (doc, copy), a struct of all columns of a row for each of its copies, numbered from 1."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(source).alias("source"), F.col(text).alias("text"))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "mix_docs")
    drawn = mix(rows, key="row", **options).where("copies > 0").select(F.col("row").alias("_row"), "copies")
    held = rows.join(drawn, F.col("row") == F.col("_row"))
    return held.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))

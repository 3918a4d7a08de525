"""Many-to-one left joins (JN-1..7, JN-9, JN-10).

A join never multiplies rows: a lookup that may repeat its key is reduced to its smallest row per key first. The lookup is
broadcast only after its rows and bytes were counted against a bound. Beyond the bound both sides are shuffled; rows are
not sorted where a task's share of the lookup keeps within the bound, but looked up in a table of that share. A
key that holds more rows than a task should have is salted: its rows are dealt over as many numbers as it fills
shares of a task, and its one lookup row is repeated for each of them. How often a key occurs comes from counts that the
caller has, or from one count by key with a partial step before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, IntegerType, StringType, StructField, StructType

from tillweave.functions.text import quoted
from tillweave.operators.materialize import tidy
from tillweave.operators.observed import observed


@dataclass(frozen=True)
class JoinBounds:
    broadcast_rows: int = 200_000
    broadcast_bytes: int = 32 * 1024 * 1024
    shares: int = 16  # of a task's rows; no number of a salted key has more than one share
    salt_bytes: int = 64 * 1024 * 1024  # rows that Spark's estimate puts below that are joined as they are


BOUNDS = JoinBounds()


def _bytes(name: str, kind: DataType) -> Column:
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(quoted(name)), F.lit(0)) + 16
    if kind.typeName() in ("array", "map", "struct", "variant"):
        return F.coalesce(F.octet_length(F.to_json(F.struct(quoted(name)))), F.lit(0)) + 16
    return F.lit(16)


def measured(lookup: DataFrame) -> tuple[int, int]:
    """Rows and bytes of the lookup, counted by all tasks."""
    each = reduce(lambda a, b: a + b, (_bytes(item.name, item.dataType) for item in lookup.schema.fields))
    return tuple(lookup.agg(F.count("*"), F.coalesce(F.sum(each), F.lit(0))).first())


def fits_broadcast(lookup: DataFrame, bounds: JoinBounds = BOUNDS) -> bool:
    rows, size = measured(lookup)
    return rows <= bounds.broadcast_rows and size <= bounds.broadcast_bytes


def shuffle_hint(size: int, tasks: int, bounds: JoinBounds = BOUNDS) -> str:
    """How to join by shuffle with a unique lookup of ``size`` bytes, which hashing deals evenly over the tasks."""
    return "shuffle_hash" if size <= bounds.broadcast_bytes * tasks else "shuffle_merge"


def estimated_bytes(df: DataFrame) -> int:
    """Spark's estimate from file sizes, for choices that change no result."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def one_per_key(lookup: DataFrame, keys: list[str]) -> DataFrame:
    """The smallest row of each key, nulls first."""
    others = [name for name in lookup.columns if name not in keys]
    if not others:
        return lookup.dropDuplicates(keys)
    kept = F.min(F.struct(*others)).alias("_kept")
    return lookup.groupBy(*keys).agg(kept).select(*keys, *(F.col(f"_kept.{name}") for name in others))


def hot_keys(counts: DataFrame, keys: list[str], tasks: int, shares: int) -> DataFrame | None:
    """(keys, salts) of the keys with more rows than a share of a task, or None if there are none.

    ``counts`` (keys, n_rows) may repeat a key. A share is ``1 / (tasks * shares)`` of all rows, so there are fewer hot
    keys than ``tasks * shares``, and fewer than twice as many salts. A null key matches nothing, but is salted like others.
    """
    sums = counts.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"))
    seen = Observation()
    with tidy(counts.sparkSession):
        most = sums.observe(seen, F.sum("n_rows").alias("total")).orderBy(F.desc("n_rows")).limit(tasks * shares).collect()
        totals = observed(seen) or sums.agg(F.sum("n_rows").alias("total")).first()
    share = max((totals["total"] or 0) // (tasks * shares), 1)
    hot = [(*row[:-1], -(-row["n_rows"] // share)) for row in most if row["n_rows"] > share]
    kinds = [sums.schema[name] for name in keys]
    return counts.sparkSession.createDataFrame(hot, StructType([*kinds, StructField("_salts", IntegerType())])) if hot else None


def salted_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], hot: DataFrame, hint: str = "shuffle_merge"
) -> DataFrame:
    """Left join by shuffle of a unique lookup, keys of ``hot`` dealt over their salts."""
    marks = F.broadcast(hot.select(*(F.col(name).alias(f"_hot{i}") for i, name in enumerate(keys)), "_salts"))

    def marked(df: DataFrame) -> DataFrame:
        same = reduce(and_, (df[name].eqNullSafe(marks[f"_hot{i}"]) for i, name in enumerate(keys)))
        return df.join(marks, same, "left").drop(*(f"_hot{i}" for i in range(len(keys))))

    number = F.monotonically_increasing_id()  # consecutive in a task: its rows of a key go to its salts in turn
    left = marked(rows).withColumn("_salt", F.when(F.col("_salts").isNotNull(), F.pmod(number, "_salts").cast("int")).otherwise(0))
    right = marked(lookup)
    each = F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0)))
    right = right.withColumn("_salt", F.explode(each)).drop("_salts")
    return left.drop("_salts").join(right.hint(hint), [*keys, "_salt"], "left").drop("_salt")


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    *,
    unique: bool = False,
    bounds: JoinBounds = BOUNDS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Left join of ``rows`` with ``lookup``; unmatched rows get nulls.

    ``unique`` says that the lookup has each key once, as a grouped or numbered table does. ``counts`` (keys, n_rows)
    tells how rows spread over keys, exactly or in proportion; it spares the count of the rows themselves where the
    lookup is too large to broadcast.
    """
    keys = [on] if isinstance(on, str) else list(on)
    lookup = lookup if unique else one_per_key(lookup, keys)
    n_rows, size = measured(lookup)
    if n_rows <= bounds.broadcast_rows and size <= bounds.broadcast_bytes:
        return rows.join(F.broadcast(lookup), keys, "left")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hint = shuffle_hint(size, tasks, bounds)
    plain = rows.join(lookup.hint(hint), keys, "left")
    if estimated_bytes(rows) < bounds.salt_bytes:
        return plain
    if counts is None:
        counts = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    hot = hot_keys(counts, keys, tasks, bounds.shares)
    return plain if hot is None else salted_join(rows, lookup, keys, hot, hint)

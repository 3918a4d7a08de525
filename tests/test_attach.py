"""Left joins that keep every row once, and spread keys that hold many."""

from __future__ import annotations

from statistics import median

import pytest
from pyspark.sql import functions as F

from tillweave.operators.attach import JoinBounds, attach, fits_broadcast, hot_keys, measured

SALTED = JoinBounds(broadcast_rows=0, salt_bytes=0)


@pytest.fixture(scope="module")
def lines(spark):
    """A third of the rows has key 7, a sixth no key, the others one of 500."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 6 = 1 THEN NULL ELSE id % 500 END")
    return spark.range(60_000).repartition(5).select(F.col("id").alias("line"), key.alias("key"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(450).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))


def test_salted_join_keeps_rows_and_values(lines, lookup):
    want = {(r["line"], r["key"]): f"n{r['key']}" if r["key"] is not None and r["key"] < 450 else None for r in lines.collect()}
    for bounds in (SALTED, JoinBounds(), JoinBounds(broadcast_rows=0)):
        found = attach(lines, lookup, "key", unique=True, bounds=bounds)
        assert found.columns == ["key", "line", "name"]
        rows = found.collect()
        assert len(rows) == 60_000 and {(r["line"], r["key"]): r["name"] for r in rows} == want


def test_hot_key_fills_no_task_twice_the_median(spark, lines, lookup):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = attach(lines, lookup, "key", unique=True, bounds=SALTED)
        each = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        plain = attach(lines, lookup, "key", unique=True, bounds=JoinBounds(broadcast_rows=0))
        alone = [r["count"] for r in plain.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(each) == 60_000 and max(each) <= 2 * median(each)
    assert max(alone) > 2 * median(alone)


def test_counts_from_elsewhere_say_what_is_hot(spark, lines, lookup):
    counts = lines.groupBy("key").agg(F.count("*").alias("n_rows"))
    hot = {r["key"]: r["_salts"] for r in hot_keys(counts.union(counts), ["key"], 4, 4).collect()}
    assert set(hot) == {7, None} and hot[7] == 6  # 20,000 of 60,000 rows and some, in sixteenths
    assert hot_keys(lookup.withColumn("n_rows", F.lit(1)), ["key"], 4, 4) is None
    assert hot_keys(counts.where("false"), ["key"], 4, 4) is None
    found = attach(lines, lookup, ["key"], unique=True, bounds=SALTED, counts=counts)
    assert found.where("key = 7 AND name = 'n7'").count() == lines.where("key = 7").count()


def test_repeated_lookup_keys_do_not_multiply(spark, lines, lookup):
    twice = lookup.union(lookup.withColumn("name", F.concat(F.lit("z"), "name")))
    found = attach(lines, twice, "key", bounds=SALTED)
    assert found.count() == 60_000 and not found.where("name LIKE 'z%'").count()


def test_bytes_and_rows_bound_a_broadcast(spark):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array(F.lit("abc")).alias("list"))
    assert fits_broadcast(wide)
    assert not fits_broadcast(wide, JoinBounds(broadcast_bytes=9_000))
    assert not fits_broadcast(wide, JoinBounds(broadcast_rows=9))
    assert fits_broadcast(wide.limit(0), JoinBounds(broadcast_rows=0))


def test_rows_are_sorted_only_where_a_share_of_the_lookup_is_too_large(spark, lines, lookup):
    """F6 to F17: all report rows were sorted by work key to be joined with a lookup of a few bytes a task."""
    _, size = measured(lookup)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for salt_bytes in (0, 10**12):
        fits = JoinBounds(broadcast_rows=0, broadcast_bytes=-(-size // tasks), salt_bytes=salt_bytes)
        larger = JoinBounds(broadcast_rows=0, broadcast_bytes=size // tasks - 1, salt_bytes=salt_bytes)
        hashed, merged = (attach(lines, lookup, "key", unique=True, bounds=bounds) for bounds in (fits, larger))
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (hashed, merged)]
        assert "ShuffledHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
        assert "SortMergeJoin" in plans[1] and "ShuffledHashJoin" not in plans[1]
        assert sorted(map(repr, hashed.collect())) == sorted(map(repr, merged.collect()))

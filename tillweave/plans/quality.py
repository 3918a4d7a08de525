"""Data-quality constraints (DQ-1..10), run as Spark jobs.

A check returns issue rows ``(check_name, severity, table_name, key, detail, n)``, none if the constraint holds.
``raise_on_errors`` turns issue rows of severity ``error`` into an exception.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillweave.errors import QualityError
from tillweave.functions.numbers import exact_sum
from tillweave.functions.text import quoted
from tillweave.operators.materialize import stage
from tillweave.operators.observed import observed
from tillweave.plans.dimensions import invalid_directions, missing_parents
from tillweave.plans.facts import movement_cost_issues

ISSUES_SCHEMA = (
    "check_name STRING, severity STRING, table_name STRING, key STRING, detail STRING, n BIGINT"
)
SAMPLE = 20


def no_issues(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ISSUES_SCHEMA)


def _issues(df: DataFrame, check: str, severity: str, table: str, key: Column, detail: Column, n: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"),
        F.lit(severity).alias("severity"),
        F.lit(table).alias("table_name"),
        key.cast("string").alias("key"),
        detail.cast("string").alias("detail"),
        n.cast("long").alias("n"),
    )


def _sampled(found: DataFrame, keys: list[str], check: str, severity: str, table: str) -> DataFrame:
    """LIM-1: one issue with the number of offending keys and up to 20 of them.

    The offending keys are written once and then both counted and listed.
    """
    key = F.to_json(F.struct(*(quoted(name) for name in keys)), {"ignoreNullFields": "false"})
    found = stage(found.select(key.alias("key")), "offending")
    sample = found.orderBy("key").limit(SAMPLE)
    total = found.agg(F.count("*").alias("n")).where("n > 0").withColumn("one", F.lit(1))
    listed = sample.agg(F.array_join(F.array_sort(F.collect_list("key")), ", ").alias("keys")).withColumn(
        "one", F.lit(1)
    )
    return _issues(
        total.join(listed, "one"),
        check,
        severity,
        table,
        F.lit(", ".join(keys)),
        F.col("keys"),
        F.col("n"),
    )


def _counted(df: DataFrame, conditions: dict[str, Column], check: str, severity: str, table: str) -> DataFrame:
    """One pass over ``df`` that counts the rows of each condition."""
    counts = df.agg(*(F.count_if(condition).alias(name) for name, condition in conditions.items()))
    long = counts.unpivot([], [quoted(name) for name in conditions], "key", "n").where("n > 0")
    return _issues(long, check, severity, table, F.col("key"), F.lit(None), F.col("n"))


def null_counts(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """DQ-1."""
    return _counted(df, {name: quoted(name).isNull() for name in columns}, "nulls", "error", table)


def negative_counts(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """DQ-7."""
    return _counted(df, {name: quoted(name) < 0 for name in columns}, "negative", "warning", table)


def table_issues(
    df: DataFrame, table: str, nulls: list[str], negatives: list[str], empty: str = "error"
) -> DataFrame:
    """DQ-1, DQ-7 and DQ-8 of a table in one pass over it."""
    tests = {("nulls", "error", name): F.count_if(quoted(name).isNull()) for name in nulls}
    tests |= {("negative", "warning", name): F.count_if(quoted(name) < 0) for name in negatives}
    tests["empty", empty, None] = F.when(F.count("*") == 0, 1).otherwise(0)
    counts = df.agg(
        F.array(
            *(
                F.struct(
                    F.lit(check).alias("check_name"),
                    F.lit(severity).alias("severity"),
                    F.lit(table).alias("table_name"),
                    F.lit(name).cast("string").alias("key"),
                    F.lit(None).cast("string").alias("detail"),
                    n.cast("long").alias("n"),
                )
                for (check, severity, name), n in tests.items()
            )
        ).alias("found")
    )
    return counts.select(F.inline("found")).where("n > 0")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*(quoted(name) for name in keys)).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def duplicate_issues(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """DQ-2."""
    return _sampled(duplicate_keys(df, keys), keys, "duplicates", "error", table)


def unmatched_keys(rows: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Keys of ``rows`` that the lookup lacks. Keys are made distinct before the join."""
    return rows.select(on).distinct().join(lookup.select(on), on, "left_anti")


def unmatched_issues(rows: DataFrame, lookup: DataFrame, on: str, table: str) -> DataFrame:
    """DQ-4."""
    return _sampled(unmatched_keys(rows, lookup, on), [on], "unmatched", "error", table)


def invalid_values(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    """Distinct texts that could not be parsed."""
    return df.where(quoted(parsed).isNull() & quoted(raw).isNotNull()).select(quoted(raw)).distinct()


def invalid_issues(df: DataFrame, raw: str, parsed: str, table: str) -> DataFrame:
    """DQ-5."""
    return _sampled(invalid_values(df, raw, parsed), [raw], "invalid", "error", table)


def conservation(before: DataFrame, after: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Exact totals of each measure before and after an aggregation: ``measure, before, after``."""

    def totals(df: DataFrame, names: list[str], side: str) -> DataFrame:
        sums = df.agg(
            *(F.coalesce(exact_sum(quoted(name)), F.lit(0)).alias(label) for label, name in zip(measures, names, strict=True))
        )
        return sums.unpivot([], [quoted(label) for label in measures], "measure", side)

    return totals(before, list(measures), "before").join(
        totals(after, list(measures.values()), "after"), "measure"
    )


def conservation_issues(
    before: DataFrame, after: DataFrame, measures: dict[str, str], table: str
) -> DataFrame:
    """DQ-6: totals must agree on six digits."""
    totals = conservation(before, after, measures)
    changed = totals.where(F.round("before", 6) != F.round("after", 6))
    detail = F.concat_ws(" -> ", F.col("before").cast("string"), F.col("after").cast("string"))
    return _issues(changed, "conservation", "error", table, F.col("measure"), detail, F.lit(1))


class Watch:
    """DQ-1, DQ-6, DQ-7 and DQ-8 of a fact, observed while the plan that writes it runs.

    ``before`` goes around the rows that are summed and ``after`` around the fact; both return what they are given.
    Once the fact is written, ``totals`` has what passed by. Totals that differ are taken again from the rows: a stage that
    ran twice, because an executor was lost, is observed twice. So nothing is read again unless the fact seems wrong.
    """

    def __init__(self, table: str, measures: dict[str, str], nulls: Sequence[str] = (), negatives: Sequence[str] = ()):
        self.table, self.measures = table, measures
        self.nulls, self.negatives = list(nulls), list(negatives)
        self._before, self._after = Observation(), Observation()
        self._rows: DataFrame | None = None

    def before(self, rows: DataFrame) -> DataFrame:
        self._rows = rows
        return rows.observe(self._before, *self._sums(list(self.measures)))

    def after(self, fact: DataFrame) -> DataFrame:
        return fact.observe(self._after, *self._sums(list(self.measures.values())), *self._counts())

    def _sums(self, names: list[str]) -> list[Column]:
        return [F.coalesce(exact_sum(quoted(name)), F.lit(0)).alias(f"total_{i}") for i, name in enumerate(names)]

    def _counts(self) -> list[Column]:
        return [
            F.count(F.lit(1)).alias("n_rows"),
            *(F.count_if(quoted(name).isNull()).alias(f"nulls_{i}") for i, name in enumerate(self.nulls)),
            *(F.count_if(quoted(name) < 0).alias(f"negatives_{i}") for i, name in enumerate(self.negatives)),
        ]

    def totals(self, written: DataFrame) -> tuple[dict[str, Any], dict[str, Any]]:
        """Totals of the summed rows, and totals and counts of the fact as ``written``."""
        before = observed(self._before) if self.measures else {}
        after = observed(self._after)
        if after is None:
            after = written.agg(*self._sums(list(self.measures.values())), *self._counts()).first().asDict()
        if before is None or any(round(before[f"total_{i}"], 6) != round(after[f"total_{i}"], 6) for i in range(len(self.measures))):
            before = self._rows.agg(*self._sums(list(self.measures))).first().asDict()
        return before, after

    def issues(self, written: DataFrame) -> DataFrame:
        before, after = self.totals(written)
        found: list[tuple] = []
        for i, name in enumerate(self.measures):
            one, other = before[f"total_{i}"], after[f"total_{i}"]
            if round(one, 6) != round(other, 6):
                found.append(("conservation", "error", self.table, name, f"{one} -> {other}", 1))
        found += [("nulls", "error", self.table, name, None, after[f"nulls_{i}"]) for i, name in enumerate(self.nulls)]
        found += [("negative", "warning", self.table, name, None, after[f"negatives_{i}"]) for i, name in enumerate(self.negatives)]
        if not after["n_rows"]:
            found.append(("empty", "warning", self.table, None, None, 1))
        return written.sparkSession.createDataFrame([row for row in found if row[-1]], ISSUES_SCHEMA)


def missing_columns(df: DataFrame, required: Sequence[str], table: str) -> DataFrame:
    """DQ-3 as issue rows, where the run is not to end at once as with ``staging.require_columns``."""
    absent = [name for name in required if name not in df.columns]
    return df.sparkSession.createDataFrame([("missing_column", "error", table, name, None, 1) for name in absent], ISSUES_SCHEMA)


def empty_issue(df: DataFrame, table: str, severity: str = "error") -> DataFrame:
    """DQ-8."""
    none = df.limit(1).agg(F.count("*").alias("n")).where("n = 0")
    return _issues(none, "empty", severity, table, F.lit(None), F.lit(None), F.lit(1))


def group_conflict_issues(conflicts: DataFrame) -> DataFrame:
    """DQ-9."""
    return _sampled(conflicts, ["name", "groups"], "name_in_several_groups", "warning", "product_identity")


def product_type_issues(groups: DataFrame) -> DataFrame:
    """DQ-9: products with several groups, from ``products.most_frequent_group``."""
    several = groups.where("n_groups > 1")
    return _sampled(several, ["product_business_key"], "several_product_types", "warning", "dim_product")


def cost_conflict_issues(conflicts: DataFrame) -> DataFrame:
    """DQ-10."""
    return _sampled(conflicts, ["date", "product_id"], "several_unit_costs", "warning", "fact_productcost")


def missing_cost_issues(valued: DataFrame) -> DataFrame:
    """DQ-10, with the first keys of each kind."""
    found = movement_cost_issues(valued, SAMPLE)
    return _issues(
        found, "missing_cost", "warning", "fact_inventory_movement", F.col("issue"), F.col("detail"), F.col("n_rows")
    )


def control_mismatch_issues(rows: DataFrame) -> DataFrame:
    """NUM-6, DQ-10: rows whose control total differs, technical exclusions aside."""
    differs = ~F.col("sales_validation_excluded") & ~F.col("sales_total_matches_control")
    return _counted(rows, {"sales_total_matches_control": differs}, "control_mismatch", "warning", "staging")


def short_names(staging: DataFrame) -> DataFrame:
    """AGG-15: work keys with a suspiciously short name."""
    return (
        staging.where("is_short_product_name_warning")
        .select("product_work_key", "product_name_selected")
        .distinct()
    )


def short_name_issues(short: DataFrame) -> DataFrame:
    """DQ-10."""
    return _sampled(short, ["product_work_key", "product_name_selected"], "short_name", "warning", "staging")


def movement_type_issues(dim: DataFrame) -> DataFrame:
    """DQ-1, DQ-2, SET-2, SET-3 on the movement types."""
    table = "dim_movement_type"
    required = ["movement_type_column", "movement_type_name", "movement_direction"]
    return unite(
        null_counts(dim, required, table),
        duplicate_issues(dim, ["movement_type_column"], table),
        _sampled(missing_parents(dim), ["missing_parent"], "missing_parent", "error", table),
        _sampled(invalid_directions(dim), ["movement_direction"], "direction", "error", table),
    )


def unite(*issues: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, issues)


def raise_on_errors(issues: DataFrame) -> None:
    """Raise if there are error issues: the exception names the tables, their checks and totals.

    The issues themselves are in ``dq_issues``. There are as many groups as checks in the program.
    """
    errors = issues.where("severity = 'error'")
    found = errors.groupBy("table_name", "check_name").agg(F.count("*").alias("issues"), F.sum("n").alias("n"))
    lines = [
        f"{row.table_name}: {row.check_name}, {row.issues} issues, n={row.n}"
        for row in found.orderBy("table_name", "check_name").collect()
    ]
    if lines:
        raise QualityError("; ".join(lines))

"""Registered queries against their SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from tillweave.queries.oracle import ORACLE
from tillweave.queries.spark_side import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents labels".split()
CHECKED = [
    "file_and_sheet_metadata", "union_by_name", "raw_layer", "attach_skewed", "dim_date", "dim_product", "reference_tables",
    "staging_hot_key", "daily_lookup_by_month", "published_tables", "listed_files", "raw_checks", "watched_facts", "snapshots",
    "movement_cost_issues", "fact_sales_shared_column", "dq_unmatched", "dq_short_names", "dq_product_types", "dq_daily_lookup", "warehouse_tables",
]


def canonical(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    texts = frame.where(frame.notna(), None).astype(str).itertuples(index=False, name=None)
    return sorted(tuple(x.removesuffix(" 00:00:00").removesuffix(".0") for x in row) for row in texts)


@pytest.mark.parametrize("name", CHECKED)
def test_equals_sql(spark, sf, name):
    engine = duckdb.connect()
    for table in TABLES:
        engine.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    found = QUERIES[name](spark, sf).toPandas()
    want = engine.sql(ORACLE[name]).df()
    assert canonical(found) == canonical(want) and len(found)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)

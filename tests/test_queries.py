"""Registered queries against their SQL counterparts (scripts/check_queries.py runs all of them)."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from riskloom.plans.views import TABLES

SF = "/root/testdata/sf0.001"
QUICK = """client_features client_features_subset onehot_share row_features rowwise_stats sentinel_clean
    join_coverage_report dedup_exact table_profile missingness categorical_summary target_correlations cramers_v
    signed_association business_cost roc_points fairness_summary enrich_sensitive categorical_drift histogram
    status_codes fk_integrity latest_event_by_type validate_requests repair_clients kfold linear_shap_values
    stream_counts""".split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 150


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    cursor = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert ours == theirs

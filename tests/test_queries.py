"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, rows_of, same_type
from encore.catalog import ORACLES, QUERIES

# Queries without SQL train models or compare strings beyond SQL; the rest must all be covered.
ROWS_ONLY = {
    "pca_summary", "fit_linear", "fit_forest", "fit_gbt", "model_results", "importance_table",
    "importance_top", "prediction_table", "imbalance", "feature_set_ablation", "score_profiles",
    "link_fuzzy", "link_texts", "token_sort_ratio", "incremental_link", "text_features",
    "lda_topics", "model_report", "text_report",
}


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_registry():
    assert set(ORACLES) | ROWS_ONLY == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["genre", "n_tracks", "avg_repeats", "median_repeats", "avg_log_repeats"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, name):
    df = queries()[name](spark, SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = sql.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    types = dict(zip(want.columns, map(str, want.types)))
    assert all(same_type(t, types[c]) for c, t in df.dtypes), (df.dtypes, types)
    assert got == rows_of(want.columns, want.fetchall())

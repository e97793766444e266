"""Queries against DuckDB on the smallest tables."""

from __future__ import annotations

import os

import pandas as pd
import pytest

from kindred.plans import oracles, queries

SF = "/root/testdata/sf0.001"
SOME = ("preprocess", "ground_truth_list", "ground_truth_last", "last_records", "input_counts", "block_prefix3", "block_token", "block_passes", "pool_sizes", "block_tfidf_topk", "block_union_cap", "feat_all", "threshold_curve", "entity_metrics", "candidate_output", "validate_violations", "validate_summary", "score_pair", "resolve")


def rows(df):
    df = df[sorted(df.columns)]
    text = lambda v: "null" if pd.isna(v) else repr(round(float(v), 6)) if isinstance(v, float) else str(v)
    return sorted(tuple(map(text, r)) for r in df.itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", SOME)
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"create view part as select * from '{SF}/part.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), con.sql(oracles.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want) and len(got)


def test_every_oracle_has_a_query():
    assert set(oracles.oracle_sql()) <= set(queries.queries())

"""Driver contract: entry smoke, and every SQL-checkable query against DuckDB."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tagloom.plans.oracle import ORACLE
from tagloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
# Queries that fit many models: checked at this size by scripts/check_oracle.py.
SLOW = {"tvs_best_params", "threshold_sweep", "br_fit_predict", "br_metrics", "br_save_load", "table_scoring", "stream_score"}


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["Id", "label", "predictionLabel"]
    rows = df.collect()
    assert len(rows) > 100 and sum(bool(r["predictionLabel"]) for r in rows) > len(rows) / 2


def test_registry_shapes():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(ORACLE) == set(QUERIES) and set(QUERIES) <= set(q)


def _norm(v):
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    """Columns and rows, ordered by what is no float; whole floats are integers."""
    cols = sorted(pdf.columns)
    rows = [tuple(int(x) if isinstance(x, float) and x.is_integer() else x for x in map(_norm, r)) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda r: (repr([x for x in r if not isinstance(x, float)]), [x for x in r if isinstance(x, float)]))


def _same(a, b):
    """Floats may differ in the last digits, as sums have no order."""
    return len(a) == len(b) and all(
        math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12) if isinstance(x, float) and isinstance(y, (int, float)) else x == y for x, y in zip(a, b))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_query_matches_oracle(spark, duck, name):
    got = _rows(E.queries()[name](spark, SF).toPandas())
    want = _rows(duck.sql(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert [(g, w) for g, w in zip(got[1], want[1]) if not _same(g, w)] == []

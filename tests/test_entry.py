"""Driver contract: entry runs; every oracle key is a query; SQL-checked
queries match DuckDB on the smallest driver tables."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from roaskit.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
MODEL_QUERIES = {"conversion_model_auc", "param_search", "feature_importance", "lift_forecast", "logistic_baseline"}


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6f}"
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0 and "roas" in df.columns


def test_oracle_keys_subset():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


@pytest.mark.parametrize("name", sorted(set(entry_mod.queries()) - set(entry_mod.oracle_sql()) - MODEL_QUERIES))
def test_rows_only_queries_run(spark, name):
    assert entry_mod.queries()[name](spark, SF).count() > 0


def test_queries_without_a_library_of_the_training_data_operators(monkeypatch):
    """A missing tokenizer package takes those queries away and no other."""
    import sys

    import __spark_entry__ as entry
    from roaskit.plans.catalog import QUERIES
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("roaskit.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    assert set(entry.queries()) == set(QUERIES)

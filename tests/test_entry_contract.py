"""Driver contract: entry runs on sf0.001; every query has a builder; a sample
of queries equals its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMOKE
from vigil.plans import catalog
from vigil.plans.tables import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["mp_party", "mp_name", "act_weight"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", ["coauthor_weight", "json_map_flatten", "author_histogram",
                                  "run_islands", "breadcrumb_path", "manifest_merge", "ring_layout"])
def test_sample_queries_match_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMOKE)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)

    def norm(v):
        return round(v, 6) if isinstance(v, float) else v

    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    idx = [rel.columns.index(c) for c in cols]
    ref = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == ref

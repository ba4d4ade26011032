"""Every registered query against its DuckDB oracle on the smallest driver tables, and the
driver entry points."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_mod
from periodstats.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SLOW = {"cluster_styles", "cluster_summary", "rebuild_idempotent"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(rows):
    return sorted(tuple("<null>" if v is None else repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", [n for n, q in catalog.REGISTRY.items()
                                  if q.sql is not None and n not in SLOW])
def test_query_matches_oracle(spark, duck, name):
    df = catalog.run(name, spark, SF)
    res = duck.execute(catalog.oracle(name))
    assert [d[0] for d in res.description] == df.columns
    assert _norm(df.collect()) == _norm(res.fetchall())


def test_entry_and_contract(spark):
    df = entry_mod.entry(spark)
    assert df.columns[0] == "web_name" and df.count() >= 0
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_cluster_queries_invariants_on_driver_tables(spark):
    """No SQL form for K-Means: every cohort row kept, ids 0..k-1 all used per clustered
    position, labels name the position and one of its features."""
    sf = "/root/testdata/sf0.01"
    styles = catalog.run("cluster_styles", spark, sf).collect()
    cohort = catalog.run("cohort", spark, sf).collect()
    assert sorted(r.code for r in styles) == sorted(r.code for r in cohort)
    status = {r.position: r.status for r in catalog.run("cluster_status", spark, sf).collect()}
    for pos, st in status.items():
        rows = [r for r in styles if r.position == pos]
        if st == "clustered":
            assert {r.cluster for r in rows} == {0, 1, 2, 3}
            assert all(r.cluster_label.startswith(f"{pos}_") and
                       r.cluster_label.endswith("_profile") for r in rows)
        else:
            assert {(r.cluster, r.cluster_label) for r in rows} == {(-1, st)}
    summary = {r.position: r.clusters for r in catalog.run("cluster_summary", spark, sf).collect()}
    assert summary == {p: (4 if s == "clustered" else 0) for p, s in status.items()}

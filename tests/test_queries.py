"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from aeros.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def text(rows):
    return sorted(tuple("NULL" if v is None else repr(float(v)) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    have = [c[0] for c in result.description]
    assert sorted(have) == names
    order = [have.index(c) for c in names]
    assert text(df.select(*[f"`{c}`" for c in names]).collect()) == text([tuple(r[i] for i in order) for r in result.fetchall()])


def test_registry_imports_without_session():
    import __spark_entry__ as entry

    assert set(ORACLES) <= set(entry.queries()) and "features" in entry.queries()

"""Every registered query of the document engine against its SQL, on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from tableloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows(found, columns):
    return sorted((tuple(map(plain, r)) for r in found), key=lambda r: tuple((x is None, str(x)) for x in r)), columns


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = rows(df.select(*(f"`{c}`" for c in columns)).collect(), columns)
    result = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in result.description]
    want = rows(([r[names.index(c)] for c in columns] for r in result.fetchall()), sorted(names))
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_gives_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0

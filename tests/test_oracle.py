"""Every query with SQL gives the rows that DuckDB gives for it."""

from decimal import Decimal

import duckdb
import pytest

from tidefold.plans import catalog

from .conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return float(v) if isinstance(v, Decimal) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_matches_sql(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(catalog.ORACLE[name])
    found = [d[0] for d in result.description]
    assert sorted(found) == columns
    theirs = sorted((tuple(plain(dict(zip(found, r, strict=True))[c]) for c in columns) for r in result.fetchall()), key=repr)
    assert ours == theirs

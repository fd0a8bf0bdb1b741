"""Every registered query that has an oracle agrees with it on the smallest tables; every other one runs."""

import decimal
import os

import duckdb
import pytest

from docweave.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(sf_dir):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return float(f"{v:.10g}")
    return v


def table(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    if name not in ORACLES:
        return
    cursor = con.execute(ORACLES[name])
    theirs = [d[0] for d in cursor.description]
    assert sorted(theirs) == columns
    order = [theirs.index(c) for c in columns]
    assert table(got) == table([[r[i] for i in order] for r in cursor.fetchall()])

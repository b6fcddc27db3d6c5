"""Every registered query against its SQL twin on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from affinia.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = db.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    theirs = sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    assert columns == sorted(names)
    assert ours == theirs


# Streams, fits and draws that have no SQL form must at least run and give rows.
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert len(QUERIES[name](spark, SF).take(1)) == 1

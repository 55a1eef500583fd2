"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from chesstally.testing.queries import QUERIES
from tests.conftest import SF_SMALL

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return c


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["month", "eco_group", "white_bucket", "black_bucket", "games",
                          "white_wins", "black_wins", "draws"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got, cols = df.collect(), df.columns
    res = con.sql(E.oracle_sql()[name])
    exp, ecols = res.fetchall(), res.columns
    assert sorted(cols) == sorted(ecols)
    duck_types = dict(zip(ecols, [str(t) for t in res.types]))
    assert {c: TYPES.get(t) for c, t in df.dtypes} == duck_types
    assert len(got) == len(exp)
    assert _canon(got, cols) == _canon(exp, ecols)

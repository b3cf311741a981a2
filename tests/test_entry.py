"""The driver contract: entry(), queries() and their DuckDB oracles on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ["events"]
# the corpus queries have their own tests
OWN = set(E.queries()) - set(E._corpus.queries() if E._corpus else ())
STREAMING = {name for name in OWN if name.startswith("stream_")}


def test_entry(spark):
    assert E.entry(spark).count() == 93


def test_every_query_has_an_oracle():
    assert OWN <= set(E.oracle_sql())


def _norm(rows):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(OWN - STREAMING))
def test_matches_oracle(spark, smoke_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    want = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    want_rows = want.fetchall()
    got = E.queries()[name](spark, smoke_dir)
    assert sorted(got.columns) == sorted(cols)
    got_rows = [tuple(r[c] for c in cols) for r in got.collect()]
    assert _norm(got_rows) == _norm(want_rows)
    assert not any(isinstance(v, float) and math.isnan(v) for r in got_rows for v in r)

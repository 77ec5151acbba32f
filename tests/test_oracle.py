"""Every registered query equals its DuckDB oracle (sf0.001 here; the driver checks sf0.01)."""

import duckdb
import pytest

from conftest import SF_SMOKE
from skytally.plans.catalog import queries
from skytally.plans.oracle import oracle_sql
from skytally.sources.tables import TABLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return c


def _norm(records, cols):
    out = []
    for rec in records:
        row = []
        for c in cols:
            v = rec[c]
            if isinstance(v, float):
                v = round(v, 6)
            elif v is not None and hasattr(v, "isoformat"):
                v = v.isoformat()[:10]
            row.append(v)
        out.append(tuple(row))
    return sorted(out, key=repr)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF_SMOKE)
    rel = con.sql(oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    s_rows = [r.asDict() for r in sdf.collect()]
    d_rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert len(s_rows) == len(d_rows)
    assert _norm(s_rows, cols) == _norm(d_rows, cols)

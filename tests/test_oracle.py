"""Every registered query with an oracle, Spark against DuckDB at sf0.001."""
import math

import pytest

import duck

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def con():
    return duck.connect(SF)


def _names():
    import __spark_entry__ as se
    return sorted(se.oracle_sql())


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as se
    sdf = se.queries()[name](spark, SF)
    rel = con.sql(se.oracle_sql()[name])
    assert {c: TYPES.get(t, t) for c, t in sdf.dtypes} == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows([tuple(r) for r in sdf.collect()], sdf.columns) == _rows(res.fetchall(), dcols)


def test_entry_runs(spark):
    import __spark_entry__ as se
    df = se.entry(spark)
    assert df.count() >= 0 and "user_time_diff1_mean" in df.columns

"""Every named query against its SQL twin on the same tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from keycadence.plans.oracle import ORACLE
from keycadence.plans.registry import QUERIES

from .conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def _key(row):
    return [(v is None, type(v).__name__ == "str", v if v is not None else 0) for v in row]


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_same_names():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    names = [d[0] for d in expected.description]
    assert sorted(frame.columns) == sorted(names)
    types = {d[0]: str(d[1]).upper() for d in expected.description}
    spark_types = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
        "boolean": "BOOLEAN",
    }
    found_types = {n: spark_types.get(t, t) for n, t in frame.dtypes}
    found = sorted((tuple(_plain(r[c]) for c in names) for r in frame.collect()), key=_key)
    wanted = sorted((tuple(_plain(v) for v in r) for r in expected.fetchall()), key=_key)
    assert len(found) == len(wanted)
    assert found == wanted
    assert found and found_types == types

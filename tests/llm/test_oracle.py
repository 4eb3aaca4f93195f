"""Queries with a SQL twin against it, on the stored tables."""

import duckdb
import pytest

from keycadence.llm.oracle import ORACLE
from keycadence.llm.queries import QUERIES

from ..conftest import SMALL_DIR


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL_DIR}/{table}.parquet')")
    wanted = con.execute(ORACLE[name])
    names = [d[0] for d in wanted.description]
    frame = QUERIES[name](spark, SMALL_DIR)
    assert sorted(frame.columns) == sorted(names)
    found = sorted(map(str, (tuple(r) for r in frame.select(names).collect())))
    assert found and found == sorted(map(str, wanted.fetchall()))


def test_all_queries_are_registered():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))

"""Every registered query against its SQL, run by DuckDB on the same tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "decimal(38,0)": "DECIMAL(38,0)",
}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_oracle(spark, oracle, sf_dir, name):
    result = queries()[name](spark, sf_dir)
    expected = oracle.execute(oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    kinds = {d[0]: str(d[1]) for d in expected.description}
    assert {n: _TYPES[t] for n, t in result.dtypes} == kinds

    order = sorted(names)
    want = Counter(
        tuple(row[names.index(c)] for c in order) for row in expected.fetchall()
    )
    got = Counter(tuple(row) for row in result.select(*[f"`{c}`" for c in order]).collect())
    assert got == want


def test_entry_runs(spark):
    assert entry(spark).count() > 0

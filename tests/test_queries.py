"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")
SQL = {name: sql for name, sql in entry.oracle_sql().items() if not name.startswith("op")}


@pytest.fixture(scope="module")
def database():
    found = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        found.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return found


def plain(value):
    if isinstance(value, float):
        return round(value, 5) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value) if hasattr(value, "year") or hasattr(value, "as_tuple") else value


def in_order(columns, rows):
    places = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(row[k]) for k in places) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, database, name):
    got = entry.queries()[name](spark, SF)
    want = database.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert in_order(got.columns, got.collect()) == in_order(columns, want.fetchall())

"""Every registered query against its SQL in DuckDB at the smallest scale."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "scripts"))
import check_oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from mapstrata.plans import queries as registered  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    connection = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_names_agree():
    sqls = entry.oracle_sql()
    assert set(registered.QUERIES) <= set(entry.queries()) and set(registered.QUERIES) <= set(sqls)
    assert set(sqls) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query_equals_sql(spark, con, name):
    sql = entry.oracle_sql()[name]
    assert check_oracle.compare(spark, con, name, entry.queries()[name], sql, FOLDER) == ""


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) > 40 and {r.check for r in rows} >= {"srid", "lon_range", "dedup_keys"}

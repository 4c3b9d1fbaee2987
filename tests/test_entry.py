import importlib
from pathlib import Path

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def entry_module():
    return importlib.import_module("__spark_entry__")


def test_entry_runs(spark, entry_module):
    assert entry_module.entry(spark).count() >= 0


def test_every_oracle_has_a_query(entry_module):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_core_queries_equal_their_sql(spark):
    """Row counts and columns of all core queries at the smallest scale; values are compared by the driver."""
    from tidewell.plans import catalogue

    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    for name, sql in catalogue.ORACLE_SQL.items():
        df = catalogue.QUERIES[name](spark, SF)
        want = con.execute(sql)
        assert sorted(df.columns) == sorted(d[0] for d in want.description), name
        assert df.count() == len(want.fetchall()), name

"""Every registered query against its SQL in DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from dockpulse.catalogue.base import ORACLES, QUERIES
from tools.compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    relation = duck.execute(ORACLES[name])
    columns = [c[0] for c in relation.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, relation.fetchall())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_without_the_optional_part(tmp_path):
    """The core's queries register on a copy that has neither the optional operators nor the pipeline."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/dockpulse", tmp_path / "dockpulse", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]

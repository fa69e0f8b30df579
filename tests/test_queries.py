import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from textgrain.plans import ORACLES

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(ORACLES)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_oracles_build_without_a_session_or_spark_home():
    """The SQL is plain text of the package: a process that never starts Spark can build it."""
    code = (
        "import pyspark, __spark_entry__ as e; pyspark.__file__ = '/nowhere/pyspark.py';"
        "from pyspark.sql import SparkSession; sql = e.oracle_sql();"
        "assert SparkSession.getActiveSession() is None and all(isinstance(s, str) for s in sql.values()); print(len(sql))"
    )
    root = Path(contract.__file__).parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) == len(contract.oracle_sql())


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    expected = connection.sql(contract.oracle_sql()[name])
    got = contract.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)

    def canonical(rows):
        return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in row]) for row in rows)

    assert canonical(got.select(*columns).collect()) == canonical(expected.select(*columns).fetchall())

from pathlib import Path

import duckdb
import pytest

from textgrain.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
ROWS = {"op1": "SELECT count(DISTINCT conv_id) + 1 FROM conversations", "op9": "SELECT count(*) FROM pages", "op10": "SELECT 5 * count(*) FROM embeddings WHERE vec_id % 50 = 0", "op11": "SELECT count(DISTINCT conv_id) FROM conversations", "op13": "SELECT 8 * count(*) FROM embeddings"}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, tables, name):
    expected, got = tables.sql(ORACLE_SQL[name]), QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, expected.select(*columns).fetchall()))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_every_row(spark, tables, name):
    sql = ROWS.get(name.split("_")[0], "SELECT count(*) FROM documents")
    assert QUERIES[name](spark, FOLDER).count() == tables.sql(sql).fetchall()[0][0]

"""The query catalogue against DuckDB on the smallest tables, where these are at hand."""

from pathlib import Path

import pytest

import __spark_entry__
from gaugeworks import queries

SF = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_every_sql_has_a_query(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(queries.queries()) <= set(__spark_entry__.queries())


def rows(frame, columns):
    plain = lambda v: "" if v is None or v != v else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(map(str, map(plain, r))) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.skipif(not SF.exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted([*queries.oracle_sql(), *queries.CASES]))
def test_query_matches_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    query, sql = queries.CATALOGUE[name]
    expected = con.execute(sql).df()
    got = query(spark, str(SF)).toPandas()
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    assert rows(got, columns) == rows(expected, columns)

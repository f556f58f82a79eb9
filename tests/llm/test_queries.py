"""The whole-table queries against their SQL on the smallest tables, where these are at hand."""

from pathlib import Path

import pandas as pd
import pytest

from gaugeworks.llm import registry

SF = Path("/root/testdata/sf0.001")


def rows(frame, columns):
    plain = lambda v: "" if pd.isna(v) else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(map(str, map(plain, r))) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.skipif(not SF.exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    expected = con.execute(registry.oracle_sql()[name]).df()
    got = registry.queries()[name](spark, str(SF)).toPandas()
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns and rows(got, columns) == rows(expected, columns)

"""The SQL of the operators agrees with them on the smallest tables."""

import duckdb
import pytest

from condmon.llm.queries import oracle_sql, queries

from .conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = queries()[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    found = con.execute(f"SELECT {', '.join(cols)} FROM ({oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, found)) == sorted(repr(tuple(r)) for r in got.select(*cols).collect())


def test_every_query_has_rows_of_its_whole_table(spark):
    names = set(queries())
    assert {n.split("_")[0] for n in names} == {*(f"op{k}" for k in range(1, 14)), "pipeline"}

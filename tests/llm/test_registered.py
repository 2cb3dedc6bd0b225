"""Every registered query with a DuckDB statement gives its rows (sf0.001)."""
import duckdb
import pytest

import __spark_entry__ as entry_mod
from tidewater.llm.queries import ORACLE, QUERIES

D = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_mod.queries())
    assert set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    res = con.execute(ORACLE[name])
    names = sorted(c[0] for c in res.description)
    places = [[c[0] for c in res.description].index(n) for n in names]
    got = QUERIES[name](spark, D)
    assert set(names) == set(got.columns)
    want = sorted(repr(tuple(r[i] for i in places)) for r in res.fetchall())
    assert sorted(repr(tuple(r)) for r in got.select(*names).collect()) == want

"""The queries that SQL can express, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from quire.llm.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    found = con.execute(ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    assert sorted(tuple(str(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(str(r[names.index(c)]) for c in columns) for r in found.fetchall())


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 11)}

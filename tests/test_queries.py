"""Every query of the library against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from quillrank import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(table):
    cut = lambda x: round(x, 8) if isinstance(x, float) else str(x)
    return sorted((tuple(cut(r[k]) for k in sorted(r)) for r in table.to_pylist()), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toArrow()
    if name in catalog.ORACLES:
        want = duck.execute(catalog.ORACLES[name]).to_arrow_table()
        assert sorted(got.column_names) == sorted(want.column_names)
        assert rows(got) == rows(want)

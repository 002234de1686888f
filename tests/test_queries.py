"""Every registered query against its SQL on the smallest data set."""

import os

import duckdb
import pytest

from orderflow.plans import REGISTRY

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    got = REGISTRY[name].run(spark, FOLDER)
    sql = REGISTRY[name].oracle()
    want = duck.execute(sql)
    assert got.columns == [c[0] for c in want.description]
    assert ordered(got.collect()) == ordered(want.fetchall())

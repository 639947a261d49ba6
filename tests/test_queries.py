"""Every registered query against its SQL on the small tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from terrazone import plans

FOLDER = os.environ.get("QUERY_TEST_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not available")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def near(a, b):
    return math.isclose(a, b, rel_tol=1e-6, abs_tol=2e-4) if isinstance(a, float) and isinstance(b, float) else a == b


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    assert len(set(columns)) == len(columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    sql = plans.ORACLE_SQL.get(name)
    cur = duck.execute(sql)
    header = [d[0] for d in cur.description]
    assert sorted(header) == columns
    want = [tuple(r[header.index(c)] for c in columns) for r in cur.fetchall()]
    assert len(got) == len(want)
    for a, b in zip(ordered(got), ordered(want)):
        assert all(near(x, y) for x, y in zip(a, b)), (a, b)


def test_entry_and_names(spark):
    assert driver.entry(spark).count() == 3
    assert set(driver.oracle_sql()) <= set(driver.queries())

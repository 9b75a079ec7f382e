"""The registered queries: every one runs on the smallest tables, and equals its SQL there."""

import glob
import os

import pytest

from paperloom.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(DATA + "/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    return repr(round(v, 9)) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(x) for x in r) for r in df.select(*cols).collect())
    if name in registry.ORACLES:
        r = duck.execute(registry.ORACLES[name])
        names = [d[0] for d in r.description]
        assert sorted(names) == cols
        assert got == sorted(tuple(plain(x[names.index(c)]) for c in cols) for x in r.fetchall())


def test_flagship_is_registered():
    assert registry.FLAGSHIP in registry.QUERIES

"""Every registered query against its reference SQL in DuckDB."""

import os

import duckdb
import pytest

from geoloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted((tuple("%.9g" % v if isinstance(v, float) else str(list(v)) if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and not isinstance(v, str) and getattr(v, "ndim", 0) else str(v) for v in r) for r in frame.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF).toPandas()
    want = duck.execute(registry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

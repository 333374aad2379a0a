"""Driver contract: entry smoke, registry/oracle consistency, oracle equality."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, table_digest  # noqa: E402

from lumenlog.plans import catalog, oracle  # noqa: E402

# the library's own queries; those of optional subpackages are tested there
OWN = sorted(oracle.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "level", "count", "alert_text"]
    assert df.count() == 27


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(OWN)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sk, sh = table_digest(sdf.columns, srows)
    dc, dk, dh = table_digest(dcols, drows)
    assert sc == dc
    assert len(srows) == len(drows)
    assert sh == dh, (sorted(set(sk) - set(dk))[:2], sorted(set(dk) - set(sk))[:2])

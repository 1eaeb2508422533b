"""Every registered query of the reference's own operators against its SQL twin in DuckDB, at scale 0.01, where rare letters and ties occur."""

import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

from tallyframe.plans import registry

SF = "/root/testdata/sf0.01"


def plain(v):
    """A value for comparison: numbers to nine digits, whatever type an engine gives them."""
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, (float, Decimal)):
        return "NaN" if math.isnan(v) else f"{float(v):.9g}"
    if isinstance(v, int) and not isinstance(v, bool):
        return f"{float(v):.9g}" if abs(v) < 1 << 52 else str(v)
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    found = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(str([plain(r[i]) for i in at]) for r in found.fetchall())

"""Every query with SQL agrees with it on the smallest tables."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from pitlake.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, (float, Decimal)) and not isinstance(v, bool):
        return "nan" if math.isnan(v) else round(float(v), 6) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_agrees_with_its_sql(spark, duck, sf, name):
    df = catalog.queries()[name](spark, sf)
    names = sorted(df.columns)
    own = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    found = duck.sql(catalog.oracle_sql()[name])
    assert sorted(found.columns) == names
    at = [found.columns.index(c) for c in names]
    assert own == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_registry_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry.__file__).parent
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr

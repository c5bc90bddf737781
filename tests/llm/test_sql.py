"""The training-data queries that SQL can express agree with it on the smallest tables."""

import duckdb
import pytest

from pitlake.llm import entry


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_its_sql(spark, duck, sf, name):
    df = entry.queries()[name](spark, sf)
    names = sorted(df.columns)
    own = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    found = duck.sql(entry.oracle_sql()[name])
    assert sorted(found.columns) == names
    at = [found.columns.index(c) for c in names]
    assert own == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)


def test_personal_data_of_odd_texts_agrees_with_its_sql(spark):
    from test_texts import ODD, PRIVATE

    texts = [t for t in [*ODD, *PRIVATE] if t is None or "\x00" not in t]
    more = ["_GB82WEST12345698765432", "GB82WEST12345698765432_", "éGB82WEST12345698765432", "my ssn 123-45-6789-", "ssn: 123-45-6789 and ssn 000-12-3456, ssn 912-12-3456, ssn 123-00-4567 ssn 123-45-0000"]
    rows = list(enumerate(texts + more))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    found = con.sql(entry.oracle_sql()["op9_pii"])
    from pitlake.llm.pii import scan_documents

    df = scan_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    names = sorted(df.columns)
    at = [found.columns.index(c) for c in names]
    want = {r[found.columns.index("doc_id")]: tuple(plain(r[i]) for i in at) for r in found.fetchall()}
    for r in df.collect():
        assert tuple(plain(r[c]) for c in names) == want[r["doc_id"]], rows[r["doc_id"]]

"""The driver contract, and every registered query against its DuckDB
oracle on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["topic_id", "doc_id", "score", "rank"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) == set(E.ORACLES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows),
                  key=repr)


@pytest.mark.parametrize("key", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm(df.columns, [tuple(r) for r in df.collect()]) == _norm(ocols, res.fetchall())

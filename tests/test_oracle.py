"""queries() against oracle_sql() in DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from paths import SF001
from tools.check_oracle import TABLES, digest

SLOW = {"train_sentiment", "train_multitask", "label_stream", "score_stream", "label_stream_timeout", "score_text_stream"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - SLOW))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_has_entry():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["label", "task", "n"]
    assert sum(r.n for r in df.collect()) == 200

"""Every catalog query against its SQL twin: columns, rows and values, whatever the order."""

import duckdb
import pytest

from shelfmark.registry import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return repr(round(float(v), 6))
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twin(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    q = con.execute(ORACLE_SQL[name])
    assert got == rows_of([c[0] for c in q.description], q.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows_only(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0

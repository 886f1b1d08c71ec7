"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from meshwright.plans import catalogue, catalogue_files  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda x: str(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) or type(x).__name__ == "Decimal" else str(x)
    return sorted(tuple(show(r[i]) for i in order) for r in data), sorted(columns)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    got = rows(df.collect(), df.columns)
    if name in catalogue.SQL:
        r = duck.execute(catalogue.SQL[name])
        columns = [x[0] for x in r.description]
        assert got == rows(r.fetchall(), columns)
    else:
        assert got[0]


def test_entry_has_a_query_for_each_sql():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())

import duckdb
import pytest

from nutq import queries as Q


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_query_equals_its_twin(spark, sf_dir, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    mine, twin = Q.QUERIES[name](spark, sf_dir), con.sql(Q.ORACLE[name])
    order = sorted(mine.columns)
    assert order == sorted(twin.columns)
    rows = lambda x: sorted(map(repr, x))
    assert rows(tuple(r) for r in mine.select(*order).collect()) == rows(twin.select(*[f'"{c}"' for c in order]).fetchall())


def test_entry_points():
    import __spark_entry__ as entry

    assert set(Q.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())

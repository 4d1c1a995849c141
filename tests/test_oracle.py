"""Every registered query against its DuckDB oracle (small scale)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.base_queries()))
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["ok"], r


def test_every_query_has_an_oracle():
    assert set(E.base_queries()) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "vazena_suma" in df.columns


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.base_queries()))
def test_column_types_match_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    ours = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
            for f in df.schema.fields}
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert ours == theirs

"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import re

import pytest

import __spark_entry__ as se
from tests.conftest import SF_SMALL
from tests.oracle_check import canon, duck

#: The training-data operators have their own tests (tests/llm).
OWN = re.compile(r"(?!op\d+_|pipeline$)")
KEYS = sorted(filter(OWN.match, se.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def _kind_spark(dt) -> str:
    name = dt.simpleString()
    if name in ("tinyint", "smallint", "int", "bigint"):
        return name
    return {"double": "float", "float": "float", "string": "str", "boolean": "bool",
            "timestamp": "ts", "timestamp_ntz": "ts"}.get(name, name)


def _kind_duck(t) -> str:
    t = str(t).upper()
    return {"TINYINT": "tinyint", "SMALLINT": "smallint", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "float",
            "FLOAT": "float", "VARCHAR": "str", "BOOLEAN": "bool", "TIMESTAMP": "ts"}.get(t, t)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = se.queries()[key](spark, SF_SMALL)
    rel = con.sql(se.oracle_sql()[key])
    types = dict(zip(rel.columns, rel.types))
    assert {f.name: _kind_spark(f.dataType) for f in df.schema.fields} == \
        {n: _kind_duck(t) for n, t in types.items()}
    got = df.toPandas()
    want = con.execute(se.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert canon(got) == canon(want)


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(filter(OWN.match, set(se.queries()) - set(se.oracle_sql())))
    assert rows_only <= {"pca", "logreg", "random_forest", "batch_score", "batch_flow"}
    assert set(se.oracle_sql()) <= set(se.queries())


def test_entry_smoke(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["request_id", "member_id"]

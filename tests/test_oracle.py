"""Every registered query with a SQL oracle equals DuckDB on sf0.001
(row count, column names, order-insensitive value hash)."""

import re

import pytest

import __spark_entry__ as entry
from tests.oracle_check import digest, duck

SF = "/root/testdata/sf0.001"
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}
SQL = {k: v for k, v in entry.oracle_sql().items() if not re.match(r"op\d+_|pipeline$", k)}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "price_id" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    duck_types = dict(zip(dcols, [str(t) for t in con.sql(SQL[name]).types]))
    assert spark_types == duck_types
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_every_query_has_an_oracle_or_is_iterative():
    # the training-data queries (opN_..., pipeline) are tested beside their code
    own = {q for q in entry.queries() if not re.match(r"op\d+_|pipeline$", q)}
    rows_only = own - set(SQL)
    assert rows_only == {"model_forecast", "model_importance", "model_scores", "model_scores_v1"}

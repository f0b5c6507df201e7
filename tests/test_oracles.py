"""Every registered query runs; where SQL states the result, DuckDB must agree exactly."""

import os

import pytest

from millrace.plans.catalog import ORACLES, QUERIES
from tests.oracle import canonical, duck_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

KIND = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "FLOAT": "float",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in result.collect()]
    assert rows
    if name not in ORACLES:
        return
    columns, types, expected = duck_rows(SF_DIR, ORACLES[name])
    assert canonical(result.columns, rows) == canonical(columns, expected)
    ours = {f.name: f.dataType.simpleString() for f in result.schema.fields}
    assert ours == {c: KIND.get(t, t) for c, t in zip(columns, types)}

import os
import re

import duckdb
import pytest

import __spark_entry__
from tallyloom.llm import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_operator_has_one_query():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_gives_what_its_sql_gives(spark, name):
    """The registered query on the smallest tables, against DuckDB."""
    con = duckdb.connect()
    for x in os.listdir(DATA):
        con.execute(f"CREATE VIEW {x.split('.')[0]} AS SELECT * FROM '{DATA}/{x}'")
    found = con.execute(registry.ORACLE[name])
    columns = [c[0] for c in found.description]
    want = sorted(map(str, found.fetchall()))
    assert want
    assert sorted(str(tuple(r[c] for c in columns)) for r in registry.QUERIES[name](spark, DATA).collect()) == want

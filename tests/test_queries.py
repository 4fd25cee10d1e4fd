"""Every query with SQL gives what DuckDB gives, on the smallest tables."""

import math
import os

import duckdb
import pytest

from tallyloom.plans import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    return f"{float(value):.6g}" if isinstance(value, (int, float)) or hasattr(value, "as_tuple") else str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    found = duck.execute(registry.ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted([tuple(plain(v) for v in r) for r in found.fetchall()], key=str)
    assert sorted([tuple(plain(r[c]) for c in columns) for r in df.collect()], key=str) == want


def both(spark, name, folder):
    """A query's rows over a folder, and its SQL's, as sorted tuples."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(folder):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{folder}/{file}'")
    found = con.execute(registry.ORACLE[name])
    columns = [c[0] for c in found.description]
    want = sorted([tuple(plain(v) for v in r) for r in found.fetchall()], key=str)
    return sorted([tuple(plain(r[c]) for c in columns) for r in registry.QUERIES[name](spark, folder).collect()], key=str), want


def changed(folder, **tables):
    """The tables of DATA in a folder, some of them by SQL over the original, named t."""
    for name in os.listdir(DATA):
        sql = tables.get(name.split(".")[0], "SELECT * FROM t").replace("FROM t", f"FROM '{DATA}/{name}' AS t")
        duckdb.sql(f"COPY ({sql}) TO '{folder}/{name}' (FORMAT parquet)")
    return str(folder)


def test_a_sample_without_orders_counts_0(spark, tmp_path):
    got, want = both(spark, "comparative_matrix", changed(tmp_path, orders="SELECT * FROM t WHERE o_custkey > 50"))
    assert got == want and ("1", "0", "0") in want


def test_an_analysis_without_terms_has_none_significant(spark, tmp_path):
    got, want = both(spark, "variant_set_summary", changed(tmp_path, part="SELECT * REPLACE (1 AS p_size) FROM t"))
    assert got == want and {r[-2:] for r in want} == {("0", "0")}


#: Two suppliers with 20 copies of each of their intervals.
TIED = "SELECT t.* REPLACE (l_suppkey % 2 AS l_suppkey) FROM t, range(200)"


@pytest.mark.parametrize("name", ["merge_intervals", "gene_model"])
def test_equal_intervals_stand_once(spark, tmp_path, name):
    got, want = both(spark, name, changed(tmp_path, lineitem=TIED))
    assert got == want


def test_spectra_meet_events_by_peptide(spark):
    """Of a peptide's spectra the samples are known before events join them."""
    plan = registry.QUERIES["variant_evidence_rows"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    events = [k for k, x in enumerate(plan) if "Relation [event_id" in x]
    # above each reading of the spectra the first step other than of rows is an aggregate
    above = [next(x for x in reversed(plan[:k]) if "Project" not in x and "Filter" not in x) for k in events]
    assert above and all("Aggregate [" in x for x in above)


def test_names():
    assert set(registry.ORACLE) <= set(registry.QUERIES)

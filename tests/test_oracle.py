"""Every registered query against its independent DuckDB SQL (sf0.001), and
the driver contract."""

import pytest

import __spark_entry__ as entry_mod
from oracle.compare import compare, duck_connection

SF = "/root/testdata/sf0.001"
# the training-text queries (op*, pipeline) have tests of their own and may be absent
NAMES = sorted(n for n in entry_mod.queries() if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_oracle_sql():
    assert set(NAMES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert len(NAMES) == 47


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert "art_outcome" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(entry_mod.queries()[name](spark, SF), entry_mod.oracle_sql()[name], con)
    assert res["ok"], res

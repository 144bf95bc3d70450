"""Plan-shape guards (broadcast disabled, i.e. the shape large inputs get)."""

import re
import tempfile

import pytest

from cohortlake.params import FIXTURE_AS_OF
from cohortlake.plans.graph import DATASETS, DatasetGraph
from cohortlake.sources.adapter import TABLES, FixtureTables
from cohortlake.sources.sink import overwrite_table
from cohortlake.sources.tables import TableSet

SF = "/root/testdata/sf0.001"
SINGLE_TABLE = ["d01", "d02", "d03", "d04", "d08", "d11", "d12", "d13", "d15", "d18", "d19", "d20", "d21", "d22"]


@pytest.fixture(scope="module")
def graph(spark):
    base = tempfile.mkdtemp(prefix="cohortlake-test-plans-")
    fixtures = FixtureTables(spark, SF)
    for name in TABLES:
        overwrite_table(getattr(fixtures, name), f"{base}/{name}.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield DatasetGraph(TableSet(spark, base), FIXTURE_AS_OF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("ds", SINGLE_TABLE)
def test_single_table_datasets_shuffle_once_after_a_partial_limit(graph, ds):
    p = plan(graph.get(ds))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert len(exchanges) == 1
    assert "patient_pk" in exchanges[0] or "patient_pk_hash" in exchanges[0]
    assert "WindowGroupLimit" in p and "Partial" in p


@pytest.mark.parametrize("ds", list(DATASETS))
def test_no_cartesian_or_nested_loop_join(graph, ds):
    p = plan(graph.get(ds))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


@pytest.mark.parametrize("ds", ["d01", "d03", "d06", "d13", "d14"])
def test_soft_delete_filter_reaches_the_scan(graph, ds):
    assert "EqualTo(voided,0)" in plan(graph.get(ds))


def test_last_visit_rows_reach_the_exchange_through_a_partial_limit(graph):
    """Every exchange of visit rows lies above a partial limit on rank."""
    p = plan(graph.get("d09"))
    assert len(re.findall(r"WindowGroupLimit \[[^\]]*\], \[visit_date[^\]]*\], rank\(", p)) >= 2
    assert "Partial" in p


def test_interval_results_are_aggregated_before_treatment_records_multiply_them(graph):
    """No aggregate sorts what the join with the treatment records gives."""
    p = plan(graph.d14)
    above = p[: p.index("SortMergeJoin")]
    assert "Window" in above and "SortAggregate" not in above and "HashAggregate" not in above


def test_large_treatment_keys_read_the_same_newest_dispenses_as_usual_ones(graph):
    """D06 below D10's view of D09: every reading of the newest dispenses has the same columns, so that one is run."""
    d09 = graph.d09.select("patient_pk", "site_code", "pregnant")
    newest = re.findall(r"FileScan parquet \[([^]]*dispense_date[^]]*)\]", plan(d09))
    assert len(newest) >= 2 and len({re.sub(r"#\d+L?", "", n) for n in newest}) == 1


def test_list_of_large_keys_is_known_before_its_joins(graph):
    """The list keeps an exchange of its own, so that an empty one takes its branch out of the running plan."""
    assert re.search(r"Exchange hashpartitioning\(site_code#\w+, patient_pk#\w+, __ways#\w+", plan(graph.d06))

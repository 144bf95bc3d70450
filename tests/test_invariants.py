"""Structural invariants of the datasets on the fixture tables."""

import pytest
from pyspark.sql import functions as F

from cohortlake.params import FIXTURE_AS_OF
from cohortlake.plans import KEY
from cohortlake.plans.graph import DatasetGraph
from cohortlake.sources.adapter import FixtureTables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def graph(spark):
    return DatasetGraph(FixtureTables(spark, SF), FIXTURE_AS_OF)


@pytest.mark.parametrize("ds,keys", [
    ("d01", KEY), ("d02", KEY), ("d03", KEY), ("d04", KEY), ("d08", KEY), ("d11", KEY), ("d12", KEY),
    ("d15", ["patient_pk_hash", "site_code"]), ("d18", KEY + ["emr"]), ("d19", KEY),
    ("d20", KEY + ["test_date", "test_type"]), ("d21", KEY), ("d22", KEY),
])
def test_at_most_one_row_per_key(graph, ds, keys):
    df = graph.get(ds)
    assert df.groupBy(*keys).count().filter("count > 1").count() == 0


def test_ordered_viral_loads_ranks(graph):
    d13 = graph.get("d13")
    per_key = d13.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("rank").alias("mx"), F.min("rank").alias("mn"))
    assert per_key.filter("n > 10 OR mx != n OR mn != 1").count() == 0


def test_as_at_subsets(graph):
    assert graph.get("d02").select(*KEY).subtract(graph.get("d01").select(*KEY)).count() == 0
    assert graph.get("d04").select(*KEY).subtract(graph.get("d03").select(*KEY)).count() == 0


def test_baseline_not_after_latest(graph):
    b = graph.get("d11").select(*KEY, F.col("ordered_by_date").alias("b"))
    latest = graph.get("d12").select(*KEY, F.col("ordered_by_date").alias("l"))
    assert b.join(latest, KEY).filter("b > l").count() == 0


def test_last_encounter_not_after_eopm(graph):
    assert graph.get("d06").filter(F.col("last_encounter_date") > F.lit(FIXTURE_AS_OF.eopm)).count() == 0

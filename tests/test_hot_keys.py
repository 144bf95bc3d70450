"""Datasets with one key that holds very many rows: same rows as plain definitions, built by several tasks."""

import datetime as dt
import random

import pytest

from cohortlake.plans import encounter
from tests.conftest import rows

D = dt.date
AS_OF = "2021-02-15"
IDS = "patient_id string, site_code int, patient_pk bigint, patient_pk_hash string, patient_id_hash string"


def ids(pk, who=""):
    return (f"P{pk}{who}", 1, pk, f"H{pk}", f"I{pk}")


def last_encounters(pharmacy, art, visits):
    """D06 by its definition: every pair of a key's treatment rows."""
    day, eopm = D(2021, 2, 15), D(2021, 1, 31)
    top = lambda *xs: max((x for x in xs if x is not None), default=None)
    out = set()
    for who in {tuple(r[:5]) for r in art}:
        pk = who[2]
        ph = max(((r[6], r[5], r[7]) for r in pharmacy if r[2] == pk and r[6] <= eopm), default=None)
        lv = max(((r[6], r[5], r[7]) for r in visits if r[2] == pk and r[6] <= eopm), default=None)
        ph_next = v_next = None
        if ph:
            far = ph[2] is None or (ph[2] - ph[0]).days >= 365 or ph[2] == D(1900, 1, 1)
            ph_next = ph[0] + dt.timedelta(days=30) if far else ph[2]
        if lv:
            v_next = lv[2] or lv[0] + dt.timedelta(days=30)
        own = [(r[6], r[7]) for r in art if r[2] == pk and r[6] is not None and r[6] <= eopm] or [(None, None)]
        for first, ret in own:
            for second, _ in own:
                last = top(ph and ph[0], first, second, lv and lv[0])
                if last is None:
                    continue
                nxt = top(ph_next, ret, v_next)
                if nxt is None or (nxt - day).days > 365:
                    nxt = last + dt.timedelta(days=30)
                out.add((*who, last, nxt))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("in_place", "share"), [(64, 100_000), (2, 7)])
def test_last_encounter_pairs_of_large_and_small_keys(spark, monkeypatch, in_place, share):
    monkeypatch.setattr(encounter, "ROWS_IN_PLACE", in_place)
    monkeypatch.setattr(encounter, "PAIRS_A_SHARE", share)
    rng = random.Random(in_place)
    day = lambda lo, hi: rng.choice([None, D(2019, 1, 1) + dt.timedelta(days=rng.randint(lo, hi))])
    art = [(*ids(1, rng.choice("ab")), D(2018, 1, 1), day(0, 800), day(400, 1300)) for _ in range(40)]
    art += [(*ids(pk), rng.choice([None, D(2018, 1, 1)]), day(0, 800), day(400, 1300)) for pk in range(2, 40) for _ in range(rng.randint(1, 3))]
    art += [art[0], art[50]]
    some = lambda pk: D(2019, 6, 1) + dt.timedelta(days=pk * 13)
    pharmacy = [(*ids(pk), n, some(pk), rng.choice([None, D(1900, 1, 1), some(pk + 2), some(pk + 80)])) for pk in range(1, 30) for n in (1, 2)]
    visits = [(*ids(pk), 1, some(pk + 1), rng.choice([None, some(pk + 3)])) for pk in range(1, 45, 2)]
    frame = lambda given, names: spark.createDataFrame([(*r, 0) for r in given], f"{IDS}, {names}, voided int")
    out = encounter.last_encounter(
        frame(pharmacy, "dispense_id bigint, dispense_date date, expected_return date"),
        frame(art, "start_art_date date, last_visit date, expected_return date"),
        frame(visits, "visit_id bigint, visit_date date, next_appointment_date date"), AS_OF)
    names = [c.split()[0] for c in IDS.split(", ")]
    assert rows(out, *names, "last_encounter_date", "next_appointment_date") == last_encounters(pharmacy, art, visits)


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("ds", "module", "name"), [("d09", "obs", "ROWS_A_SHARE"), ("d10", "obs", "ROWS_A_SHARE"), ("d23", "hts_prep", "PAIRS_A_TASK")])
def test_large_key_branch_gives_the_same_rows(spark, monkeypatch, ds, module, name):
    import importlib

    plan = importlib.import_module(f"cohortlake.plans.{module}")
    from cohortlake.params import FIXTURE_AS_OF
    from cohortlake.plans.graph import DatasetGraph
    from cohortlake.sources.adapter import FixtureTables

    graph = lambda: DatasetGraph(FixtureTables(spark, SF), FIXTURE_AS_OF).get(ds)
    want = rows(graph())
    monkeypatch.setattr(plan, name, 0.5)  # every key counts as large
    assert rows(graph()) == want


def test_prevention_refills_gather_no_arrays(spark):
    from cohortlake.params import FIXTURE_AS_OF
    from cohortlake.plans.graph import DatasetGraph
    from cohortlake.sources.adapter import FixtureTables

    plan = DatasetGraph(FixtureTables(spark, SF), FIXTURE_AS_OF).get("d23")._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan


def test_refills_of_one_client_with_very_many_tests(spark, monkeypatch):
    """Every refill day has 40 tests: 1,600 pairs of one key, next to an ordinary one."""
    from cohortlake.plans import hts_prep

    monkeypatch.setattr(hts_prep, "PAIRS_A_TASK", 50)
    enrol = [("P1", "N1", 1, "H1", D(2020, 1, 1), 7), ("P2", "N2", 2, "H2", D(2020, 1, 1), 7), ("P3", "N3", 3, "H3", None, 7)]
    refills = [("P1", 1, 7, 1, D(2020, 2, 2)), ("P1", 1, 7, 2, D(2020, 4, 4)), ("P2", 2, 7, 3, D(2020, 2, 2))]
    tests = [(7, 1, day, f"r{n}") for day in (D(2020, 2, 2), D(2020, 4, 4)) for n in range(40)] + [(7, 2, D(2020, 2, 2), "Negative")]
    out = hts_prep.prep_refills(
        spark.createDataFrame(enrol, "prep_number string, prep_number_hash string, patient_pk bigint, patient_pk_hash string, prep_enrollment_date date, site_code int"),
        spark.createDataFrame(refills, "prep_number string, patient_pk bigint, site_code int, dispense_id bigint, dispense_date date"),
        spark.createDataFrame(tests, "site_code int, patient_pk bigint, test_date date, final_test_result string"), AS_OF).collect()
    of = lambda pk: {(r.test_results_month1, r.test_results_month3) for r in out if r.patient_pk == pk}
    assert of(1) == {(f"r{i}", f"r{j}") for i in range(40) for j in range(40)}
    assert of(2) == {("Negative", None)} and of(3) == {(None, None)} and len(out) == 1602


def test_a_large_last_visit_is_multiplied_by_several_tasks(spark):
    """100 values in each of three sets of one visit: a million rows of one key."""
    from pyspark.sql import functions as F

    from cohortlake.plans import obs

    sets = [(f"s{i}", None, [f"v{i}"]) for i in range(3)]
    visits = spark.range(100).selectExpr("1 as site_code", "1L as patient_pk", "DATE'2020-01-01' as visit_date", "5L as visit_id", "0 as voided", "'x' as adherence_category",
                                         *[f"concat('a{i}', id) as v{i}" for i in range(3)])
    base = spark.createDataFrame([(1, 1), (1, 2), (None, None)], "site_code int, patient_pk bigint")
    wide = base.join(obs.last_visit_sets(obs.last_visit_rows(visits, sets), sets), ["site_code", "patient_pk"], "left")
    out = obs.expanded(wide, ["s0", "s1", "s2"])
    counted = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in counted) == 100**3 + 2 and max(r["count"] for r in counted) < 0.5 * 100**3
    assert out.filter("patient_pk = 1").select("s0.v0", "s1.v1", "s2.v2").distinct().count() == 100**3


def test_cells_spread_one_key_and_meet_every_pair_once(spark):
    from pyspark.sql import functions as F

    from cohortlake.operators import copied, dealt, large_keys

    values = lambda name: spark.range(200).select(F.lit(1).alias("k"), F.col("id").alias(name))
    large = large_keys(values("x").groupBy("k").agg(F.count("*").alias("n")), ["k"], F.col("n") > 5, F.col("n") / 10)
    met = dealt(values("x").join(large, "k"), ["k"], ["x"]).join(copied(values("y").join(large, "k"), ["k"]), ["k", "__share"])
    counted = met.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert met.select("x", "y").distinct().count() == 200**2 == met.count()
    assert max(r["count"] for r in counted) < 0.5 * 200**2

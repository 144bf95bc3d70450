"""Latest observations per live patient (D09): weight/height, age at last
encounter, multi-month dispensing, and attributes of the last visit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions import banded_days, ci_in, not_blank, year_boundary_diff
from cohortlake.operators import in_tasks, latest_per_key, live
from cohortlake.params import AsOf
from cohortlake.plans import KEY

# Adherence categories that describe treatment adherence.
ART_ADHERENCE_CATEGORIES = ["ARVAdherence", "ART", "ART|CTX", "ARV", "ARV Adherence"]

# (set column, condition on the visit row or None, attribute columns); the
# family-planning set is not emitted but multiplies rows like the others.
_VISIT_SETS = [
    ("s_adherence", lambda: ci_in("adherence_category", ART_ADHERENCE_CATEGORIES), ["adherence"]),
    ("s_dc", lambda: F.col("differentiated_care").isNotNull(), ["differentiated_care"]),
    ("s_stability", None, ["stability_assessment"]),
    ("s_pregnant", lambda: F.col("pregnant").isNotNull(), ["pregnant"]),
    ("s_fp", lambda: F.col("family_planning_method").isNotNull() & not_blank("family_planning_method"),
     ["family_planning_method"]),
    ("s_bf", lambda: F.col("breastfeeding").isNotNull() & not_blank("breastfeeding"),
     ["breastfeeding", "lmp", "gestation_age"]),
    ("s_who", None, ["who_stage"]),
]


#: Rows of the product of a key's value sets that one task builds, about.
ROWS_A_SHARE = 10_000


def last_visit_rows(visits: DataFrame, sets: list) -> DataFrame:
    """The different rows of each key's last visit.

    These are the rows of rank 1 by (date, visit id), so each map task forwards only a
    key's newest visit (a partial limit) and one exchange on the key carries them. A visit
    without date or id is no last visit. The distinct over all columns keeps this one
    distribution for all readers.
    """
    attr_cols = sorted({c for _, _, cols in sets for c in cols} | {"adherence_category"})
    newest = Window.partitionBy(*KEY).orderBy(F.col("visit_date").desc_nulls_last(), F.col("visit_id").desc_nulls_last())
    return (
        live(visits).select(*KEY, "visit_date", "visit_id", *attr_cols)
        .withColumn("__rank", F.rank().over(newest)).filter("__rank = 1").drop("__rank")
        .filter(F.col("visit_date").isNotNull() & F.col("visit_id").isNotNull())
        .distinct()
    )


def last_visit_sets(rows: DataFrame, sets: list) -> DataFrame:
    """Per key, the distinct values of each attribute group, with the visit's date and id.
    A set holds what a single visit holds."""
    aggs = []
    for name, cond, cols in sets:
        kept = F.struct(*[F.col(c) for c in cols])
        aggs.append(F.collect_set(kept if cond is None else F.when(cond(), kept)).alias(name))
    return rows.groupBy(*KEY).agg(*aggs, F.max("visit_date").alias("__date"), F.max("visit_id").alias("__id"))


def expanded(wide: DataFrame, names: list[str], weight=None) -> DataFrame:
    """``wide`` (one row per key, with arrays) with every set of values in ``names`` exploded.

    A key whose product is large goes out in as many shares as its size asks for: each
    share has a slice of the largest set and all of the others, and the shares are
    distributed before anything is multiplied, so several tasks build the product. A
    usual key is one share. ``weight``: how many rows an element of the first set stands for.
    """
    sizes = [F.greatest(F.size(n), F.lit(1)) for n in names]
    if weight is not None:
        sizes.append(F.greatest(F.aggregate(names[0], F.lit(0.0), lambda acc, x: acc + weight(x)), F.lit(1.0)))
    product = reduce(lambda a, b: a * b, [n.cast("double") for n in sizes])
    largest = F.greatest(*[F.coalesce(F.size(n), F.lit(0)) for n in names], F.lit(1))
    ways = F.least(F.ceil(product / ROWS_A_SHARE), largest).cast("int")
    split = wide.withColumn("__largest", largest).withColumn("__ways", ways)
    split = split.withColumn("__share", F.explode(F.sequence(F.lit(0), F.col("__ways") - 1)))
    taken = F.lit(False)
    for name in names:  # the first of the largest sets is the one that is cut
        cut = (F.col("__ways") > 1) & (F.coalesce(F.size(name), F.lit(0)) == F.col("__largest")) & ~taken
        mine = F.filter(F.col(name), lambda x, i: F.pmod(i, F.col("__ways")) == F.col("__share"))
        split = split.withColumn(f"__cut_{name}", F.when(cut, mine).otherwise(F.col(name)))
        taken = taken | cut
    split = split.withColumns({n: F.col(f"__cut_{n}") for n in names}).drop(*[f"__cut_{n}" for n in names])
    out = in_tasks(split.drop("__largest", "__ways"), *KEY, "__share").drop("__share")
    for name in names:
        out = out.withColumn(name, F.explode_outer(name))
    return out


def _tb(rows: DataFrame, ipt: DataFrame) -> DataFrame:
    """``rows`` (with ``__date`` and ``__id`` of the last visit) with ``s_tb``: the newest
    screening, one row per key, where it is of that same visit."""
    screening = latest_per_key(live(ipt), KEY, "visit_date", ["visit_id"]).select(
        *KEY, F.col("visit_date").alias("__tb_date"), F.col("visit_id").alias("__tb_id"), "tb_screening")
    same = (F.col("__tb_date") == F.col("__date")) & (F.col("__tb_id") == F.col("__id"))
    return rows.join(screening, KEY, "left").withColumn("s_tb", F.when(same, F.struct("tb_screening"))).drop(
        "__tb_date", "__tb_id", "tb_screening", "__date", "__id")


def pregnancy_obs(patients: DataFrame, visits: DataFrame) -> DataFrame:
    """The D09 columns the pregnant/breastfeeding cohort (D10) reads - key,
    hash, pregnant, breastfeeding, LMP, gestation - for every live patient,
    without the groups that only repeat rows (weight, age, multi-month flag,
    adherence, care model, stability, family planning, WHO stage, TB). D10
    takes a DISTINCT over these values, so the set of rows it sees is the
    same as from the full D09."""
    sets = [g for g in _VISIT_SETS if g[0] in ("s_pregnant", "s_bf")]
    base = live(patients).select("patient_pk_hash", "patient_pk", "site_code")
    wide = base.join(last_visit_sets(last_visit_rows(visits, sets), sets), KEY, "left").drop("__date", "__id")
    out = expanded(wide, [name for name, *_ in sets])
    return out.select(
        "patient_pk_hash", "patient_pk", "site_code",
        F.col("s_pregnant.pregnant").alias("pregnant"),
        F.col("s_bf.breastfeeding").alias("breastfeeding"),
        F.col("s_bf.lmp").alias("lmp"),
        F.col("s_bf.gestation_age").alias("gestation_age"),
    )


def encounter_facts(patients: DataFrame, last_encounter: DataFrame) -> DataFrame:
    """Per key, from D06: the ages at the last encounter with their number of
    (encounter row, live patient row) pairs, and the distinct
    multi-month-dispensing flags (0 below 90 days between encounter and
    appointment, 1 from 90 days)."""
    enc = last_encounter.select(*KEY, "last_encounter_date", "next_appointment_date")
    dob = live(patients).select(*KEY, "dob", F.lit(True).alias("__pt"))
    # one pass over D06: count rows per (key, age, flag, has patient row); an
    # age then appears as (age, n) pairs whose n add up to its multiplicity,
    # so the per-key lists are bounded by distinct values, not by rows
    counted = enc.join(dob, KEY, "left").groupBy(
        *KEY,
        year_boundary_diff("dob", "last_encounter_date").alias("age_last_visit"),
        banded_days("last_encounter_date", "next_appointment_date").alias("on_mmd"),
        "__pt",
    ).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*KEY).agg(
        F.collect_list(F.when(F.col("__pt"), F.struct("age_last_visit", "n"))).alias("s_age"),
        F.collect_set(F.struct("on_mmd")).alias("s_mmd"),
    )


def latest_obs(patients: DataFrame, visits: DataFrame, ipt: DataFrame,
               last_encounter: DataFrame, weight_height: DataFrame, as_of) -> DataFrame:
    """D09. Each attribute group behaves like a left join of its rows: several
    distinct values at the last visit (or several encounter rows) give several
    output rows. Upstream D06 is consumed once."""
    a = AsOf.of(as_of)
    wh = weight_height.select("patient_pk_hash", "site_code", F.col("weight").alias("latest_weight"),
                              F.col("height").alias("latest_height"))
    base = live(patients).select("patient_pk_hash", "patient_pk", "site_code").join(wh, ["patient_pk_hash", "site_code"], "left")
    wide = base.join(encounter_facts(patients, last_encounter), KEY, "left")
    wide = _tb(wide.join(last_visit_sets(last_visit_rows(visits, _VISIT_SETS), _VISIT_SETS), KEY, "left"), ipt)
    out = expanded(wide, ["s_age", *[name for name, *_ in _VISIT_SETS], "s_mmd"], lambda age: age["n"].cast("double"))
    # an age seen n times gives n rows, as separate rows of the source would
    out = out.withColumn("__rep", F.explode_outer(F.array_repeat(F.lit(1), F.col("s_age.n").cast("int"))))
    return out.select(
        "patient_pk_hash", "patient_pk", "site_code", "latest_height", "latest_weight",
        F.col("s_age.age_last_visit").alias("age_last_visit"),
        F.col("s_adherence.adherence").alias("adherence"),
        F.col("s_dc.differentiated_care").alias("differentiated_care"),
        F.col("s_mmd.on_mmd").alias("on_mmd"),
        F.col("s_stability.stability_assessment").alias("stability_assessment"),
        F.col("s_pregnant.pregnant").alias("pregnant"),
        F.col("s_bf.breastfeeding").alias("breastfeeding"),
        F.col("s_bf.lmp").alias("lmp"),
        F.col("s_bf.gestation_age").alias("gestation_age"),
        F.col("s_who.who_stage").alias("who_stage"),
        F.col("s_tb.tb_screening").alias("tb_screening"),
        a.load_date(),
    )

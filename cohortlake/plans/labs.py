"""Laboratory datasets: baseline / latest / ordered viral loads (D11-D13),
viral loads at 6/12/18/24 months on treatment (D14), latest diabetes test (D15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions import below_or_in, decimal_text, range_by_family
from cohortlake.operators import first_per_key, latest_per_key, live, top_n_per_key
from cohortlake.params import AsOf
from cohortlake.plans import KEY
from cohortlake.sources.clustering import CLUSTERED, family

LAB_TIE = ["lab_id"]

# Results that count as suppressed although not numeric.
SUPPRESSED_WORDS = ["undetectable", "NOT DETECTED", "0 copies/ml", "LDL", "Less than Low Detectable Level"]
# Diabetes test families and their controlled ranges (low excl., high, high inclusive).
DIABETES_FAMILIES = [
    (["HgB", "HbsAg", "HBA1C"], 0.0, 6.5, True),
    (["FBS", "Blood Sugar"], 0.0, 7.0, False),
]
# Columns a viral load carries, in source order.
VL_COLUMNS = ["patient_id", "site_code", "patient_pk", "patient_pk_hash", "patient_id_hash", "visit_id",
              "ordered_by_date", "reported_by_date", "test_name", "test_result", "emr", "project"]


def viral_loads(labs: DataFrame) -> DataFrame:
    """Viral-load rows with a result; of clustered labs the reader skips the other families."""
    return labs.filter(family(labs, CLUSTERED["ct_patient_labs"], ["Viral Load"]) & F.col("test_result").isNotNull())


def baseline_viral_load(labs: DataFrame, as_of) -> DataFrame:
    """Earliest live viral load per key (a null order date counts as earliest)."""
    a = AsOf.of(as_of)
    top = first_per_key(live(viral_loads(labs)), KEY, "ordered_by_date", LAB_TIE, rank_col="rank")
    return top.select("rank", *VL_COLUMNS, a.load_date())


def latest_viral_load(labs: DataFrame, as_of) -> DataFrame:
    """Newest viral load per key. Soft-deleted rows are *not* excluded."""
    a = AsOf.of(as_of)
    top = latest_per_key(viral_loads(labs), KEY, "ordered_by_date", LAB_TIE, rank_col="rank")
    return top.select("rank", *VL_COLUMNS, "reason", a.load_date())


def ordered_viral_loads(labs: DataFrame, as_of, n: int = 10) -> DataFrame:
    """Newest ``n`` live viral loads per key, with their rank."""
    a = AsOf.of(as_of)
    top = top_n_per_key(live(viral_loads(labs)), KEY, "ordered_by_date", LAB_TIE, n=n, rank_col="rank")
    return top.select("rank", *VL_COLUMNS, "reason", a.load_date())


def viral_load_intervals(labs: DataFrame, art: DataFrame, as_of, months: Sequence[int] = (6, 12, 18, 24)) -> DataFrame:
    """Per patient with a live viral load and a live treatment record, the
    first result whose calendar month is exactly 6/12/18/24 months after the
    treatment start, with its date and suppressed flag (< 200 copies or a
    "not detected" word).

    The labs are read once: results are reduced to the first of each (key,
    patient id, calendar month) with a partial aggregation, and then to one row a client
    that holds these in an array (an element a month at most). A treatment row has all of its
    key's starts, so the join multiplies only the clients' rows; what it sends on are the
    few results of the asked months, and the flag is computed on those.
    """
    a = AsOf.of(as_of)
    month = lambda c: F.year(c) * 12 + F.month(c)
    first = F.min(F.struct(F.col("ordered_by_date").alias("at"), *[F.col(c).alias(f"tie_{c}") for c in LAB_TIE],
                           F.col("test_result").alias("result")))
    monthly = live(viral_loads(labs)).groupBy(*KEY, "patient_id", month("ordered_by_date").alias("__month")).agg(first.alias("__first"))
    clients = monthly.repartition(*KEY).groupBy(*KEY, "patient_id").agg(F.collect_list(F.struct("__month", "__first")).alias("__firsts"))
    of_key = Window.partitionBy(*KEY)
    tx = live(art).select(*KEY, "patient_pk_hash", "patient_id_hash", month("start_art_date").alias("__start")).distinct()
    tx = tx.select(*KEY, "patient_pk_hash", "patient_id_hash", F.sort_array(F.collect_set("__start").over(of_key)).alias("__starts")).distinct()

    def own(m):
        """A client's first result of the month that is ``m`` months after one of the key's starts."""
        met = F.filter("__firsts", lambda f: F.array_contains("__starts", f["__month"] - m))
        return F.array_min(F.transform(met, lambda f: f["__first"]))

    # a client's first results, then the key's: both on the one distribution by key
    client = ["patient_id", "patient_pk_hash", "patient_id_hash"]
    wide = clients.join(tx, KEY).select(*KEY, *client, *[own(m).alias(f"__own{m}") for m in months])
    wide = wide.select(*KEY, *client, *[F.min(f"__own{m}").over(of_key).alias(f"__m{m}") for m in months])
    values = []
    for m in months:
        result = F.col(f"__m{m}.result")
        values += [result.alias(f"vl_{m}_month"), F.col(f"__m{m}.at").alias(f"vl_{m}_month_date"),
                   F.when(F.col(f"__m{m}").isNotNull(), below_or_in(result, 200.0, SUPPRESSED_WORDS)).alias(f"vl_{m}_month_sup")]
    return wide.select("patient_pk", "patient_id", "site_code", "patient_pk_hash", "patient_id_hash", *values, a.load_date())


def latest_diabetes_test(labs: DataFrame, as_of=None) -> DataFrame:
    """Newest live diabetes-family test per (hash, site); screened flag;
    controlled flag by family range. No load date (as in the source)."""
    names = [n for fam, *_ in DIABETES_FAMILIES for n in fam]
    keys = ["patient_pk_hash", "site_code"]
    top = latest_per_key(live(labs).filter(family(labs, CLUSTERED["ct_patient_labs"], names)), keys, "ordered_by_date", LAB_TIE)
    value = decimal_text("test_result", 18, 2)
    key_ok = F.col("patient_pk_hash").isNotNull() & F.col("site_code").isNotNull()
    return top.select(
        "patient_pk_hash", "site_code", value.alias("numeric_test_result"), "test_name",
        F.when(F.col("patient_pk_hash").isNotNull(), 1).otherwise(0).alias("screened_diabetes"),
        F.when(key_ok & range_by_family("test_name", value, DIABETES_FAMILIES), 1).otherwise(0)
        .alias("is_diabetes_controlled_at_last_test"),
    )

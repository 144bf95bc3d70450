"""Last encounter per patient: as at the reporting month from visits and
dispenses (D05), and from dispenses, treatment records and visits (D06)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import day_diff, later_of, later_strict, plus_days, plus_days_if_null, repair_return_date
from cohortlake.operators import copied, dealt, full_merge, large_keys, latest_per_key, live
from cohortlake.params import AsOf
from cohortlake.plans import IDS, KEY
from cohortlake.plans.pharmacy import DISPENSE_TIE
from cohortlake.plans.visits import VISIT_TIE


def last_encounter_as_at(visit_as_at: DataFrame, dispense_as_at: DataFrame, as_of) -> DataFrame:
    """Full merge of D02 and D04 on the key. The encounter date is the
    visit date only when it is strictly later than the dispense (else null);
    the appointment is the later of the two, null-skipping."""
    a = AsOf.of(as_of)
    merged = full_merge(
        visit_as_at, dispense_as_at, KEY,
        coalesce={c: (c, c) for c in ["patient_id", "patient_pk_hash", "patient_id_hash"]},
        left_cols={"_v_date": "visit_date_as_at", "_v_appt": "appointment_date_as_at"},
        right_cols={"_d_date": "last_dispense_date", "_d_ret": "expected_return"},
    )
    return merged.select(
        *IDS,
        later_strict("_v_date", "_d_date").alias("encounter_date_as_at"),
        later_of("_v_appt", "_d_ret").alias("appointment_date_as_at"),
        a.load_date(),
    )


#: Treatment rows of a key up to which its pairs are built from one row of arrays.
ROWS_IN_PLACE = 64
#: Pairs that a share of a larger key builds, about.
PAIRS_A_SHARE = 100_000


def treatments(art: DataFrame) -> DataFrame:
    """Live treatment rows, each different one once, hash-distributed by the key.

    D06 and D07 read this one distribution. The distinct over all columns keeps
    filters and column pruning of the readers above the exchange, so that their
    plans share it (ReusedExchange). Rows without a key join nothing and go."""
    rows = live(art).filter(F.col("site_code").isNotNull() & F.col("patient_pk").isNotNull())
    return rows.select(*IDS, "start_art_date", "last_visit", "expected_return").repartition(*KEY).distinct()


def last_encounter(pharmacy: DataFrame, art: DataFrame, visits: DataFrame, as_of) -> DataFrame:
    """Per live treatment patient, the latest of (newest dispense, the
    treatment record's last visit, newest visit), each on or before the end of
    the previous month (cut, then rank), with the appointment repaired:
    dispense returns >= 365 d away, on 1900-01-01 or missing -> dispense + 30 d;
    visit appointment missing -> visit + 30 d; final appointment more than
    365 d after ``as_of`` or missing -> encounter + 30 d.

    The treatment record is joined twice on the key, as in the source rules, and
    the result is distinct: the first record gives an encounter and an appointment,
    the second one can only raise the encounter. So of a key's pairs only those count in
    which the second encounter is not before the first: a key's distinct encounters from
    the first one's on. Keys of at most ``ROWS_IN_PLACE`` rows expand in
    place; a larger key's appointments are dealt by hash to shares that each hold
    all its encounters, as many shares as its number of pairs asks for, so no task
    builds more than about ``PAIRS_A_SHARE`` of them.
    """
    a = AsOf.of(as_of)
    eopm = a.eopm_lit()
    ph = latest_per_key(
        live(pharmacy).filter(F.col("dispense_date") <= eopm), KEY, "dispense_date", DISPENSE_TIE
    ).select(
        *KEY,
        F.col("dispense_date").alias("ph_date"),
        repair_return_date("expected_return", "dispense_date").alias("ph_next"),
    )
    lv = latest_per_key(
        live(visits).filter(F.col("visit_date") <= eopm), KEY, "visit_date", VISIT_TIE
    ).select(
        *KEY,
        F.col("visit_date").alias("v_date"),
        plus_days_if_null("next_appointment_date", "visit_date").alias("v_next"),
    )
    tx = treatments(art)
    counted = F.col("last_visit") <= eopm
    booked = lambda next_raw: F.when(day_diff(a.lit(), next_raw) <= 365, next_raw)
    n = F.col("__n").cast("double")
    large = large_keys(tx.groupBy(*KEY).agg(F.count(F.when(counted, 1)).alias("__n")), KEY, n > ROWS_IN_PLACE, n * n / PAIRS_A_SHARE)

    def with_facts(rows: DataFrame) -> DataFrame:
        """What the key has without its treatment rows."""
        return rows.join(ph, KEY, "left").join(lv, KEY, "left").withColumns(
            {"__from_seen": later_of("ph_date", "v_date"), "__from_next": later_of("ph_next", "v_next")})

    def with_events(rows: DataFrame) -> DataFrame:
        """The encounter and the appointment that each treatment row gives, null if it does not count."""
        return rows.withColumns({
            "__own": F.struct(F.col("__from_seen").alias("seen"), booked(F.col("__from_next")).alias("booked")),
            "__seen": F.when(counted, F.greatest("__from_seen", "last_visit")),
            "__booked": F.when(counted, booked(F.greatest("__from_next", "expected_return"))),
        })

    def result(rows: DataFrame, seen, next_booked) -> DataFrame:
        out = rows.select(*IDS, seen.alias("last_encounter_date"), next_booked.alias("__booked"))
        return out.filter(F.col("last_encounter_date") <= eopm).select(
            *IDS, "last_encounter_date",
            F.coalesce("__booked", plus_days("last_encounter_date", 30)).alias("next_appointment_date"),
            a.load_date(),
        ).distinct()

    rest = [c for c in IDS if c not in KEY]
    event = F.struct(F.col("__seen").alias("seen"), F.col("__booked").alias("booked"))
    usual = with_events(with_facts(tx.join(large.select(*KEY), KEY, "left_anti"))).groupBy(*KEY).agg(
        F.collect_set(F.struct(*rest)).alias("__ids"), F.max("__own").alias("__own"),
        F.collect_set(F.when(counted, event)).alias("__events"),
    )
    usual = usual.withColumn("__id", F.explode("__ids")).withColumn("__first", F.explode_outer("__events"))
    later = F.array_distinct(F.transform("__events", lambda e: e["seen"]))
    usual = usual.withColumn("__last", F.explode_outer(F.filter(later, lambda d: d >= F.col("__first.seen"))))
    none = F.col("__first").isNull()
    usual = usual.select(*KEY, *[F.col(f"__id.{c}").alias(c) for c in rest], "__own", "__first", "__last")
    usual = result(usual, F.when(none, F.col("__own.seen")).otherwise(F.col("__last")),
                   F.when(none, F.col("__own.booked")).otherwise(F.col("__first.booked")))

    # one row per key; the distinct keeps column pruning above, so that all readers share the newest dispenses and visits
    facts = with_facts(large).select(*KEY, "__ways", "__from_seen", "__from_next").repartition(*KEY).distinct()
    many = with_events(tx.join(facts, KEY))
    first = many.groupBy(*KEY, "__ways", "__booked").agg(F.min("__seen").alias("__from")).filter(F.col("__from").isNotNull())
    seen = many.select(*KEY, "__ways", "__seen").distinct().filter(F.col("__seen").isNotNull())
    clients = tx.join(large, KEY).select(*IDS, "__ways").distinct()
    cell = [*KEY, "__share"]
    pairs = dealt(first, KEY, ["__booked"]).join(copied(seen, KEY), cell).filter(F.col("__seen") >= F.col("__from"))
    pairs = pairs.join(copied(clients, KEY), cell)
    return usual.unionByName(result(pairs, F.col("__seen"), F.col("__booked")))

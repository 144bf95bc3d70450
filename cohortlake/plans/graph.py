"""The 23 datasets wired together in dependency order.

``DatasetGraph(tables, as_of)`` exposes every dataset as a lazy DataFrame;
upstream datasets (D01, D02, D04, D06, D08, D09) are shared, so a chain like
D01/D06/D08 -> D09 -> D10 is one plan. ``tables`` is anything with the
clinical tables as attributes (the fixture adapter, or a catalog reader).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from cohortlake.params import AsOf
from cohortlake.plans import encounter, hts_prep, labs, obs, outcomes, pbfw, pharmacy, pregnancy, programmes, visit_pass, visits

# Dataset id -> (name, upstream dataset ids). Order is a valid build order.
DATASETS: dict[str, tuple[str, tuple[str, ...]]] = {
    "d01": ("last_visit", ()),
    "d02": ("last_visit_as_at", ()),
    "d03": ("last_dispense", ()),
    "d04": ("dispense_as_at", ()),
    "d05": ("last_encounter_as_at", ("d02", "d04")),
    "d06": ("last_encounter", ()),
    "d07": ("art_outcomes", ("d06",)),
    "d08": ("latest_weight_height", ()),
    "d09": ("latest_obs", ("d06", "d08")),
    "d10": ("pbfw", ("d09", "d01")),
    "d11": ("baseline_viral_load", ()),
    "d12": ("latest_viral_load", ()),
    "d13": ("ordered_viral_loads", ()),
    "d14": ("viral_load_intervals", ()),
    "d15": ("latest_diabetes_test", ()),
    "d16": ("pregnancy_at_initiation", ()),
    "d17": ("pregnancy_during_art", ()),
    "d18": ("last_otz_visit", ()),
    "d19": ("last_ovc_visit", ()),
    "d20": ("encounter_hts_tests", ()),
    "d21": ("prep_last_visit", ()),
    "d22": ("latest_prep_assessment", ()),
    "d23": ("prep_refills", ()),
}


def query_name(ds_id: str) -> str:
    return f"{ds_id}_{DATASETS[ds_id][0]}"


class DatasetGraph:
    def __init__(self, tables, as_of, overrides: dict[str, DataFrame] | None = None, visit_candidates: DataFrame | None = None):
        """``visit_candidates``: the written result of ``visit_pass.candidates``, read instead of the visits
        where a dataset reduces them per key."""
        self.t = tables
        self.as_of = AsOf.of(as_of)
        self._over = overrides or {}
        self._candidates = visit_candidates

    def _visits(self, *kinds: str) -> DataFrame:
        """The clinical visits, or the candidates of these kinds where there are any."""
        if self._candidates is None:
            return self.t.ct_patient_visits
        return visit_pass.of_kind(self._candidates, *kinds)

    def get(self, ds_id: str) -> DataFrame:
        if ds_id in self._over:
            return self._over[ds_id]
        return getattr(self, ds_id)

    @cached_property
    def d01(self):
        return visits.last_visit(self._visits("newest"), self.as_of)

    @cached_property
    def d02(self):
        return visits.last_visit_as_at(self._visits("newest"), self.as_of)

    @cached_property
    def d03(self):
        return pharmacy.last_dispense(self.t.ct_patient_pharmacy, self.as_of)

    @cached_property
    def d04(self):
        return pharmacy.dispense_as_at(self.t.ct_patient_pharmacy, self.as_of)

    @cached_property
    def d05(self):
        return encounter.last_encounter_as_at(self.get("d02"), self.get("d04"), self.as_of)

    @cached_property
    def d06(self):
        t = self.t
        return encounter.last_encounter(t.ct_patient_pharmacy, t.ct_art_patients, self._visits("newest_to_month_end"), self.as_of)

    @cached_property
    def d07(self):
        t = self.t
        return outcomes.art_outcomes(t.ct_patient, t.ct_art_patients, self.get("d06"), t.ct_patient_status,
                                     t.ct_facility_manifest, t.ct_patient_visits, self.as_of)

    @cached_property
    def d08(self):
        return visits.latest_weight_height(self._visits("newest_weighed"), self.as_of)

    @cached_property
    def d09(self):
        t = self.t
        return obs.latest_obs(t.ct_patient, self._visits("newest"), t.ct_ipt, self.get("d06"), self.get("d08"),
                              self.as_of)

    @cached_property
    def d10(self):
        t = self.t
        # a materialised D09 is read as is; otherwise only the D09 columns D10
        # uses are computed (same distinct rows, far less work)
        src = self._over.get("d09")
        if src is None:
            src = obs.pregnancy_obs(t.ct_patient, self._visits("newest"))
        first = self._visits("first_pregnant", "first_pregnant_or_breastfeeding")
        return pbfw.pbfw(src, t.ct_art_patients, t.ct_patient, self.get("d01"), first,
                         t.mnch_anc_visits, t.mnch_pnc_visits, t.mnch_mat_visits, t.mnch_arts, t.mnch_enrolments,
                         self.as_of)

    @cached_property
    def d11(self):
        return labs.baseline_viral_load(self.t.ct_patient_labs, self.as_of)

    @cached_property
    def d12(self):
        return labs.latest_viral_load(self.t.ct_patient_labs, self.as_of)

    @cached_property
    def d13(self):
        return labs.ordered_viral_loads(self.t.ct_patient_labs, self.as_of)

    @cached_property
    def d14(self):
        return labs.viral_load_intervals(self.t.ct_patient_labs, self.t.ct_art_patients, self.as_of)

    @cached_property
    def d15(self):
        return labs.latest_diabetes_test(self.t.ct_patient_labs, self.as_of)

    @cached_property
    def d16(self):
        t = self.t
        return pregnancy.pregnancy_at_initiation(self._visits("first_pregnant_live"), t.ct_patient, t.ct_art_patients, self.as_of)

    @cached_property
    def d17(self):
        t = self.t
        return pregnancy.pregnancy_during_art(self._visits("first_pregnant_live"), t.ct_patient, t.ct_art_patients, self.as_of)

    @cached_property
    def d18(self):
        return programmes.last_otz_visit(self.t.ct_otz, self.as_of)

    @cached_property
    def d19(self):
        return programmes.last_ovc_visit(self.t.ct_ovc, self.as_of)

    @cached_property
    def d20(self):
        return hts_prep.encounter_hts_tests(self.t.hts_client_tests, self.as_of)

    @cached_property
    def d21(self):
        return hts_prep.prep_last_visit(self.t.prep_visits, self.as_of)

    @cached_property
    def d22(self):
        return hts_prep.latest_prep_assessment(self.t.prep_behaviour_risk, self.as_of)

    @cached_property
    def d23(self):
        t = self.t
        return hts_prep.prep_refills(t.prep_patient, t.prep_pharmacy, t.hts_client_tests, self.as_of)

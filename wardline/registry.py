"""Declarative description of the clinical tables: one TableSpec drives every stage."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    """What the stages need to know of a table; any table of persons, concepts and times can be described so."""

    name: str
    id: str
    keys: tuple[str, ...]
    required: tuple[str, ...]
    concept: str | None = None
    validity: str | None = None
    start: str | None = None
    end: str | None = None
    mapped: bool = False
    event_time: str | None = None
    person: str = "person_id"

    @property
    def dates(self) -> tuple[str, ...]:
        """Names of the date and datetime columns that follow the table's naming convention."""
        stem = {"VISIT_OCCURRENCE": "visit", "VISIT_DETAIL": "visit_detail", "CONDITION_OCCURRENCE": "condition", "PROCEDURE_OCCURRENCE": "procedure"}.get(self.name, self.name.lower())
        if self.name in ("MEASUREMENT", "OBSERVATION", "SPECIMEN", "DEATH"):
            return (f"{stem}_date", f"{stem}_datetime")
        if self.name == "PROCEDURE_OCCURRENCE":
            return ("procedure_date", "procedure_datetime", "procedure_end_datetime")
        if self.name.endswith("_ERA") or self.name == "OBSERVATION_PERIOD":
            return (f"{stem}_start_date", f"{stem}_end_date")
        if self.name == "PERSON":
            return ()
        return tuple(f"{stem}_{side}_{kind}" for side in ("start", "end") for kind in ("date", "datetime"))


def _event(name: str, concept: str, time: str, end: str | None = None, mapped: bool = False, required: tuple[str, ...] = ()) -> TableSpec:
    """A table of person, concept and time, keyed by the three."""
    ident = f"{name.lower()}_id"
    return TableSpec(name, ident, ("person_id", concept, time), required or (ident, "person_id", concept), concept, concept, time if end else None, end, mapped, time)


#: The table layout of the common data model.
TABLES = {
    s.name: s
    for s in [
        _event("MEASUREMENT", "measurement_concept_id", "measurement_datetime", None, True, ("measurement_id", "person_id", "measurement_concept_id", "measurement_date")),
        _event("OBSERVATION", "observation_concept_id", "observation_datetime", None, True, ("observation_id", "person_id", "observation_concept_id", "observation_date")),
        _event("DRUG_EXPOSURE", "drug_concept_id", "drug_exposure_start_datetime", "drug_exposure_end_datetime", False, ("drug_exposure_id", "person_id", "drug_concept_id", "drug_exposure_start_date")),
        _event("CONDITION_OCCURRENCE", "condition_concept_id", "condition_start_datetime", "condition_end_datetime", False, ("condition_occurrence_id", "person_id", "condition_concept_id", "condition_start_date")),
        _event("PROCEDURE_OCCURRENCE", "procedure_concept_id", "procedure_datetime", "procedure_end_datetime", True, ("procedure_occurrence_id", "person_id", "procedure_concept_id", "procedure_date")),
        _event("VISIT_OCCURRENCE", "visit_concept_id", "visit_start_datetime", "visit_end_datetime", False, ("visit_occurrence_id", "person_id", "visit_concept_id", "visit_start_date", "visit_end_date")),
        _event("VISIT_DETAIL", "visit_detail_concept_id", "visit_detail_start_datetime", "visit_detail_end_datetime"),
        _event("DEVICE_EXPOSURE", "device_concept_id", "device_exposure_start_datetime", "device_exposure_end_datetime", True, ("device_exposure_id", "person_id", "device_concept_id", "device_exposure_start_date")),
        _event("CONDITION_ERA", "condition_concept_id", "condition_era_start_date", "condition_era_end_date"),
        _event("DRUG_ERA", "drug_concept_id", "drug_era_start_date", "drug_era_end_date"),
        TableSpec("OBSERVATION_PERIOD", "observation_period_id", ("person_id", "observation_period_start_date"), ("observation_period_id", "person_id"), None, "period_type_concept_id", "observation_period_start_date", "observation_period_end_date"),
        TableSpec("SPECIMEN", "specimen_id", ("specimen_id",), ("specimen_id", "person_id", "specimen_concept_id"), "specimen_concept_id", "specimen_concept_id", event_time="specimen_datetime"),
        TableSpec("DEATH", "person_id", ("person_id",), ("person_id", "death_date"), None, "death_datetime"),
        TableSpec("PERSON", "person_id", ("person_id",), ("person_id", "gender_concept_id", "year_of_birth", "race_concept_id", "ethnicity_concept_id")),
    ]
}
OPTIONAL_TABLES = ("LOCATION", "PROVIDER", "CARE_SITE")

#: Thresholds of the stages.
MAX_NULL_PERCENT, MIN_FREQUENCY, MIN_VALUES, PERCENTILE, MERGE_MINUTES, SAMPLE_SIZE, SEED = 95.0, 10, 10, 99.0, 60.0, 1000, 42
#: Plausible ranges by concept (name, least, most, unit).
PLAUSIBLE_RANGES = {
    4151414: ("glucose_urine", 0.0, 500.0, "mg/dL"),
    4018317: ("glucose_serum", 0.0, 500.0, "mg/dL"),
    3020891: ("temperature", 35.0, 42.0, "C"),
    37174455: ("weight", 0.5, 300.0, "kg"),
    4212065: ("ESR", 0.0, 150.0, "mm/hr"),
    4324383: ("creatinine", 0.0, 20.0, "mg/dL"),
    4097430: ("sodium", 110.0, 170.0, "mEq/L"),
    4245152: ("potassium", 2.0, 8.0, "mEq/L"),
    3036277: ("height", 30.0, 250.0, "cm"),
}
#: Unit conversions (concept, from, to, factor, offset): to = (from + offset) * factor.
CONVERSIONS = [
    (4151414, "mmol/L", "mg/dL", 18.0182, 0.0),
    (4018317, "mmol/L", "mg/dL", 18.0182, 0.0),
    (3020891, "Fahrenheit", "Celsius", 5.0 / 9.0, -32.0),
    (37174455, "lb", "kg", 0.453592, 0.0),
    (37174455, "lbs", "kg", 0.453592, 0.0),
    (3036277, "in", "cm", 2.54, 0.0),
    (3036277, "inch", "cm", 2.54, 0.0),
]
#: Index concepts, labels of codes, and the tables that are pooled before the index time.
ICU_CONCEPTS = (581379, 32037)
GENDER = {8507: "Male", 8532: "Female"}
RACE = {8527: "White", 8516: "Black", 8515: "Asian", 8657: "Native American", 8557: "Pacific Islander", 0: "Unknown"}
VISIT_TYPE = {9201: "Inpatient", 9202: "Outpatient", 9203: "Emergency", 32037: "ICU", 581379: "ICU Admission"}
PRE_INDEX_TABLES = {"CONDITION_ERA": "condition_era_start_date", "DEVICE_EXPOSURE": "device_exposure_start_datetime", "DRUG_ERA": "drug_era_start_date"}
#: Edges of the age and stay histograms, and the tables of the completeness matrix.
AGE_EDGES = (0, 18, 35, 50, 65, 80, 120)
STAY_EDGES = (0, 1, 3, 7, 14, 30, 90, 365)
COMPLETENESS_TABLES = ("VISIT_OCCURRENCE", "CONDITION_OCCURRENCE", "DRUG_EXPOSURE", "MEASUREMENT", "PROCEDURE_OCCURRENCE", "OBSERVATION")
#: Class and domain that mapped rows get, by table.
MAPPED_CLASS = {"MEASUREMENT": ("Clinical Observation", "Measurement"), "OBSERVATION": ("Clinical Observation", "Observation"), "PROCEDURE_OCCURRENCE": ("Procedure", "Procedure"), "DEVICE_EXPOSURE": ("Procedure", "Procedure")}

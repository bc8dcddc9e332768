"""The derived tables: each is a function of its input frames.

A node that depends on the current day is split in two: the stored part holds only facts, and a view adds the
day-dependent columns when it is read, so stored tables do not age. The plain functions compose both.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.dates import as_date, day_boundaries, year_boundaries
from wardflow.functions.flags import range_flag
from wardflow.functions.text import initcap_words

AsOf = dt.date | str | Column | None
# Columns that say where a stored row lives; nodes that keep rows apart hand them on where they are present.
STORAGE = ("bucket", "slice")


# --- curated ---------------------------------------------------------------------------------------------------------


def dim_patient_stored(raw: DataFrame) -> DataFrame:
    return raw.select(
        "pat_id",
        "pat_mrn",
        initcap_words(F.col("pat_first_name")).alias("first_name"),
        initcap_words(F.col("pat_last_name")).alias("last_name"),
        "birth_date",
        *["ssn", "address_line_1", "city", "state", "zip_code", "phone", "email", "prim_language", "gender"],
        F.col("load_ts").alias("source_loaded_at"),
        *_storage_of(raw),
    )


def dim_patient_view(stored: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _insert_after(stored, "birth_date", age=year_boundaries(F.col("birth_date"), as_date(as_of)))


def dim_patient(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Patients with clean names and an age counted in calendar years."""
    return dim_patient_view(dim_patient_stored(raw), as_of)


def dim_provider(raw: DataFrame) -> DataFrame:
    return raw.select("prov_id", "prov_name", "specialty", "department", "npi", "active", *_storage_of(raw))


def fact_encounter_stored(encounters: DataFrame, providers: DataFrame) -> DataFrame:
    """Encounters with the name and specialty of the attending provider; unknown providers leave NULL."""
    p = providers.select(
        F.col("prov_id").alias("_prov_id"),
        F.col("prov_name").alias("attending_provider"),
        F.col("specialty").alias("provider_specialty"),
    )
    return encounters.join(p, F.col("attending_prov_id") == F.col("_prov_id"), "left").select(
        *["encounter_id", "pat_id", "encounter_type", "admit_date", "discharge_date", "department"],
        *["attending_prov_id", "attending_provider", "provider_specialty"],
        *["primary_dx_code", "primary_dx_name", "encounter_status", "total_charges"],
        F.col("load_ts").alias("source_loaded_at"),
        *_storage_of(encounters),
    )


def fact_encounter_view(stored: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _insert_after(stored, "discharge_date", length_of_stay=_length_of_stay(as_of))


def fact_encounter(encounters: DataFrame, providers: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Encounters with provider and length of stay in days; an open stay counts up to the given day."""
    return fact_encounter_view(fact_encounter_stored(encounters, providers), as_of)


def _length_of_stay(as_of: AsOf) -> Column:
    return day_boundaries(F.col("admit_date"), F.coalesce(F.col("discharge_date"), as_date(as_of)))


def fact_lab_results(labs: DataFrame) -> DataFrame:
    flag = range_flag(F.col("result_value"), F.col("reference_low"), F.col("reference_high"))
    return labs.select(
        *["result_id", "encounter_id", "pat_id", "test_code", "test_name", "result_value", "result_unit"],
        *["reference_low", "reference_high"],
        flag.alias("abnormal_flag"),
        "result_date",
        *_storage_of(labs),
    )


# --- gold ------------------------------------------------------------------------------------------------------------


def patient_encounter_summary_stored(patients: DataFrame, encounters: DataFrame) -> DataFrame:
    """Per patient: encounter counts, charges, last visit and departments.

    Encounters are reduced to one row per patient before the join (combined on the map side, so a patient with very
    many encounters does not load one task), and equal patient rows are counted instead of multiplied.
    """
    type_ = F.col("encounter_type")
    per_patient = encounters.groupBy(F.col("pat_id").alias("_pat_id")).agg(
        F.count("encounter_id").alias("n"),
        F.count_if(type_ == "Inpatient").alias("inpatient"),
        F.count_if(type_ == "Emergency").alias("emergency"),
        F.sum("total_charges").alias("charges"),
        F.max("admit_date").alias("last_visit_date"),
        F.collect_set("department").alias("departments"),
    )
    return _summarized(patients, per_patient)


def patient_encounter_summary_merged(patients: DataFrame, partials: DataFrame) -> DataFrame:
    """The same summary from partial rows (see ``encounter_partials``)."""
    per_patient = partials.groupBy(F.col("pat_id").alias("_pat_id")).agg(
        *[F.sum(c).alias(c) for c in ("n", "inpatient", "emergency")],
        F.sum("charges").cast("decimal(22,2)").alias("charges"),
        F.max("last_visit_date").alias("last_visit_date"),
        F.collect_set("department").alias("departments"),
    )
    return _summarized(patients, per_patient)


def _summarized(patients: DataFrame, per_patient: DataFrame) -> DataFrame:
    who = ["pat_id", "pat_mrn", "first_name", "last_name", "gender"]
    people = patients.groupBy(*who, F.year("birth_date").alias("birth_year")).agg(F.count("*").alias("copies"))
    times = F.col("copies").cast("decimal(15,0)")
    return people.join(per_patient, F.col("pat_id") == F.col("_pat_id"), "left").select(
        "pat_id",
        "pat_mrn",
        F.concat("first_name", F.lit(" "), "last_name").alias("patient_name"),
        "birth_year",
        "gender",
        (F.coalesce("n", F.lit(0)) * F.col("copies")).alias("total_encounters"),
        (F.coalesce("inpatient", F.lit(0)) * F.col("copies")).alias("inpatient_count"),
        (F.coalesce("emergency", F.lit(0)) * F.col("copies")).alias("ed_visits"),
        (F.col("charges") * times).cast("decimal(22,2)").alias("total_charges"),
        "last_visit_date",
        F.coalesce(F.array_join(F.sort_array("departments"), ", "), F.lit("")).alias("departments_seen"),
    )


def patient_encounter_summary_view(stored: DataFrame, as_of: AsOf = None) -> DataFrame:
    age = F.year(as_date(as_of)) - F.col("birth_year")
    return stored.select(*[age.alias("age") if c == "birth_year" else F.col(c) for c in stored.columns])


def patient_encounter_summary(patients: DataFrame, encounters: DataFrame, as_of: AsOf = None) -> DataFrame:
    return patient_encounter_summary_view(patient_encounter_summary_stored(patients, encounters), as_of)


def department_dashboard(encounters: DataFrame) -> DataFrame:
    """Activity per department over encounters that carry length_of_stay.

    The two distinct counts are planned by Spark on (department, value), so a department holding most of the rows is
    still spread over all tasks; the other measures are combined on the map side.
    """
    type_ = F.col("encounter_type")
    return encounters.groupBy("department").agg(
        F.count_distinct("encounter_id").alias("encounter_count"),
        F.count_distinct("pat_id").alias("unique_patients"),
        F.count_if(type_ == "Inpatient").alias("inpatient_count"),
        F.count_if(type_ == "Emergency").alias("ed_count"),
        F.avg("length_of_stay").alias("avg_los"),
        F.sum("total_charges").alias("total_charges"),
        F.avg("total_charges").alias("avg_charges"),
    )


def encounter_partials(encounters: DataFrame, by: Sequence[str] = ("bucket", "slice")) -> DataFrame:
    """Encounters reduced to one row per patient and department within a storage cell, free of the current day.

    All measures can be merged, so a patient with very many encounters costs one row per cell in every later step.
    """
    type_, open_ = F.col("encounter_type"), F.col("discharge_date").isNull()
    stay = day_boundaries(F.col("admit_date"), F.col("discharge_date")).cast("bigint")
    admit_day = F.unix_date("admit_date").cast("bigint")
    return encounters.groupBy(*by, "pat_id", "department").agg(
        F.count("encounter_id").alias("n"),
        F.count_if(type_ == "Inpatient").alias("inpatient"),
        F.count_if(type_ == "Emergency").alias("emergency"),
        F.sum("total_charges").alias("charges"),
        F.count("total_charges").alias("charged"),
        F.max("admit_date").alias("last_visit_date"),
        F.sum(stay).alias("closed_days"),
        F.count(stay).alias("closed_stays"),
        F.sum(F.when(open_, admit_day)).alias("open_admit_days"),
        F.count(F.when(open_, admit_day)).alias("open_stays"),
    )


def merged_partials(partials: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partial rows of several cells as one row per patient and department; merging merged rows gives the same again."""
    kept = {*by, "pat_id", "department", "slice"}
    merged = [(F.max if c == "last_visit_date" else F.sum)(c).cast(t.dataType).alias(c) for c, t in ((f.name, f) for f in partials.schema) if c not in kept]
    return partials.groupBy(*by, "pat_id", "department").agg(*merged)


_ADDED = ("inpatient", "emergency", "charged", "closed_days", "closed_stays", "open_admit_days", "open_stays")


def _department_totals() -> list[Column]:
    return [
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _ADDED],
        F.sum("charges").cast("decimal(22,2)").alias("charges"),
    ]


def department_partials(partials: DataFrame, by: Sequence[str] = ("bucket", "department")) -> DataFrame:
    """Dashboard measures per bucket and department. A patient lives in one bucket, so patients add up over buckets."""
    return partials.groupBy(*by).agg(F.count_distinct("pat_id").alias("unique_patients"), *_department_totals())


# Registers of the sketches, as a power of two: estimates are off by 0.8 % as a rule, by ``SKETCH_BOUND`` hardly ever.
SKETCH_LG = 14
SKETCH_BOUND = 3 * 1.04 / 2 ** (SKETCH_LG / 2)
_SKETCHES = {"encounters": "encounter_id", "patients": "pat_id"}


def department_sketches(encounters: DataFrame, by: Sequence[str] = ("bucket", "slice")) -> DataFrame:
    """Distinct encounters and patients per department and cell as sketches, which merge without a look at old rows."""
    made = [F.hll_sketch_agg(column, SKETCH_LG).alias(name) for name, column in _SKETCHES.items()]
    return encounters.groupBy(*by, "department").agg(*made)


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ("bucket",)) -> DataFrame:
    return sketches.groupBy(*by, "department").agg(*[F.hll_union_agg(name).alias(name) for name in _SKETCHES])


def department_estimates_stored(totals: DataFrame) -> DataFrame:
    return merged_sketches(totals, ())


def department_estimates_view(stored: DataFrame, as_of: AsOf = None) -> DataFrame:
    """About how many distinct encounters and patients each department has."""
    estimates = {"encounter_estimate": "encounters", "patient_estimate": "patients"}
    return stored.select("department", *[F.hll_sketch_estimate(c).alias(name) for name, c in estimates.items()])


def department_encounter_counts(encounters: DataFrame, by: Sequence[str] = ("bucket", "department")) -> DataFrame:
    """Distinct encounters per department over a copy stored by encounter id, so the counts add up over buckets."""
    return encounters.groupBy(*by).agg(F.count_distinct("encounter_id").alias("encounter_count"))


def department_dashboard_stored(partials: DataFrame, encounter_counts: DataFrame) -> DataFrame:
    """The dashboard from its partial rows (one per bucket and department)."""
    totals = partials.groupBy("department").agg(
        F.sum("unique_patients").alias("unique_patients"), *_department_totals()
    )
    counts = encounter_counts.groupBy(F.col("department").alias("_department")).agg(
        F.sum("encounter_count").alias("encounter_count")
    )
    # The copy by encounter id may be behind or ahead for a while; a department seen on one side only is shown as well.
    both = totals.join(counts, F.col("department").eqNullSafe(F.col("_department")), "full")
    counted = [F.coalesce(c, F.lit(0)).alias(c) if c in ("unique_patients", "encounter_count", *_ADDED) else F.col(c) for c in both.columns]
    name = F.coalesce("department", "_department").alias("department")
    return both.select(*counted).select(name, *[c for c in both.columns if c not in ("department", "_department")])


def department_dashboard_view(stored: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Averages worked out for a given day; open stays reach up to it."""
    open_days = F.col("open_stays") * F.unix_date(as_date(as_of)) - F.col("open_admit_days")
    stays = F.col("closed_stays") + F.col("open_stays")
    avg_los = F.when(stays > 0, (F.col("closed_days") + open_days).cast("double") / stays)
    avg_charges = F.when(F.col("charged") > 0, F.col("charges") / F.col("charged").cast("decimal(15,0)"))
    return stored.select(
        *["department", "encounter_count", "unique_patients"],
        F.col("inpatient").alias("inpatient_count"),
        F.col("emergency").alias("ed_count"),
        avg_los.alias("avg_los"),
        F.col("charges").alias("total_charges"),
        avg_charges.cast("decimal(16,6)").alias("avg_charges"),
    )


def abnormal_results(labs: DataFrame, encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """Abnormal lab results with patient name, department and provider; normal rows are dropped before the joins."""
    e = encounters.select(F.col("encounter_id").alias("_encounter_id"), "department", "attending_provider")
    name = F.concat("first_name", F.lit(" "), "last_name")
    p = patients.select(F.col("pat_id").alias("_pat_id"), name.alias("patient_name"))
    return (
        labs.where(F.col("abnormal_flag") != "NORMAL")
        .join(e, F.col("encounter_id") == F.col("_encounter_id"))
        .join(p, F.col("pat_id") == F.col("_pat_id"))
        .select(
            *["pat_id", "patient_name", "test_name", "result_value", "result_unit", "reference_high"],
            *["abnormal_flag", "result_date", "department", "attending_provider"],
            *_storage_of(labs),
        )
    )


def department_rollup(encounters: DataFrame) -> DataFrame:
    """The department figures published for other engines, straight from raw encounters."""
    return encounters.groupBy("department").agg(
        F.count_distinct("encounter_id").alias("encounter_count"),
        F.count_distinct("pat_id").alias("unique_patients"),
        F.avg("total_charges").alias("avg_charges"),
        F.sum("total_charges").alias("total_charges"),
    )


def _storage_of(df: DataFrame) -> list[str]:
    return [c for c in STORAGE if c in df.columns]


def _insert_after(df: DataFrame, column: str, **added: Column) -> DataFrame:
    out: list[Column] = []
    for name in df.columns:
        out.append(F.col(name))
        if name == column:
            out.extend(value.alias(alias) for alias, value in added.items())
    return df.select(*out)

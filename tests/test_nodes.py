import datetime as dt
from decimal import Decimal as D

import pytest
from clinic import AS_OF, LATE_ENCOUNTERS, LATE_PATIENTS, encounters, patients, rows

from wardflow.operators.counts import layer_counts
from wardflow.plans import nodes


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def built(clinic):
    dim = nodes.dim_patient(clinic["patients"], AS_OF)
    fact = nodes.fact_encounter(clinic["encounters"], clinic["providers"], AS_OF)
    labs = nodes.fact_lab_results(clinic["labs"])
    return dim, fact, labs


def test_seed_counts(clinic):
    tables = {k: clinic[k] for k in ("patients", "encounters", "labs", "providers")}
    assert rows(layer_counts(tables, "tbl")) == [("encounters", 10), ("labs", 10), ("patients", 8), ("providers", 8)]


def test_dim_patient(built):
    got = by_key(built[0], "pat_id")
    assert got["P100005"]["last_name"] == "Al-Hassan"
    assert got["P100001"]["age"] == 59  # 2024 - 1965, whatever the birthday
    assert built[0].columns[:7] == ["pat_id", "pat_mrn", "first_name", "last_name", "birth_date", "age", "ssn"]


def test_fact_encounter(built, clinic):
    got = by_key(built[1], "encounter_id")
    assert got["E200002"]["length_of_stay"] == 54 and got["E200001"]["length_of_stay"] == 4
    assert got["E200003"]["attending_provider"] == "Dr. Lisa Park"
    few = clinic["providers"].where("prov_id = 'PROV-001'")
    unmatched = by_key(nodes.fact_encounter(clinic["encounters"], few, AS_OF), "encounter_id")
    assert len(unmatched) == 10 and unmatched["E200003"]["attending_provider"] is None


def test_lab_flags(built):
    got = dict(rows(built[2], "result_id", "abnormal_flag"))
    assert {k for k, v in got.items() if v == "HIGH"} == {"R001", "R002", "R003", "R005", "R007", "R008"}
    assert {k for k, v in got.items() if v == "LOW"} == {"R004", "R006"}
    assert {k for k, v in got.items() if v == "NORMAL"} == {"R009", "R010"}


SUMMARY = {
    "P100001": (2, 1, 0, D("45475.00"), dt.date(2024, 10, 1), "Cardiology"),
    "P100002": (2, 1, 0, D("29050.00"), dt.date(2024, 10, 18), "Nephrology, Primary Care"),
    "P100003": (1, 0, 1, D("8900.00"), dt.date(2024, 9, 15), "Emergency Dept"),
    "P100004": (1, 1, 0, D("72500.00"), dt.date(2024, 9, 20), "Oncology"),
    "P100005": (1, 0, 0, D("425.00"), dt.date(2024, 10, 5), "OB/GYN"),
    "P100006": (1, 1, 0, D("38900.00"), dt.date(2024, 10, 10), "Orthopedics"),
    "P100007": (1, 0, 1, D("2100.00"), dt.date(2024, 10, 12), "Emergency Dept"),
    "P100008": (1, 0, 0, D("310.00"), dt.date(2024, 10, 15), "Behavioral Health"),
}
LATE_SUMMARY = {"P100009": (1, 0, 1, D("3200.00"), dt.date(2024, 10, 25), "Emergency Dept")}
SUMMARY_COLUMNS = [
    "pat_id", "total_encounters", "inpatient_count", "ed_visits", "total_charges", "last_visit_date", "departments_seen",
]


def summary_of(df):
    return {r[0]: r[1:] for r in rows(df, *SUMMARY_COLUMNS)}


def test_patient_summary(built):
    out = nodes.patient_encounter_summary(built[0], built[1], AS_OF)
    assert summary_of(out) == SUMMARY
    assert by_key(out, "pat_id")["P100001"]["patient_name"] == "Maria Santos"
    assert by_key(out, "pat_id")["P100001"]["age"] == 59


def test_patient_summary_without_encounters(built, spark):
    people = built[0].unionByName(nodes.dim_patient(patients(spark, LATE_PATIENTS), AS_OF))
    got = summary_of(nodes.patient_encounter_summary(people, built[1], AS_OF))
    assert got["P100009"] == (0, 0, 0, None, None, "")


def test_patient_summary_of_equal_patient_rows(built):
    """Two equal patient rows fall into one group whose encounters count twice, as a join before grouping gives."""
    got = summary_of(nodes.patient_encounter_summary(built[0].unionByName(built[0]), built[1], AS_OF))
    assert got["P100002"] == (4, 2, 0, D("58100.00"), dt.date(2024, 10, 18), "Nephrology, Primary Care")


DASHBOARD = {
    "Behavioral Health": (1, 1, 0, 0, 10.0, D("310.00"), D("310.000000")),
    "Cardiology": (2, 1, 1, 0, 14.0, D("45475.00"), D("22737.500000")),
    "Emergency Dept": (2, 2, 0, 2, 0.0, D("11000.00"), D("5500.000000")),
    "Nephrology": (1, 1, 1, 0, 4.0, D("28700.00"), D("28700.000000")),
    "OB/GYN": (1, 1, 0, 0, 20.0, D("425.00"), D("425.000000")),
    "Oncology": (1, 1, 1, 0, 8.0, D("72500.00"), D("72500.000000")),
    "Orthopedics": (1, 1, 1, 0, 2.0, D("38900.00"), D("38900.000000")),
    "Primary Care": (1, 1, 0, 0, 54.0, D("350.00"), D("350.000000")),
}
LATE_DASHBOARD = {"Emergency Dept": (3, 3, 0, 3, 0.0, D("14200.00"), D("4733.333333"))}


def dashboard_of(df):
    return {r[0]: r[1:] for r in rows(df)}


def test_department_dashboard(built, spark, clinic):
    assert dashboard_of(nodes.department_dashboard(built[1])) == DASHBOARD
    late = clinic["encounters"].unionByName(encounters(spark, LATE_ENCOUNTERS))
    fact = nodes.fact_encounter(late, clinic["providers"], AS_OF)
    assert dashboard_of(nodes.department_dashboard(fact)) == {**DASHBOARD, **LATE_DASHBOARD}


def test_gold_from_partials_equals_direct(built):
    number = lambda c: c.substr(7, 1).cast("int")
    fact = built[1].withColumns({"bucket": number(built[1].pat_id) % 3, "slice": number(built[1].encounter_id) % 2})
    keys = built[1].withColumn("bucket", number(built[1].encounter_id) % 2)
    partials = nodes.encounter_partials(fact)
    counts = nodes.department_encounter_counts(keys)
    stored = nodes.department_dashboard_stored(nodes.department_partials(partials), counts)
    assert dashboard_of(nodes.department_dashboard_view(stored, AS_OF)) == DASHBOARD
    merged = nodes.patient_encounter_summary_merged(built[0], partials)
    assert summary_of(nodes.patient_encounter_summary_view(merged, AS_OF)) == SUMMARY


def test_abnormal_results(built):
    out = nodes.abnormal_results(built[2], built[1], built[0])
    assert out.count() == 8
    got = {(r.test_name, r.attending_provider): r for r in out.collect()}
    assert got["eGFR", "Dr. Robert Garcia"].abnormal_flag == "LOW"
    assert got["eGFR", "Dr. Robert Garcia"].patient_name == "James Okafor"


def test_department_rollup(clinic):
    got = {r[0]: r[1:] for r in rows(nodes.department_rollup(clinic["encounters"]))}
    assert got["Cardiology"] == (2, 1, D("22737.500000"), D("45475.00"))

import datetime as dt

import pytest
from clinic import access, encounters, patients, rows
from pyspark.sql import functions as F

from wardflow.governance import classify
from wardflow.governance.apply import governed, governed_view, propagate_tags, stricter, tag_frame
from wardflow.governance.masks import MASK_PII_STRING, MASK_SSN
from wardflow.governance.registry import (
    Registry,
    clinical_registry,
    find_tagged,
    map_labels,
    unmapped_labels,
)
from wardflow.governance.roles import role_closure
from wardflow.operators.counts import tag_coverage
from wardflow.plans import nodes
from wardflow.sources.tables import ctas, read

PATIENT, ENCOUNTER = "raw.patient_dim", "raw.encounter_fact"


def first_patient(spark, role):
    seen = governed(patients(spark), PATIENT, role, clinical_registry())
    return rows(seen.where("pat_id = 'P100001'"), "pat_first_name", "ssn", "email", "birth_date")[0]


def test_role_closure():
    assert role_closure("ACCOUNT_ADMIN") == {"ACCOUNT_ADMIN", "ADMIN", "ANALYST", "CLINICIAN"}
    assert role_closure("ADMIN") == {"ADMIN", "ANALYST", "CLINICIAN"}
    assert role_closure("ANALYST") == {"ANALYST"}
    assert role_closure(["A"], [("B", "A"), ("A", "B")]) == {"A", "B"}


def test_masks_by_role(spark):
    born = dt.date(1965, 3, 14)
    assert first_patient(spark, "ADMIN") == ("Maria", "111-22-3333", "msantos@example.com", born)
    assert first_patient(spark, "ACCOUNT_ADMIN") == ("Maria", "111-22-3333", "msantos@example.com", born)
    assert first_patient(spark, "CLINICIAN") == ("Maria", "***-**-3333", "msantos@example.com", born)
    assert first_patient(spark, "ANALYST") == ("***MASKED***", "***-**-****", "***MASKED***", None)
    assert first_patient(spark, "VISITOR") == ("***MASKED***", "***-**-****", "***MASKED***", None)


@pytest.mark.parametrize("role", ["ANALYST", "VISITOR"])
def test_no_raw_value_leaves(spark, role):
    raw = patients(spark)
    seen = governed(raw, PATIENT, role, clinical_registry())
    for column in ("ssn", "pat_first_name", "pat_last_name", "email", "phone", "address_line_1", "birth_date", "pat_mrn"):
        hidden = {r[0] for r in rows(raw, column)}
        assert not hidden & {r[0] for r in rows(seen, column)}, column
    assert seen.where(F.col("ssn") == "111-22-3333").count() == 0
    assert [f.dataType for f in seen.schema] == [f.dataType for f in raw.schema]


def test_hidden_columns_are_not_read(spark, root, capsys):
    ctas(patients(spark), root)
    seen = governed(read(spark, root), PATIENT, "ANALYST", clinical_registry())
    seen.where(F.col("email") == "msantos@example.com").select("pat_id", "ssn", "email", "city").explain("formatted")
    plan = capsys.readouterr().out
    assert "111-22" not in plan
    schema = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert all("ssn" not in line and "email" not in line for line in schema)


def test_null_under_masks(spark):
    df = spark.sql("SELECT CAST(NULL AS STRING) ssn, '12' AS short")
    reg = Registry()
    reg.set_mask("t", "ssn", MASK_SSN)
    reg.set_mask("t", "short", MASK_SSN)
    assert governed(df, "t", "ADMIN", reg).first() == (None, "12")
    assert governed(df, "t", "CLINICIAN", reg).first() == (None, "***-**-12")
    assert governed(df, "t", "ANALYST", reg).first() == ("***-**-****", "***-**-****")


def test_row_policy(spark):
    def ids(role):
        seen = governed(encounters(spark), ENCOUNTER, role, clinical_registry(), access(spark))
        return sorted(r[0] for r in rows(seen, "encounter_id"))

    assert len(ids("ADMIN")) == 10 and len(ids("ANALYST")) == 10
    assert ids("CLINICIAN") == ["E200001", "E200002", "E200005"]
    assert ids("VISITOR") == []
    with pytest.raises(ValueError, match="access table"):
        governed(encounters(spark), ENCOUNTER, "CLINICIAN", clinical_registry())


def test_copy_loses_masks_view_keeps_them(spark, root):
    ctas(patients(spark), root)
    copy = governed(read(spark, root), "curated.patient_copy", "ANALYST", clinical_registry())
    assert "111-22-3333" in {r[0] for r in rows(copy, "ssn")}
    governed_view("v_patient", read(spark, root), PATIENT, "ANALYST", clinical_registry())
    assert {r[0] for r in rows(spark.table("v_patient"), "ssn")} == {"***-**-****"}


def test_tags_follow_the_columns(spark, root):
    reg = clinical_registry()
    tagged = tag_frame(patients(spark), reg, PATIENT)
    ctas(tagged, root)
    stored = read(spark, root)
    assert stored.schema["ssn"].metadata["tags"] == {"PII_TYPE": "SSN", "SENSITIVITY": "RESTRICTED"}
    seen = governed(stored.select("pat_id", F.col("email").alias("mail")), "curated.copy", "ANALYST", reg)
    assert {r[0] for r in rows(seen, "mail")} == {"***MASKED***"}


def test_tags_of_derived_columns(spark):
    reg = clinical_registry()
    raw = tag_frame(patients(spark), reg, PATIENT)
    summary = nodes.patient_encounter_summary(nodes.dim_patient(raw, "2024-10-25"), encounters(spark), "2024-10-25")
    summary = propagate_tags(summary, {"patient_name": [(raw, "pat_first_name"), (raw, "pat_last_name")]})
    seen = governed(summary, "gold.patient_encounter_summary", "ANALYST", reg)
    assert {r[0] for r in rows(seen, "patient_name")} == {"***MASKED***"}
    assert stricter("SENSITIVITY", "PUBLIC", "RESTRICTED") == "RESTRICTED"
    assert stricter("PII_TYPE", "NAME", "SSN") == "NAME"


def test_direct_mask_beats_tag_and_types_must_agree(spark):
    reg = clinical_registry()
    refs = {r.ref_column_name: r for r in reg.policy_references(patients(spark), PATIENT).collect()}
    assert refs["ssn"].policy_name == "MASK_SSN" and refs["ssn"].tag_name is None
    assert refs["email"].policy_name == "MASK_PII_STRING" and refs["email"].tag_name == "PII_TYPE"
    assert refs["birth_date"].policy_name == "MASK_DOB"
    del reg.column_masks[PATIENT, "birth_date"]
    assert "birth_date" not in {c for c, _, _ in reg.resolved_masks(patients(spark), PATIENT)}
    rows_ref = reg.policy_references(encounters(spark), ENCOUNTER).collect()
    assert [(r.policy_kind, r.ref_column_name) for r in rows_ref] == [("ROW_ACCESS_POLICY", "department")]
    assert [r.policy_name for r in clinical_registry().policies(spark).collect()] == [
        "DEPARTMENT_ROW_FILTER", "MASK_DOB", "MASK_PII_STRING", "MASK_SSN",
    ]


def test_tag_references(spark):
    reg = clinical_registry()
    refs = reg.tag_references(spark)
    assert refs.count() == 12
    assert rows(tag_coverage(refs)) == [("PII_TYPE", 8), ("SENSITIVITY", 1)]
    pii = find_tagged(refs, "PII_TYPE", domain="COLUMN", database="LAB")
    assert [r.column_name for r in pii.collect()] == sorted(r.column_name for r in pii.collect())
    assert rows(find_tagged(refs, "SENSITIVITY", "RESTRICTED"), "column_name") == [("ssn",)]
    assert {r.domain for r in refs.collect()} == {"COLUMN", "TABLE", "DATABASE", "WAREHOUSE"}
    labels = spark.createDataFrame([("PII_TYPE", "SSN", "Secret")], "tag_name string, tag_value string, label string")
    assert map_labels(refs, labels).where("label = 'Secret'").count() == 1
    assert unmapped_labels(refs, labels).count() == 11


def test_tag_definitions(spark):
    got = {r.tag_name: r.allowed_values for r in clinical_registry().tag_definitions(spark).collect()}
    assert list(got) == ["COST_CENTER", "DATA_DOMAIN", "PII_TYPE", "SENSITIVITY"]
    assert got["COST_CENTER"] is None and "RESTRICTED" in got["SENSITIVITY"]


def test_tag_rules():
    reg = Registry()
    reg.define_tag("LEVEL", ["A"])
    with pytest.raises(ValueError, match="not an allowed value"):
        reg.set_tag("LEVEL", "B", table="raw.t")
    with pytest.raises(ValueError, match="not defined"):
        reg.set_tag("OTHER", "A", table="raw.t")
    reg.set_tag("LEVEL", "A", table="raw.t", column="X")
    assert reg.column_tags("raw.t") == {"x": {"LEVEL": "A"}}
    reg.unset_tag("LEVEL", table="raw.t", column="X")
    assert reg.column_tags("raw.t") == {}


def test_classify(spark):
    got = {(r.column_name, r.category): r for r in classify.classify(patients(spark)).collect()}
    assert got["ssn", "SSN"].match_rate == 1.0 and got["ssn", "SSN"].recommended
    assert got["email", "EMAIL"].match_rate == 1.0 and got["phone", "PHONE"].match_rate == 1.0
    assert got["birth_date", "DOB"].recommended and got["address_line_1", "ADDRESS"].recommended
    assert not got["city", "EMAIL"].recommended
    found = dict(rows(classify.recommended_tags(classify.classify(patients(spark)), PATIENT), "column_name", "tag_value"))
    assert found == {
        "ssn": "SSN", "pat_first_name": "NAME", "pat_last_name": "NAME", "email": "EMAIL", "phone": "PHONE",
        "address_line_1": "ADDRESS", "birth_date": "DOB", "pat_mrn": "MRN",
    }


def test_classify_finds_values_without_a_telling_name(spark):
    df = spark.createDataFrame([("111-22-3333", "see a@b.com"), (None, "x")], "c1 string, c2 string")
    got = {(r.column_name, r.category): r for r in classify.classify(df, anywhere=True).collect()}
    assert got["c1", "SSN"].match_rate == 1.0 and got["c2", "EMAIL"].match_rate == 0.5
    assert classify.classify(spark.range(1)).count() == 0


def test_mask_needs_its_type(spark):
    assert MASK_PII_STRING.data_type == "string"
    reg = Registry()
    reg.define_tag("T")
    reg.set_tag("T", "any", table="t", column="n")
    reg.set_tag_mask("T", MASK_PII_STRING)
    assert governed(spark.sql("SELECT 1 AS n"), "t", "VISITOR", reg).first().n == 1


def test_a_mask_of_another_type_is_refused(spark):
    from wardflow.governance import apply
    from wardflow.governance.masks import MASK_DOB
    from wardflow.governance.registry import Registry

    reg = Registry()
    reg.set_mask("raw.patient_dim", "ssn", MASK_DOB)
    with pytest.raises(ValueError, match="is for date"):
        apply.governed(spark.createDataFrame([("1",)], "ssn string"), "raw.patient_dim", "ANALYST", reg)

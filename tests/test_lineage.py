"""Tags of derived columns, read from the plan."""

import pytest
from clinic import encounters, patients, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardflow.governance import lineage
from wardflow.governance.apply import governed, governed_view, tag_frame
from wardflow.governance.masks import MASK_DOB, MASK_PII_STRING, MASK_SSN, closed
from wardflow.governance.registry import Registry, clinical_registry
from wardflow.plans import nodes
from wardflow.sources.tables import ctas, read

PATIENT = "raw.patient_dim"


@pytest.fixture
def tagged(spark):
    reg = Registry()
    reg.define_tag("PII", ["SSN", "EMAIL"])
    reg.define_tag("SENSITIVITY")
    reg.set_tag("PII", "SSN", table=PATIENT, column="ssn")
    reg.set_tag("SENSITIVITY", "RESTRICTED", table=PATIENT, column="ssn")
    reg.set_tag("PII", "EMAIL", table=PATIENT, column="email")
    reg.set_tag("SENSITIVITY", "INTERNAL", table=PATIENT, column="email")
    reg.set_tag_mask("PII", MASK_PII_STRING)
    return reg, tag_frame(patients(spark), reg, PATIENT)


def of(df):
    return {c: t.get("PII") for c, t in lineage.column_tags(df).items()}


def test_expressions_and_conditions(tagged):
    _, df = tagged
    out = df.select(
        "pat_id", F.upper("ssn").alias("a"), F.length(F.concat("pat_id", "email")).alias("b"), F.when(F.col("ssn") == "x", 1).otherwise(2).alias("c"),
        F.lit("ssn").alias("d"), F.struct("pat_id", "ssn").alias("e"), F.expr("(SELECT 1)").alias("f"), F.current_date().alias("g"), F.col("email"),
    )
    assert of(out) == {"a": "SSN", "b": "EMAIL", "c": "SSN", "e": "SSN", "email": "EMAIL"}
    # Conditions choose rows and pass nothing on.
    assert of(df.where("ssn IS NOT NULL").orderBy("ssn").select("pat_id", "city").distinct().limit(3)) == {}
    both = df.select(F.concat("email", "ssn").alias("x"))
    assert lineage.column_tags(both) == {"x": {"PII": "EMAIL", "SENSITIVITY": "RESTRICTED"}}


def test_joins_unions_aggregates_windows(spark, tagged):
    _, df = tagged
    visits = encounters(spark).withColumn("note", F.lit("n"))
    joined = visits.join(df.select("pat_id", F.substring("ssn", 1, 3).alias("area")), "pat_id", "left")
    assert of(joined) == {"area": "SSN"}
    # Of a union each column takes the tags of all branches, whatever the order.
    clean = visits.select("pat_id", F.col("note").alias("area"))
    for a, b in ((clean, joined.select("pat_id", "area")), (joined.select("pat_id", "area"), clean)):
        assert of(a.unionByName(b)) == {"area": "SSN"}
        assert of(a.intersect(b)) == {"area": "SSN"}
    grouped = joined.groupBy("department").agg(F.max("area").alias("m"), F.count("*").alias("n"), F.collect_set("note").alias("s"), F.count("area").alias("k"))
    assert of(grouped) == {"m": "SSN", "k": "SSN"}
    assert of(joined.groupBy("area").count()) == {"area": "SSN"}
    ranked = joined.select("pat_id", F.row_number().over(Window.partitionBy("pat_id").orderBy("area")).alias("r"), F.lag("note").over(Window.partitionBy("pat_id").orderBy("note")).alias("p"))
    assert of(ranked) == {"r": "SSN"}
    assert of(joined.rollup("department", "area").agg(F.count("*").alias("n"))) == {"area": "SSN"}
    assert of(joined.groupBy("department").pivot("note", ["n"]).agg(F.max("area"))) == {"n": "SSN"}


def test_sql_views_subqueries_and_generators(spark, tagged):
    _, df = tagged
    df.createOrReplaceTempView("lineage_people")
    assert of(spark.sql("WITH p AS (SELECT pat_id, lower(email) AS e FROM lineage_people), q AS (SELECT * FROM p) SELECT a.e, b.pat_id, 1 AS one FROM q a JOIN q b ON a.pat_id = b.pat_id")) == {"e": "EMAIL"}
    assert of(spark.sql("SELECT city, (SELECT max(ssn) FROM lineage_people) AS top FROM lineage_people")) == {"top": "SSN"}
    assert of(spark.sql("SELECT city, (SELECT max(i.ssn) FROM lineage_people i WHERE i.pat_id = o.pat_id) AS own FROM lineage_people o")) == {"own": "SSN"}
    assert of(spark.sql("SELECT city FROM lineage_people WHERE ssn IN (SELECT ssn FROM lineage_people) AND EXISTS (SELECT email FROM lineage_people)")) == {}
    pieces = df.select("city", "ssn", F.explode(F.split("email", "@")).alias("piece"), F.lit(1).alias("one"))
    assert of(pieces) == {"ssn": "SSN", "piece": "EMAIL"}
    assert of(df.select("city", F.explode(F.split("city", "a")).alias("piece"))) == {}
    assert of(spark.sql("SELECT city, t.x FROM lineage_people, LATERAL (SELECT concat(email, 'x') AS x) t")) == {"x": "EMAIL"}


def test_functions_the_plan_cannot_see_into(tagged):
    _, df = tagged
    some = df.select("pat_id", "ssn").mapInPandas(lambda it: it, "a string, b string")
    assert of(some) == {"a": "SSN", "b": "SSN"}
    assert of(df.select("pat_id", "city").mapInPandas(lambda it: it, "a string, b string")) == {}
    grouped = df.select("city", "ssn").groupBy("city").applyInPandas(lambda g: g, "x string, y string")
    assert of(grouped) == {"x": "SSN", "y": "SSN"}
    upper = F.udf(lambda s: s)
    assert of(df.select("city", upper("ssn").alias("u"), upper("city").alias("v"))) == {"u": "SSN"}


def test_masked_without_a_map(spark, tagged, root):
    reg, df = tagged
    out = df.groupBy("city").agg(F.max(F.upper("ssn")).alias("top"), F.max(F.length("ssn")).alias("n"), F.count("ssn").alias("k"), F.count("*").alias("all"))
    out = lineage.release(out, "k")
    seen = {r.city: r for r in governed(out, "gold.x", "ANALYST", reg).collect()}
    assert seen and all((r.top, r.n) == ("***MASKED***", None) and r.k >= 0 and r["all"] >= 1 for r in seen.values())
    full = {r.city: r for r in governed(out, "gold.x", "ADMIN", reg).collect()}
    assert all(r.n == 11 for r in full.values())
    # Stored tables keep what their columns inherited.
    ctas(lineage.carried(out), root)
    again = governed(read(spark, root).select(F.concat("top", F.lit("!")).alias("loud"), F.col("n") + 1, "k"), "gold.y", "ANALYST", reg)
    assert {tuple(r)[:2] for r in again.collect()} == {("***MASKED***", None)} and again.columns == ["loud", "(n + 1)", "k"]
    assert again.agg(F.min("k")).first()[0] is not None
    governed_view("lineage_gold", out, "gold.x", "ANALYST", reg)
    assert {r.top for r in spark.sql("SELECT top FROM lineage_gold").collect()} == {"***MASKED***"}


def test_gold_tables_of_tagged_patients(spark):
    reg = clinical_registry()
    raw = tag_frame(patients(spark), reg, PATIENT)
    summary = nodes.patient_encounter_summary(nodes.dim_patient(raw, "2024-10-25"), encounters(spark), "2024-10-25")
    seen = governed(summary, "gold.patient_encounter_summary", "ANALYST", reg)
    assert {r[0] for r in rows(seen, "patient_name")} == {"***MASKED***"}
    assert seen.where("total_encounters > 0").count() > 0  # made from other columns


def test_closed_masks_show_whole_values_only(spark):
    df = spark.range(1)
    for policy, role, shown in ((MASK_SSN, "ADMIN", True), (MASK_SSN, "CLINICIAN", False), (MASK_DOB, "CLINICIAN", True), (MASK_PII_STRING, "ANALYST", False)):
        got = df.select(closed(policy, "bigint").apply(F.col("id"), frozenset([role])).alias("x")).first().x
        assert (got == 0) == shown

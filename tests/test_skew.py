"""One key holds a third of all rows; joins are shuffled, and adaptive execution has to split the hot partition."""

import pytest
from clinic import rows
from pyspark.sql import functions as F

from wardflow.plans import nodes

N = 60_000


@pytest.fixture
def small_limits(spark):
    """Limits scaled down to the test data, so the plans are those of large tables."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot(every_third: str, other):
    return F.when(F.col("id") % 3 == 0, every_third).otherwise(other.cast("string"))


@pytest.fixture
def tables(spark):
    ids = spark.range(N, numPartitions=8)
    encounters = ids.select(
        F.col("id").cast("string").alias("encounter_id"),
        hot("1", F.col("id") % 500).alias("pat_id"),
        F.element_at(F.array(F.lit("Inpatient"), F.lit("Emergency"), F.lit("Other")), (F.col("id") % 3 + 1).cast("int")).alias(
            "encounter_type"
        ),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 200).cast("int")).alias("admit_date"),
        F.lit(None).cast("date").alias("discharge_date"),
        hot("D0", F.col("id") % 7).alias("department"),
        hot("9", F.col("id") % 50).alias("attending_prov_id"),
        *[F.lit("x").alias(c) for c in ("primary_dx_code", "primary_dx_name", "encounter_status")],
        (F.col("id") % 1000).cast("decimal(12,2)").alias("total_charges"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("load_ts"),
    )
    patients = spark.range(600).select(
        F.col("id").cast("string").alias("pat_id"),
        F.concat(F.lit("M"), "id").alias("pat_mrn"),
        *[F.lit("a").alias(c) for c in ("first_name", "last_name", "gender")],
        F.lit("1980-01-01").cast("date").alias("birth_date"),
    )
    providers = spark.range(40).select(
        F.col("id").cast("string").alias("prov_id"), F.concat(F.lit("Dr. "), "id").alias("prov_name"), F.lit("s").alias("specialty")
    )
    return patients, encounters, providers


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_provider_join_splits_the_hot_provider(spark, small_limits, tables):
    _, encounters, providers = tables
    out = nodes.fact_encounter_stored(encounters, providers).select("encounter_id", "attending_provider")
    got = out.collect()
    assert "skew=true" in final_plan(out)
    assert len(got) == N
    known = {str(i) for i in range(40)}
    for i in (0, 3, 4, 49):
        want = "Dr. 9" if i % 3 == 0 else (f"Dr. {i % 50}" if str(i % 50) in known else None)
        assert next(r.attending_provider for r in got if r.encounter_id == str(i)) == want


def test_hot_patient_reaches_the_join_as_one_row(spark, small_limits, tables):
    patients, encounters, _ = tables
    got = {r.pat_id: r for r in nodes.patient_encounter_summary(patients, encounters, "2024-10-25").collect()}
    naive = (
        patients.join(encounters, "pat_id", "left")
        .groupBy("pat_id")
        .agg(
            F.count("encounter_id"),
            F.count_if(F.col("encounter_type") == "Inpatient"),
            F.sum("total_charges"),
            F.max("admit_date"),
            F.coalesce(F.array_join(F.sort_array(F.collect_set("department")), ", "), F.lit("")),
        )
    )
    for pat_id, *want in rows(naive):
        r = got[pat_id]
        assert [r.total_encounters, r.inpatient_count, r.total_charges, r.last_visit_date, r.departments_seen] == want
    assert got["1"].total_encounters > N / 3 and got["599"].total_encounters == 0


def test_hot_department(spark, small_limits, tables):
    _, encounters, _ = tables
    out = nodes.department_dashboard(nodes.fact_encounter_view(encounters, "2024-10-25"))
    got = {r.department: (r.encounter_count, r.unique_patients) for r in out.collect()}
    assert got["D0"] == (N / 3, 1) and sum(n for n, _ in got.values()) == N

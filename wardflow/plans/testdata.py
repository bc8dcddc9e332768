"""The supplied order, customer and event tables read as clinical tables.

Every function maps whole tables; the only joins are those the nodes do. Days and times are fixed by ``AS_OF``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.details import detail_of

AS_OF = "2024-10-25"
LOADED_AT = "2024-10-25 06:00:00"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _padded(number: Column, width: int) -> Column:
    """The lowest digits of a number with leading zeros."""
    return F.lpad((number % F.lit(10**width)).cast("string"), width, "0")


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    ssn = _padded(key, 9)
    return load(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("pat_id"),
        F.concat(F.lit("MRN-"), (key + 900000).cast("string")).alias("pat_mrn"),
        F.col("c_mktsegment").alias("pat_first_name"),
        F.col("c_name").alias("pat_last_name"),
        F.date_add(F.lit("1940-01-01").cast("date"), (key * 7919 % 25000).cast("int")).alias("birth_date"),
        F.concat_ws("-", F.left(ssn, F.lit(3)), F.substring(ssn, 4, 2), F.right(ssn, F.lit(4))).alias("ssn"),
        F.concat(_text("c_nationkey"), F.lit(" "), F.col("c_mktsegment"), F.lit(" St")).alias("address_line_1"),
        F.concat(F.lit("City "), _text("c_nationkey")).alias("city"),
        F.lit("RI").alias("state"),
        _padded(key, 5).alias("zip_code"),
        F.concat(F.lit("(401) 555-"), _padded(key, 4)).alias("phone"),
        F.concat(F.lower("c_mktsegment"), _text("c_custkey"), F.lit("@example.com")).alias("email"),
        F.when(F.col("c_nationkey") < 20, "English").otherwise("Spanish").alias("prim_language"),
        F.when(F.col("c_acctbal") < 0, "Female").otherwise("Male").alias("gender"),
        _ts("2024-10-01 00:00:00").alias("load_ts"),
    )


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").select(
        _text("s_suppkey").alias("prov_id"),
        F.col("s_name").alias("prov_name"),
        F.concat(F.lit("Specialty "), _text("s_nationkey")).alias("specialty"),
        F.concat(F.lit("Dept "), _text("s_nationkey")).alias("department"),
        _padded(F.col("s_suppkey"), 10).alias("npi"),
        (F.col("s_acctbal") > 0).alias("active"),
    )


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as encounters. Finished orders are discharged after some days; the provider number of many orders is
    unknown."""
    admit = F.col("o_orderdate").cast("date")
    days = (F.col("o_orderkey") % 12).cast("int")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return load(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("encounter_id"),
        _text("o_custkey").alias("pat_id"),
        F.when(priority == "1-URGENT", "Emergency")
        .when(priority == "2-HIGH", "Inpatient")
        .otherwise("Outpatient")
        .alias("encounter_type"),
        admit.alias("admit_date"),
        F.when(status == "F", F.date_add(admit, days)).alias("discharge_date"),
        priority.alias("department"),
        _text("o_custkey").alias("attending_prov_id"),
        status.alias("primary_dx_code"),
        F.concat(F.lit("Diagnosis "), status).alias("primary_dx_name"),
        F.when(status == "F", "Discharged").otherwise("Completed").alias("encounter_status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_charges"),
        _ts("2024-10-01 00:00:00").alias("load_ts"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as encounters of their users; most customers have none."""
    kind = F.col("event_type")
    day = F.col("ts").cast("date")
    return load(spark, sf_dir, "events").select(
        _text("event_id").alias("encounter_id"),
        _text("user_id").alias("pat_id"),
        F.when(kind == "error", "Emergency")
        .when(kind == "purchase", "Inpatient")
        .otherwise("Outpatient")
        .alias("encounter_type"),
        day.alias("admit_date"),
        F.when(kind == "signup", day).alias("discharge_date"),
        kind.alias("department"),
        F.col("value").cast("decimal(12,2)").alias("total_charges"),
    )


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as lab results; the patient is the part number, which many lines share."""
    return load(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("result_id"),
        _text("l_orderkey").alias("encounter_id"),
        _text("l_partkey").alias("pat_id"),
        F.col("l_returnflag").alias("test_code"),
        F.concat(F.lit("Panel "), F.col("l_linestatus")).alias("test_name"),
        F.col("l_quantity").cast("decimal(10,2)").alias("result_value"),
        F.lit("mg/dL").alias("result_unit"),
        (F.lit(10) + F.col("l_tax") * 100).cast("decimal(10,2)").alias("reference_low"),
        F.when(F.col("l_discount") > 0.09, F.lit(None)).otherwise(40).cast("decimal(10,2)").alias("reference_high"),
        F.col("l_shipdate").alias("result_date"),
    )


def vendor_labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a vendor file in which many rows break one rule or several."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    day = F.col("o_orderdate").cast("date")
    return load(spark, sf_dir, "orders").select(
        F.when((status == "P") & (price < 50000), F.lit(None))
        .when(priority == "5-LOW", F.concat(F.lit("BAD"), _text("o_orderkey")))
        .otherwise(F.concat(F.lit("VL-"), _padded(key, 6)))
        .alias("vendor_id"),
        F.when(price < 20000, F.lit(None))
        .when((priority == "2-HIGH") & (status == "O"), F.concat(F.lit("MRN"), _text("o_custkey")))
        .otherwise(F.concat(F.lit("MRN-"), _padded(F.col("o_custkey"), 6)))
        .alias("pat_mrn"),
        F.nullif(priority, F.lit("4-NOT SPECIFIED")).alias("test_code"),
        F.concat(F.lit("Test "), priority).alias("test_name"),
        _text("o_orderkey").alias("result_value"),
        F.lit("mg/dL").alias("result_unit"),
        F.when(F.month(day) != 2, day).alias("result_date"),
        F.when(status == "F", "Y")
        .when(status == "O", "N")
        .when(price > 400000, "X")
        .when(price < 100000, "")
        .alias("abnormal_yn"),
    )


def drifted_vendor_labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vendor file with two columns more, one column less and one of another type."""
    df = vendor_labs(spark, sf_dir)
    return df.drop("result_unit").select(
        *[c for c in df.columns if c not in ("result_unit", "result_value")],
        F.col("result_value").cast("bigint").alias("result_value"),
        F.col("abnormal_yn").alias("lab_site"),
        F.lit("v2").alias("file_version"),
    )


def messy_vendor_labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vendor file in inconsistent formats: blanks, lower case, and two ways to write a date."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    return load(spark, sf_dir, "orders").select(
        key.alias("o_orderkey"),
        F.concat(F.lit("  vl-"), _padded(key, 6), F.lit(" ")).alias("vendor_id"),
        F.concat(F.lit("MRN "), _padded(F.col("o_custkey"), 6)).alias("pat_mrn"),
        F.when(key % 3 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 3 == 1, F.date_format(day, "dd.MM.yyyy"))
        .otherwise("unknown")
        .alias("result_date"),
        F.when(F.col("o_orderstatus") == "F", " y").when(F.col("o_orderstatus") == "O", "n ").otherwise(" ").alias("abnormal_yn"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a run log: errors, warnings for sign-ups, and details on purchases and sign-ups."""
    return _as_run_log(load(spark, sf_dir, "events"))


def run_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as a stream over the files of the events."""
    # A file of a fixed name is matched by a pattern too, which is what a file stream looks for.
    path = f"{sf_dir}/events.parque[t]"
    return _as_run_log(spark.readStream.schema(load(spark, sf_dir, "events").schema).parquet(path))


def _as_run_log(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    number = F.regexp_extract("props", '"k": ?([0-9]+)', 1).cast("bigint")
    user = _text("user_id")
    loaded = detail_of(rows_loaded=number, target=kind, batch_id=user)
    routed = detail_of(accepted=number * 2, quarantined=number, batch_id=user)
    return events.select(
        F.concat_ws("-", kind, user, _text("event_id")).alias("run_id"),
        kind.alias("step_name"),
        F.when(kind == "error", "ERROR").when(kind == "signup", "WARN").otherwise("INFO").alias("log_level"),
        F.concat(
            F.lit("Step '"), kind, F.lit("' of user "), user, F.lit(" ended as "), kind, F.lit(" with code "), number.cast("string")
        ).alias("message"),
        F.when(kind == "purchase", loaded)
        .when(kind == "signup", routed)
        .when(kind == "view", F.try_parse_json("props"))
        .alias("detail"),
        F.col("ts").alias("logged_at"),
        user.alias("batch_id"),
    )


def department_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which departments clinicians see: those named by nations of the first two regions' numbering."""
    nation = load(spark, sf_dir, "nation")
    return nation.where(F.col("n_regionkey") <= 1).select(
        F.lit("CLINICIAN").alias("role_name"), F.concat(F.lit("Dept "), _text("n_nationkey")).alias("department")
    )

"""Named queries over the supplied tables: (session, folder) -> DataFrame. Each reads its tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions import text
from wardflow.functions.dates import hour_floor, second_boundaries, within_minutes, year_boundaries
from wardflow.functions.details import detail_field, misfits
from wardflow.functions.flags import bucket, review_tier
from wardflow.governance import apply, classify, lineage
from wardflow.governance.masks import MASK_PII_STRING
from wardflow.governance.registry import (
    DEPARTMENT_ROW_FILTER,
    Registry,
    clinical_registry,
    find_tagged,
    map_labels,
    unmapped_labels,
)
from wardflow.operators import annotate, runlog, validation
from wardflow.operators.counts import layer_counts, tag_coverage
from wardflow.operators.imports import Importer, results_frame
from wardflow.operators.routing import batches, delete_batch, process_vendor_batch, quarantined, route_batch, routed
from wardflow.operators.runlog import RunLog
from wardflow.plans import nodes
from wardflow.plans import testdata as td
from wardflow.plans.graph import clinical_graph
from wardflow.session import new_workspace
from wardflow.sources.schemas import IMPORT_CONFIG, PROVIDER, RUN_LOG, VENDOR_LAB
from wardflow.sources.tables import (
    create_table,
    ctas,
    export_open,
    latest,
    read,
    read_whole_text,
    register_views,
    rows_frame,
    table_columns,
    with_lineage,
)
from wardflow.streaming import alerts
from wardflow.streaming.refresh import GraphRefresher, refresh_history

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- derived tables ----------------------------------------------------------------------------------------------------


@query
def dim_patient(spark, sf):
    return nodes.dim_patient(td.patients(spark, sf), td.AS_OF)


@query
def dim_provider(spark, sf):
    return nodes.dim_provider(td.providers(spark, sf))


@query
def fact_encounter(spark, sf):
    return nodes.fact_encounter(td.encounters(spark, sf), td.providers(spark, sf), td.AS_OF)


@query
def fact_lab_results(spark, sf):
    return nodes.fact_lab_results(td.labs(spark, sf))


@query
def patient_encounter_summary(spark, sf):
    return nodes.patient_encounter_summary(dim_patient(spark, sf), td.encounters(spark, sf), td.AS_OF)


@query
def patient_visit_summary(spark, sf):
    """The same summary over event visits, where most patients have no visit."""
    return nodes.patient_encounter_summary(dim_patient(spark, sf), td.visits(spark, sf), td.AS_OF)


@query
def department_dashboard(spark, sf):
    # The stay needs no provider, so the encounters go in without that join.
    out = nodes.department_dashboard(nodes.fact_encounter_view(td.encounters(spark, sf), td.AS_OF))
    return out.withColumn("avg_charges", F.col("avg_charges").cast("double"))


@query
def visit_dashboard(spark, sf):
    out = nodes.department_dashboard(nodes.fact_encounter_view(td.visits(spark, sf), td.AS_OF))
    return out.withColumn("avg_charges", F.col("avg_charges").cast("double"))


@query
def abnormal_results_summary(spark, sf):
    return nodes.abnormal_results(fact_lab_results(spark, sf), fact_encounter(spark, sf), dim_patient(spark, sf))


@query
def department_rollup(spark, sf):
    out = nodes.department_rollup(td.encounters(spark, sf))
    return out.withColumn("avg_charges", F.col("avg_charges").cast("double"))


@query
def open_export(spark, sf):
    """The rollup published as open files and read back."""
    path = export_open(nodes.department_rollup(td.encounters(spark, sf)), new_workspace(spark, "export"))
    return read(spark, path).withColumn("avg_charges", F.col("avg_charges").cast("double"))


@query
def layer_row_counts(spark, sf):
    names = ["customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations"]
    return layer_counts({f"raw.{n}": td.load(spark, sf, n) for n in names})


# --- incremental refresh -------------------------------------------------------------------------------------------------


def _refreshed(spark: SparkSession, sf: str, *only: str, after_node=None, labs: bool = False) -> GraphRefresher:
    """A store fed in three drops: late providers and patients come after the encounters that refer to them. After each
    drop all tables are refreshed, or only those named and what they are made from."""
    store = GraphRefresher(spark, clinical_graph(), new_workspace(spark, "graph"), n_buckets=8, after_node=after_node)
    people, facts, who = td.patients(spark, sf), td.encounters(spark, sf), td.providers(spark, sf)
    # Rows without the date belong to the other drop; every row arrives once.
    early = F.coalesce(F.col("admit_date") < "1999-01-01", F.lit(False))
    young = F.coalesce(F.col("birth_date") > "1990-01-01", F.lit(False))
    drops = [
        [("raw.patient_dim", people.where(~young)), ("raw.encounter_fact", facts.where(early))],
        [("raw.provider_dim", who), ("raw.encounter_fact", facts.where(~early))],
        [("raw.patient_dim", people.where(young))],
    ]
    if labs:
        drops[0].append(("raw.lab_results", td.labs(spark, sf).withColumn("load_ts", F.lit(td.LOADED_AT).cast("timestamp_ntz"))))
    for drop in drops:
        for name, df in drop:
            store.land(name, df)
        store.refresh_available(only=only or None)
    return store


@query
def incremental_summary(spark, sf):
    return _refreshed(spark, sf, "gold.patient_encounter_summary").table("gold.patient_encounter_summary", td.AS_OF)


@query
def republished_gold(spark, sf):
    """A gold table is published again after each of its refreshes, so the open files end up complete."""
    out = f"{new_workspace(spark, 'published')}/dashboard"

    def publish(store: GraphRefresher, name: str) -> None:
        if name == "gold.department_dashboard":
            export_open(store.table(name, td.AS_OF), out)

    _refreshed(spark, sf, after_node=publish)
    return read(spark, out).withColumn("avg_charges", F.col("avg_charges").cast("double"))


@query
def lagged_dashboard(spark, sf):
    """Curated tables follow at once and gold tables later, each by a query of its own; in the end gold has every row."""
    store = GraphRefresher(spark, clinical_graph("1 second", "1 hour"), new_workspace(spark, "graph"), n_buckets=4)
    facts = td.encounters(spark, sf)
    early = F.coalesce(F.col("admit_date") < "1998-01-01", F.lit(False))
    store.land("raw.provider_dim", td.providers(spark, sf))
    store.land("raw.encounter_fact", facts.where(early))
    store.refresh_available()
    query = store.start()
    try:
        store.land("raw.encounter_fact", facts.where(~early))
        query.processAllAvailable()
    finally:
        query.stop()
        query.awaitTermination()
    store.refresh_available()
    out = store.table("gold.department_dashboard", td.AS_OF)
    return out.withColumn("avg_charges", F.col("avg_charges").cast("double"))


@query
def incremental_abnormal(spark, sf):
    """Abnormal results while lab rows come before some of their encounters and patients."""
    return _refreshed(spark, sf, labs=True).table("gold.abnormal_results_summary", td.AS_OF)


@query
def incremental_dashboard(spark, sf):
    out = _refreshed(spark, sf).table("gold.department_dashboard", td.AS_OF)
    return out.withColumn("avg_charges", F.col("avg_charges").cast("double"))


@query
def estimated_counts(spark, sf):
    """Distinct counts per department: estimates kept from sketches while rows arrive in slices, beside exact ones, and
    whether they are within the stated bound."""
    store = GraphRefresher(spark, clinical_graph(sketches=True), new_workspace(spark, "graph"), n_buckets=4)
    facts = td.encounters(spark, sf)
    early = F.coalesce(F.col("admit_date") < "1996-01-01", F.lit(False))
    for label, rows in (("old", facts.where(early)), ("new", facts.where(~early))):
        store.land("raw.encounter_fact", rows, label)
        store.refresh_available(only=["gold.department_estimates"])
    guessed = store.table("gold.department_estimates")
    exact = facts.groupBy(F.col("department").alias("d")).agg(
        F.count_distinct("encounter_id").alias("encounter_count"), F.count_distinct("pat_id").alias("unique_patients"))

    def close(estimate: str, count: str):
        return F.abs(F.col(estimate) - F.col(count)) <= nodes.SKETCH_BOUND * F.col(count) + 1

    return guessed.join(exact, F.col("department").eqNullSafe(F.col("d")), "full").select(
        "department", "encounter_count", "unique_patients",
        close("encounter_estimate", "encounter_count").alias("encounters_close"), close("patient_estimate", "unique_patients").alias("patients_close"),
    )


@query
def refresh_states(spark, sf):
    """How often each table was refreshed while three drops arrived."""
    history = refresh_history(spark, _refreshed(spark, sf).root)
    return history.groupBy("name", "state").agg(F.count("*").alias("refreshes")).orderBy("name")


# --- filters, ordering, functions ----------------------------------------------------------------------------------------


@query
def filter_equal(spark, sf):
    return td.load(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


@query
def filter_not_normal(spark, sf):
    return fact_lab_results(spark, sf).where(F.col("abnormal_flag") != "NORMAL").select("result_id", "abnormal_flag")


@query
def filter_in_list(spark, sf):
    return td.load(spark, sf, "events").where(F.col("event_type").isin("error", "signup")).select("event_id", "event_type")


@query
def filter_not_in_or_null(spark, sf):
    yn = F.col("abnormal_yn")
    return td.vendor_labs(spark, sf).where(yn.isNotNull() & ~yn.isin("Y", "N")).select("result_value", "abnormal_yn")


@query
def recent_events(spark, sf):
    now = "2024-01-15 12:00:00"
    cond = within_minutes(F.col("ts"), 600, now) & (F.col("ts") <= F.lit(now).cast("timestamp_ntz"))
    return td.load(spark, sf, "events").where(cond).select("event_id", "ts")


@query
def top_orders(spark, sf):
    cols = td.load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return cols.orderBy(F.col("o_totalprice").desc_nulls_first(), "o_orderkey").limit(20)


@query
def latest_events(spark, sf):
    return latest(td.run_log(spark, sf), 10, "logged_at", "run_id").select("run_id", "log_level", "logged_at")


@query
def text_functions(spark, sf):
    df = td.load(spark, sf, "part")
    name, brand = F.col("p_name"), F.col("p_brand")
    joined = F.concat_ws("-", F.upper(name), brand, F.lit("o'neil_x"))
    return df.select(
        "p_partkey",
        text.initcap_words(joined).alias("initcap"),
        text.digits_only(joined).alias("digits"),
        text.last_chars(brand, 4).alias("tail"),
        text.split_prefix(joined).alias("prefix"),
        F.replace(name, F.lit(" "), F.lit("T")).alias("replaced"),
        text.matches_whole(brand, "Brand#[0-9]").alias("one_digit_brand"),
        text.preview(name, 5).alias("short"),
        F.coalesce(F.nullif(F.col("p_type"), F.lit("SMALL")), F.lit("NONE")).alias("type_or_none"),
    )


@query
def cleaned_phones(spark, sf):
    return td.patients(spark, sf).select(
        "pat_id", F.col("phone").alias("raw_phone"), text.clean_phone(F.col("phone")).alias("cleaned_phone")
    )


@query
def date_functions(spark, sf):
    df = td.load(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    return df.select(
        "o_orderkey",
        year_boundaries(day, F.lit(td.AS_OF).cast("date")).cast("bigint").alias("years"),
        F.date_diff(F.lit(td.AS_OF).cast("date"), day).cast("bigint").alias("days"),
    )


@query
def time_functions(spark, sf):
    df = td.load(spark, sf, "events")
    start = F.lit("2024-01-01 00:00:00.5").cast("timestamp_ntz")
    return df.select(
        "event_id", hour_floor(F.col("ts")).alias("hour"), second_boundaries(start, F.col("ts")).alias("seconds")
    )


@query
def json_details(spark, sf):
    df = td.load(spark, sf, "events").withColumn("detail", F.try_parse_json("props"))
    return df.select(
        "event_id",
        detail_field(F.col("detail"), "k", "bigint").alias("k"),
        detail_field(F.col("detail"), "missing").alias("missing"),
    )


# --- run log ---------------------------------------------------------------------------------------------------------------


@query
def run_summary(spark, sf):
    return runlog.run_summary(td.run_log(spark, sf), ordered=False)


@query
def batch_health(spark, sf):
    return runlog.batch_health(td.run_log(spark, sf), ordered=False)


@query
def batch_health_by_id(spark, sf):
    return runlog.batch_health(td.run_log(spark, sf), "batch_id", ordered=False)


@query
def import_details(spark, sf):
    out = runlog.import_details(td.run_log(spark, sf), ordered=False)
    return out.withColumn("rows_loaded", F.col("rows_loaded").cast("bigint"))


@query
def quarantine_details(spark, sf):
    out = runlog.quarantine_details(td.run_log(spark, sf), ordered=False)
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("accepted", "quarantined")})


@query
def problem_events(spark, sf):
    return runlog.problem_events(td.run_log(spark, sf), ordered=False)


@query
def error_patterns(spark, sf):
    return runlog.error_patterns(td.run_log(spark, sf), levels=("ERROR", "WARN"), ordered=False)


@query
def top_error_patterns(spark, sf):
    """The two most frequent kinds of all messages."""
    return runlog.error_patterns(td.run_log(spark, sf), n=2, levels=("ERROR", "WARN", "INFO"))


@query
def events_of_run(spark, sf):
    """All events of the run that logged last."""
    log = td.run_log(spark, sf)
    last = latest(log, 1, "logged_at", "run_id").first()
    out = runlog.events_of(log, last.run_id if last else "")
    return out.select("run_id", "step_name", "log_level", "message", "logged_at")


@query
def recent_error_flag(spark, sf):
    """Whether an alert is due: any error in the look-back of three points of time."""
    log = td.run_log(spark, sf)
    rows = [(now, runlog.has_recent_errors(log, 5, now)) for now in ("2024-01-15 12:00:00", "2024-01-20 00:00:00", "2023-01-01 00:00:00")]
    checked = spark.createDataFrame(rows, "checked_at string, has_errors boolean")
    return checked.select(F.col("checked_at").cast("timestamp_ntz").alias("checked_at"), "has_errors")


@query
def log_views_by_sql(spark, sf):
    """The views over the log as SQL text sees them."""
    log = td.run_log(spark, sf)
    register_views(spark, v_batch_health=runlog.batch_health(log, ordered=True), v_problem_events=runlog.problem_events(log, ordered=True))
    return spark.sql(
        """SELECT h.health_status, count(*) AS batches, sum(p.problems) AS problems FROM v_batch_health h
           LEFT JOIN (SELECT split_part(run_id, '-', 1) || '-' || split_part(run_id, '-', 2) AS batch, count(*) AS problems
                      FROM v_problem_events GROUP BY 1) p ON p.batch = h.batch_prefix
           GROUP BY h.health_status"""
    )


@query
def detail_misfits(spark, sf):
    """Details that are no JSON are counted instead of ending the query; here every text of a document is one."""
    raw = td.load(spark, sf, "events").select("props").unionByName(td.load(spark, sf, "documents").select(F.concat(F.lit("x "), "text").alias("props")))
    return raw.agg(F.count("props").alias("n_details"), misfits(F.col("props")).alias("n_misfits"))


@query
def error_alerts(spark, sf):
    """Five-minute windows with errors, kept current by a stream over the log: each is there after the trigger that saw
    its errors, whether it has closed or not."""
    work = new_workspace(spark, "alerts")
    out = alerts.error_alerts(td.run_log_stream(spark, sf))
    alerts.keep_current(out, f"{work}/out", f"{work}/state", ["window_start"], every=None).awaitTermination()
    return read(spark, f"{work}/out")


@query
def raised_alerts(spark, sf):
    """Alerts per batch: raised with the first error, prolonged by others within half a day, cleared by a timer after that."""
    work = new_workspace(spark, "alerts")
    out = alerts.step_alerts(td.run_log_stream(spark, sf), by="batch_id", minutes=720)
    alerts.start_alerts(out, f"{work}/out", f"{work}/state", every=None).awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{work}/out")


@query
def streamed_run_summary(spark, sf):
    """The hourly summary of the run log, kept current by a stream."""
    work = new_workspace(spark, "summary")
    out = alerts.run_summary_stream(td.run_log_stream(spark, sf))
    alerts.keep_current(out, f"{work}/out", f"{work}/state", ["log_hour", "step_name", "log_level"], every=None).awaitTermination()
    return read(spark, f"{work}/out")


# --- ingestion -----------------------------------------------------------------------------------------------------------


@query
def validated_rows(spark, sf):
    out = validation.with_validation(td.vendor_labs(spark, sf))
    return out.select("result_value", "is_valid", F.to_json("rejection_reasons").alias("reasons"))


@query
def validated_by_sql(spark, sf):
    """The same verdicts through the SQL table function."""
    validation.register_sql_function(spark)
    td.vendor_labs(spark, sf).createOrReplaceTempView("wardflow_vendor_labs")
    return spark.sql(
        """SELECT src.result_value, v.is_valid, to_json(v.rejection_reasons) AS reasons
           FROM wardflow_vendor_labs src, LATERAL validate_vendor_lab_row(
             src.vendor_id, src.pat_mrn, src.test_code, src.result_date, src.abnormal_yn) v"""
    )


@query
def routed_rows(spark, sf):
    """One batch written once, split by status, and read back."""
    base = new_workspace(spark, "vendor")
    route_batch(td.vendor_labs(spark, sf), base, "BATCH-001")
    return routed(spark, base).select(*VENDOR_LAB.names, "batch_id", "status")


@query
def rerouted_counts(spark, sf):
    """A batch that comes twice counts once."""
    base = new_workspace(spark, "vendor")
    for _ in range(2):
        route_batch(td.vendor_labs(spark, sf), base, "BATCH-001")
    return routed(spark, base).groupBy("batch_id", "status").agg(F.count("*").alias("n_rows"))


@query
def quarantine_report(spark, sf):
    base = new_workspace(spark, "vendor")
    route_batch(td.vendor_labs(spark, sf), base, "BATCH-002")
    return validation.quarantine_report(quarantined(spark, base))


@query
def misfit_quarantine(spark, sf):
    """Dates that do not fit their type are quarantined with the text that came."""
    base = new_workspace(spark, "vendor")
    labs = td.vendor_labs(spark, sf)
    odd = F.col("abnormal_yn") == "Y"
    written = F.when(odd, F.date_format("result_date", "dd.MM.yyyy")).otherwise(F.date_format("result_date", "yyyy-MM-dd"))
    route_batch(labs.withColumn("result_date", written), base, "BATCH-003")
    return quarantined(spark, base).select(
        "result_value", F.to_json("rejection_reasons").alias("reasons"), F.col("rejected_values")["result_date"].alias("rejected_date")
    )


@query
def deleted_batch(spark, sf):
    """Of two batches one is deleted; the other one stays."""
    base = new_workspace(spark, "vendor")
    for batch in ("BATCH-001", "BATCH-002"):
        route_batch(td.vendor_labs(spark, sf), base, batch)
    delete_batch(spark, base, "BATCH-001")
    rows = routed(spark, base).groupBy("batch_id").agg(F.count("*").alias("n_rows"))
    return batches(spark, base).join(rows, "batch_id", "left").select("batch_id", "state", "accepted", "quarantined", "n_rows")


@query
def skipped_batch(spark, sf):
    """A batch that was routed before is left alone, whatever comes under its name."""
    base = new_workspace(spark, "vendor")
    labs = td.vendor_labs(spark, sf)
    route_batch(labs, base, "BATCH-001")
    again = route_batch(labs.where("vendor_id IS NULL"), base, "BATCH-001", mode="skip")
    rows = routed(spark, base).groupBy("status").agg(F.count("*").alias("n_rows"))
    return rows.withColumn("second_run", F.lit(again.status))


def _torn(df: DataFrame, number: str) -> DataFrame:
    """The rows, but reading the one with the largest number fails, after others were written."""
    n = F.col(number).cast("bigint")
    largest = df.agg(F.max(n)).first()[0]
    return df.withColumn(number, F.when(n == largest, F.raise_error(F.lit("torn file"))).otherwise(F.col(number)))


@query
def failed_rerun(spark, sf):
    """A second run of a batch fails half-way: the rows of the first one still count, and a third run skips them."""
    base, log = new_workspace(spark, "vendor"), RunLog(spark, f"{new_workspace(spark, 'log')}/log")
    labs = td.vendor_labs(spark, sf)
    route_batch(labs, base, "BATCH-001")
    failed = process_vendor_batch(_torn(labs, "result_value"), base, "BATCH-001", log)
    again = route_batch(labs.where("vendor_id IS NULL"), base, "BATCH-001", mode="skip")
    rows = routed(spark, base).groupBy("batch_id", "status").agg(F.count("*").alias("n_rows"))
    listed = batches(spark, base).join(rows, "batch_id")
    return listed.select(
        "batch_id", "status", "n_rows", "state", "last_run", "accepted", "quarantined",
        F.lit(failed.status).alias("second_run"), F.lit(again.status).alias("third_run"),
    )


@query
def merged_batch(spark, sf):
    """A batch comes again with a part of its rows changed and others new: by key, each row counts once, the newest."""
    base = new_workspace(spark, "vendor")
    labs, third = td.vendor_labs(spark, sf), F.col("result_value").cast("bigint") % 3
    route_batch(labs.where(third != 0), base, "BATCH-001")
    newer = labs.where(third != 1).withColumns({"result_unit": F.lit("mmol/L"), "abnormal_yn": F.lit("N")})
    for _ in range(2):  # merging twice changes nothing
        result = route_batch(newer, base, "BATCH-001", mode="merge", keys=["result_value"])
    out = routed(spark, base).select("batch_id", "result_value", "result_unit", "abnormal_yn", "status")
    return out.withColumn("accepted", F.lit(result.accepted).cast("bigint"))


@query
def failed_replace(spark, sf):
    """A table and a folder are replaced by a query that fails half-way; both keep the rows they had."""
    path, name = f"{new_workspace(spark, 'replaced')}/customer", "wardflow_replaced_customer"
    rows = td.load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    for target, home in ((path, None), (name, f"{path}-table")):
        ctas(rows, target, home)
        try:
            ctas(_torn(rows.withColumn("c_name", F.lit("lost")), "c_custkey"), target, home)
        except Exception as exc:  # what comes back is what is read below
            if "torn file" not in str(exc):
                raise
    folder, table = read(spark, path).withColumn("kept_in", F.lit("folder")), spark.table(name).withColumn("kept_in", F.lit("table"))
    return folder.unionByName(table)


@query
def batch_log(spark, sf):
    """What the run log says after a drifted batch was processed."""
    work = new_workspace(spark, "vendor")
    log = RunLog(spark, f"{work}/log")
    process_vendor_batch(td.drifted_vendor_labs(spark, sf), f"{work}/routed", "DRIFT-001", log, "drifted")
    events = read(spark, f"{work}/log", RUN_LOG)
    return events.select("step_name", "log_level", "message", F.to_json("detail").alias("detail"))


@query
def reason_counts(spark, sf):
    return validation.reason_counts(validation.with_validation(td.vendor_labs(spark, sf)))


@query
def drift_report(spark, sf):
    return validation.drift_report(td.drifted_vendor_labs(spark, sf), VENDOR_LAB)


@query
def normalized_formats(spark, sf):
    spec = {
        "vendor_id": ["trim", "upper"],
        "pat_mrn": [("replace", "^MRN ", "MRN-")],
        "result_date": [("date", "yyyy-MM-dd", "dd.MM.yyyy")],
        "abnormal_yn": ["trim", "upper", "empty_to_null"],
    }
    return validation.normalize_formats(td.messy_vendor_labs(spark, sf), spec)


# --- imports ---------------------------------------------------------------------------------------------------------------


@query
def import_all(spark, sf):
    """Four sources imported by configuration; one of them does not exist, a fifth is disabled."""
    work = new_workspace(spark, "imports")
    rows = [
        (1, "raw", "orders", "curated", "fact_orders", "o_orderkey", True),
        (2, "raw", "customer", "curated", "dim_customer", "c_custkey", True),
        (3, "raw", "lineitem", "curated", "fact_lines", "l_orderkey", True),
        (4, "raw", "nowhere", "curated", "nothing", "id", True),
        (5, "raw", "part", "curated", "dim_part", "p_partkey", False),
    ]

    def locate(schema: str, table: str) -> str:
        return f"{sf}/{table}.parquet" if schema == "raw" else f"{work}/{schema}/{table}"

    config = rows_frame(spark, rows, IMPORT_CONFIG)
    run = Importer(spark, config, RunLog(spark, f"{work}/log"), f"{work}/status", locate)
    results = run.run_all_imports("BATCH-2024-001")
    out = results_frame(spark, results).select("source_table", "status", "rows_loaded")
    return out.join(run.status(), "source_table", "full").select(
        "source_table", "status", "rows_loaded", "last_run_status"
    )


@query
def import_duplicates(spark, sf):
    """A source listed three times: the disabled entry is passed over, both enabled ones get the rows."""
    work = new_workspace(spark, "imports")
    rows = [
        (1, "raw", "orders", "curated", "never", "o_orderkey", False),
        (2, "raw", "orders", "curated", "first_copy", "o_orderkey", True),
        (3, "raw", "orders", "curated", "second_copy", "o_orderkey", True),
    ]

    def locate(schema: str, table: str) -> str:
        return f"{sf}/{table}.parquet" if schema == "raw" else f"{work}/{schema}/{table}"

    run = Importer(spark, rows_frame(spark, rows, IMPORT_CONFIG), RunLog(spark, f"{work}/log"), f"{work}/status", locate)
    before = run.status().agg(F.count("last_run_status").alias("n")).first().n
    result = run.run_import("orders", "BATCH-9")
    copies = [read(spark, locate("curated", t)).select(F.lit(t).alias("target_table")) for t in ("first_copy", "second_copy")]
    counted = copies[0].unionByName(copies[1]).groupBy("target_table").agg(F.count("*").alias("n_rows"))
    return counted.select("target_table", "n_rows", F.lit(result.status).alias("status"), F.lit(before).cast("bigint").alias("stamped_before"))


@query
def declared_defaults(spark, sf):
    """Rows inserted without some of their columns take the declared defaults."""
    path = f"{new_workspace(spark, 'declared')}/providers"
    given = td.providers(spark, sf).drop("active")
    create_table(spark, "wardflow_declared_providers", PROVIDER, path)
    given.createOrReplaceTempView("wardflow_given_providers")
    columns = ", ".join(given.columns)
    spark.sql(f"INSERT INTO wardflow_declared_providers ({columns}) SELECT {columns} FROM wardflow_given_providers")
    out = spark.table("wardflow_declared_providers").select("prov_id", "department", "active")
    return out


@query
def imported_rows(spark, sf):
    """A table copied with its load time and batch, read back from where it was written."""
    path = f"{new_workspace(spark, 'import')}/customer"
    ctas(with_lineage(td.load(spark, sf, "customer"), "BATCH-7", td.LOADED_AT), path)
    return read(spark, path)


# --- governance --------------------------------------------------------------------------------------------------------------


def _masked(role: str) -> Query:
    def run(spark, sf):
        seen = apply.governed(td.patients(spark, sf), "raw.patient_dim", role, clinical_registry())
        return seen.select("pat_id", "pat_mrn", "pat_first_name", "ssn", "phone", "email", "birth_date", "city")

    return run


for _role in ("ADMIN", "CLINICIAN", "ANALYST"):
    QUERIES[f"masked_patients_{_role.lower()}"] = _masked(_role)


@query
def filter_on_masked(spark, sf):
    """A filter above the mask sees masked values only, so it cannot find rows by a hidden value."""
    seen = apply.governed(td.patients(spark, sf), "raw.patient_dim", "ANALYST", clinical_registry())
    hit = F.col("ssn").isin("000-00-0007", "***-**-****")
    return seen.where(hit).agg(F.count("*").alias("n_rows"), F.count_distinct("ssn").alias("n_values"))


def _row_filtered(role: str) -> Query:
    def run(spark, sf):
        reg = Registry()
        reg.set_row_policy("raw.provider_dim", DEPARTMENT_ROW_FILTER)
        access = td.department_access(spark, sf)
        return apply.governed(td.providers(spark, sf), "raw.provider_dim", role, reg, access).select("prov_id", "department")

    return run


for _role in ("ADMIN", "CLINICIAN", "ANALYST", "VISITOR"):
    QUERIES[f"row_policy_{_role.lower()}"] = _row_filtered(_role)


def _governed_view(role: str) -> Query:
    def run(spark, sf):
        """A view keeps its masks; a copy made of the table itself has none."""
        people, path = td.patients(spark, sf), f"{new_workspace(spark, 'copy')}/patients"
        name = f"wardflow_patients_{role.lower()}"
        apply.governed_view(name, people, "raw.patient_dim", role, clinical_registry())
        ctas(people, path)
        copied = read(spark, path).select("pat_id", F.col("ssn").alias("copied_ssn"))
        return spark.sql(f"SELECT pat_id, ssn, pat_first_name FROM {name}").join(copied, "pat_id")

    return run


for _role in ("CLINICIAN", "ANALYST"):
    QUERIES[f"governed_view_{_role.lower()}"] = _governed_view(_role)


@query
def classified_columns(spark, sf):
    return classify.classify(td.patients(spark, sf).drop("load_ts"))


@query
def classified_documents(spark, sf):
    """How many texts, pages and sources hold an address, a phone or a number like an SSN anywhere."""
    docs = td.load(spark, sf, "documents").select("text", "source")
    patterns = {c: classify.VALUE_PATTERNS[c] for c in ("SSN", "EMAIL", "PHONE")}
    return classify.classify(docs, patterns, {}, threshold=0.01, anywhere=True)


def _tag_refs(spark, sf) -> DataFrame:
    """Tags recommended by scanning whole tables."""
    people = classify.recommended_tags(classify.classify(td.patients(spark, sf)), "raw.patient_dim")
    vendor = classify.recommended_tags(classify.classify(td.vendor_labs(spark, sf)), "raw.vendor_labs")
    return people.unionByName(vendor)


@query
def recommended_tags(spark, sf):
    return _tag_refs(spark, sf)


@query
def tag_search(spark, sf):
    return find_tagged(_tag_refs(spark, sf), "PII_TYPE", value="MRN", domain="COLUMN", database="LAB")


@query
def tagged_columns(spark, sf):
    return tag_coverage(_tag_refs(spark, sf))


def _labels(spark, sf) -> DataFrame:
    rows = [("PII_TYPE", "SSN", "Highly Confidential"), ("PII_TYPE", "MRN", "Confidential")]
    return spark.createDataFrame(rows, "tag_name string, tag_value string, label string")


@query
def label_mapping(spark, sf):
    out = map_labels(_tag_refs(spark, sf), _labels(spark, sf))
    return out.select("object_name", "column_name", "tag_value", "label")


@query
def label_gaps(spark, sf):
    out = unmapped_labels(_tag_refs(spark, sf), _labels(spark, sf))
    return out.select("object_name", "column_name", "tag_value")


@query
def tag_masked_documents(spark, sf):
    """A mask bound to a tag protects the column that carries it, here through a derived column."""
    reg = Registry()
    reg.define_tag("PII_TYPE", ["EMAIL"])
    reg.set_tag("PII_TYPE", "EMAIL", table="raw.documents", column="text")
    reg.set_tag_mask("PII_TYPE", MASK_PII_STRING)
    docs = apply.tag_frame(td.load(spark, sf, "documents"), reg, "raw.documents")
    derived = docs.select("doc_id", "lang", F.upper("text").alias("loud"))
    derived = apply.propagate_tags(derived, {"loud": [(docs, "text")]})
    seen = apply.governed(derived, "curated.loud_documents", "ANALYST", reg)
    return seen.groupBy("lang", "loud").agg(F.count("*").alias("n_docs"))


@query
def inherited_masks(spark, sf):
    """Tags follow texts through a join, a union, expressions and aggregates by the plan alone: the analyst sees masks, no
    numbers worked out from the texts, and only the counts that are released."""
    reg = Registry()
    reg.define_tag("PII_TYPE", ["EMAIL"])
    reg.set_tag("PII_TYPE", "EMAIL", table="raw.documents", column="text")
    reg.set_tag_mask("PII_TYPE", MASK_PII_STRING)
    docs = apply.tag_frame(td.load(spark, sf, "documents"), reg, "raw.documents")
    heads = docs.select("doc_id", "lang", F.lower(F.substring("text", 1, 9)).alias("piece"), F.length("text").alias("n"))
    turns = td.load(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.lit("turn").alias("lang"), F.col("role").alias("piece"), F.length("role").alias("n"))
    known = heads.unionByName(turns).join(td.load(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    found = known.groupBy("lang").agg(F.max("piece").alias("last_piece"), F.sum("n").alias("n_chars"), F.count("piece").alias("n_pieces"), F.max("quality").alias("best"), F.count("*").alias("n_rows"))
    return apply.governed(lineage.release(found, "n_pieces"), "gold.pieces", "ANALYST", reg)


# --- annotation --------------------------------------------------------------------------------------------------------------


@query
def note_previews(spark, sf):
    return annotate.previews(td.load(spark, sf, "documents"), "text", 120, "doc_id", "lang")


@query
def note_summaries(spark, sf):
    out = annotate.annotate_text(td.load(spark, sf, "documents"), "text")
    return out.select("doc_id", "summary")


@query
def extracted_fields(spark, sf):
    patterns = {
        "email": classify.VALUE_PATTERNS["EMAIL"],
        "first_number": r"[0-9]+",
        "first_word": r"([A-Za-z]+)",
    }
    out = annotate.extract_fields(td.load(spark, sf, "documents"), "text", patterns, required_text={"email": "@"})
    return out.select("doc_id", "extracted.email", "extracted.first_number", "extracted.first_word")


@query
def looked_up_annotations(spark, sf):
    docs = td.load(spark, sf, "documents").select("doc_id", "lang")
    return annotate.lookup_annotations(docs, td.load(spark, sf, "labels"), "doc_id")


@query
def described_parts(spark, sf):
    """A catalog line per part, stored as a new column of the table."""
    parts = td.load(spark, sf, "part").withColumn("ai_description", F.lit(None).cast("string"))
    labels = [("Type", "p_type"), ("Brand", "p_brand"), ("Name", "p_name")]
    path = f"{new_workspace(spark, 'parts')}/part"
    ctas(annotate.describe_images(parts, labels), path)
    return read(spark, path).select("p_partkey", "ai_description")


@query
def review_tiers(spark, sf):
    size = F.col("p_size")
    steps = [(30, "large"), (15, "medium")]
    return td.load(spark, sf, "part").select(
        "p_partkey", review_tier(size).alias("tier"), bucket(size, steps, "small").alias("size_class")
    )


@query
def categorized_turns(spark, sf):
    rules = [(r"[0-9]", "numbers"), (r"\?", "question"), (r"\n", "list")]
    out = annotate.categorize(td.load(spark, sf, "conversations"), "text", rules)
    return out.groupBy("role", "category").agg(F.count("*").alias("n_turns"))


def _word_counter():
    """A stand-in for a model: it counts words, and its first call fails, as a service may that is not awake yet."""
    import re

    asleep = [True]

    def model(texts: list[str]) -> list[str]:
        if asleep.pop() if asleep else False:
            raise ConnectionError("not awake yet")
        return [f"{len(re.findall('[A-Za-z]+', t))} words" for t in texts]

    return model


@query
def modelled_notes(spark, sf):
    """Annotations by a model that every worker loads once; the first call of each fails and is repeated."""
    docs = td.load(spark, sf, "documents").withColumn("text", F.when(F.col("doc_id") % 50 == 0, "").otherwise(F.col("text")))
    return annotate.annotate_with_model(docs, "text", _word_counter, error="problem", wait=0.0).select("doc_id", "summary", "problem")


@query
def ruled_turns(spark, sf):
    """Turns of conversations by the first rule of a table with a rule for every word of the benchmark texts."""
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = td.load(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(folded, F.lit("[a-z0-9]+"), F.lit(0))).alias("trigger"))
    size = F.length("trigger")
    rules = words.groupBy("trigger").agg(F.count("*").alias("priority")).select(
        "priority", "trigger", F.concat(F.lit("(^|[^a-z0-9])"), "trigger", F.lit("([^a-z0-9]|$)")).alias("pattern"),
        F.concat(F.lit("word of "), F.when(size < 10, F.concat(F.lit("0"), size.cast("string"))).otherwise(size.cast("string"))).alias("category"),
    )
    spoken = F.concat_ws("-", "conv_id", "turn")
    turns = td.load(spark, sf, "conversations").withColumn("turn_key", spoken)
    return annotate.categorize_by_rules(turns, "text", "turn_key", rules).groupBy("role", "category").agg(F.count("*").alias("n_turns"))


# --- listings ----------------------------------------------------------------------------------------------------------------


@query
def listed_graph(spark, sf):
    """The tables of the graph with lag, inputs and the state of their last refresh, after only providers and patients came."""
    graph = clinical_graph("1 minute", "1 hour")
    store = GraphRefresher(spark, graph, new_workspace(spark, "graph"), n_buckets=2)
    store.land("raw.provider_dim", td.providers(spark, sf))
    store.land("raw.patient_dim", td.patients(spark, sf))
    store.refresh_available(only=["gold.patient_encounter_summary"])
    listed = graph.listing(spark, history=store.history(1000))
    rows = store.table("gold.patient_encounter_summary", td.AS_OF).agg(F.count("*").alias("n")).first().n
    return listed.select("name", "target_lag", "scheduling_state", F.array_join("inputs", ", ").alias("inputs"), F.lit(rows).alias("summary_rows"))


@query
def protected_columns(spark, sf):
    """Which policy protects which column of the patients, by which tag, and how many values that covers."""
    reg, people = clinical_registry(), td.patients(spark, sf)
    refs = reg.policy_references(people, "raw.patient_dim").withColumnRenamed("ref_column_name", "column_name")
    columns = [r.column_name for r in refs.select("column_name").collect()]  # declarations, a few per table
    counts = people.agg(*[F.count(c).alias(c) for c in columns]).unpivot([], columns, "column_name", "n_values")
    return refs.join(counts, "column_name").select("policy_name", "policy_kind", "column_name", "tag_name", "n_values")


@query
def schema_scan(spark, sf):
    """The columns of two tables with their place and how many values each has."""
    found = None
    for name in ("customer", "documents"):
        df = td.load(spark, sf, name)
        filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "n_values")
        listed = table_columns(df).join(filled, "column_name").select(F.lit(name).alias("table_name"), "ordinal", "column_name", "n_values")
        found = listed if found is None else found.unionByName(listed)
    return found


@query
def whole_text_files(spark, sf):
    """Suppliers written as one text file per nation; every file comes back as one value."""
    path = f"{new_workspace(spark, 'texts')}/suppliers"
    lines = td.load(spark, sf, "supplier").select("s_nationkey", F.concat_ws(",", "s_suppkey", "s_name").alias("line"))
    lines.repartition("s_nationkey").write.partitionBy("s_nationkey").text(path)
    content = F.array_sort(F.array_remove(F.split("content", "\n"), ""))
    return read_whole_text(spark, path).select(F.col("s_nationkey").cast("bigint").alias("s_nationkey"), F.array_join(content, "|").alias("suppliers"))

import datetime as dt

import pytest
from clinic import rows
from pyspark.sql import functions as F

from wardflow.operators import routing, validation
from wardflow.operators.imports import Importer, enabled_imports, mark_run
from wardflow.operators.runlog import RunLog
from wardflow.sources.schemas import IMPORT_CONFIG, RUN_LOG, VENDOR_LAB
from wardflow.sources.tables import read, rows_frame

GOOD = [(f"VL-00000{i}", f"MRN-90000{i}", "GLU", "Glucose", "95", "mg/dL", "2024-10-20", "N") for i in range(1, 6)]
DRIFTED = [("VL-000010", "MRN-900001", "GLU", "Glucose", "99", "mg/dL", "2024-10-21", "Y"),
           ("VL-000011", "MRN-900002", "GLU", "Glucose", "90", "mg/dL", "2024-10-21", None)]
INVALID = [
    ("BADID", None, None, None, None, None, None, "X"),
    ("VL-000020\n", "MRN-900001", "GLU", "Glucose", "1", "mg/dL", "2024-10-21", "N"),
    ("VL-000021", "MRN-1", "GLU", "Glucose", "1", "mg/dL", "2024-10-21", ""),
    (None, "MRN-900001", "GLU", "Glucose", "1", "mg/dL", "2024-10-21", "Y"),
]


def batch(spark, data):
    return rows_frame(spark, data, VENDOR_LAB)


def drifted(spark):
    return batch(spark, DRIFTED).withColumns({"lab_site": F.lit("A"), "version": F.lit(2)})


def test_reasons_in_order(spark):
    got = validation.with_validation(batch(spark, INVALID)).select("is_valid", "rejection_reasons").collect()
    assert got[0] == (
        False,
        ["VENDOR_ID format invalid: BADID", "PAT_MRN is NULL", "TEST_CODE is NULL", "RESULT_DATE is NULL",
         "ABNORMAL_YN invalid value: X"],
    )
    assert got[1].rejection_reasons == ["VENDOR_ID format invalid: VL-000020\n"]
    assert got[2].rejection_reasons == ["PAT_MRN format invalid: MRN-1", "ABNORMAL_YN invalid value: "]
    assert got[3].rejection_reasons == ["VENDOR_ID is NULL"]
    good = validation.with_validation(batch(spark, GOOD)).collect()
    assert all(r.is_valid and r.rejection_reasons == [] for r in good)


def test_sql_table_function(spark):
    validation.register_sql_function(spark)
    call = "SELECT * FROM validate_vendor_lab_row({})"
    assert spark.sql(call.format("'VL-000001', 'MRN-900001', 'GLU', DATE'2024-10-20', 'N'")).first() == (True, [])
    bad = spark.sql(call.format("'BADID', NULL, NULL, NULL, 'X'")).first()
    assert bad == (False, ["VENDOR_ID format invalid: BADID", "PAT_MRN is NULL", "TEST_CODE is NULL",
                           "RESULT_DATE is NULL", "ABNORMAL_YN invalid value: X"])
    batch(spark, INVALID + GOOD).createOrReplaceTempView("src")
    got = spark.sql(
        "SELECT v.* FROM src, LATERAL validate_vendor_lab_row(src.vendor_id, src.pat_mrn, src.test_code, "
        "src.result_date, src.abnormal_yn) v"
    )
    want = validation.with_validation(batch(spark, INVALID + GOOD)).select("is_valid", "rejection_reasons")
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(want)))


def test_three_batches_reach_the_checkpoint(spark, root):
    log, base = RunLog(spark, f"{root}/log"), f"{root}/vendor"
    results = [
        routing.process_vendor_batch(batch(spark, GOOD), base, "GOOD-001", log),
        routing.process_vendor_batch(drifted(spark), base, "DRIFT-001", log),
        routing.process_vendor_batch(batch(spark, INVALID), base, "INVALID-001", log),
    ]
    assert [r.message for r in results] == [
        "Accepted: 5, Quarantined: 0", "Accepted: 2, Quarantined: 0", "Accepted: 0, Quarantined: 4",
    ]
    assert routing.accepted(spark, base).count() == 7 and routing.quarantined(spark, base).count() == 4
    assert routing.accepted(spark, base).columns == [*VENDOR_LAB.names, "batch_id"]
    report = {r.vendor_id: r.reasons for r in validation.quarantine_report(routing.quarantined(spark, base)).collect()}
    assert report[None] == '["VENDOR_ID is NULL"]'
    warned = {r.message for r in read(spark, f"{root}/log", RUN_LOG).where("log_level = 'WARN'").collect()}
    assert warned == {
        "Schema drift detected: incoming has 10 columns, expected 8",
        "4 rows quarantined - review the quarantine table",
    }


def test_rerun_replaces_or_skips(spark, root):
    mixed = batch(spark, GOOD + INVALID)
    first = routing.route_batch(mixed, root, "001")
    assert (first.accepted, first.quarantined) == (5, 4)
    again = routing.route_batch(batch(spark, GOOD), root, "001")  # the corrected file has no bad rows left
    assert (again.accepted, again.quarantined) == (5, 0)
    assert routing.quarantined(spark, root).count() == 0
    skipped = routing.route_batch(mixed, root, "001", mode="skip")
    assert (skipped.status, skipped.accepted, skipped.quarantined) == ("SKIPPED", 5, 0)
    assert routing.route_batch(mixed, root, "002", mode="skip").status == "ROUTED"
    assert {r.batch_id for r in routing.routed(spark, root).select("batch_id").collect()} == {"001", "002"}
    routing.delete_batch(spark, root, "002")
    assert routing.routed(spark, root).count() == 5
    assert dict(rows(routing.batches(spark, root), "batch_id", "state")) == {"001": "ROUTED", "002": "DELETED"}
    assert routing.route_batch(mixed, root, "002", mode="skip").status == "ROUTED"  # a removed batch may come again


def broken(df):
    return df.withColumn("vendor_id", F.expr("if(pat_mrn = 'MRN-900003', raise_error('torn file'), vendor_id)"))


@pytest.mark.parametrize("mode", ["replace", "merge"])
def test_a_failed_rerun_changes_nothing(spark, root, mode):
    assert routing.batches(spark, root).count() == 0 == routing.routed(spark, root).count()
    good = batch(spark, [(v, f"MRN-90000{i}", *rest[1:]) for i, (v, *rest) in enumerate(GOOD, 1)])
    with pytest.raises(Exception, match="torn file"):
        routing.route_batch(broken(good), root, "001", mode=mode)
    assert [tuple(r) for r in routing.batches(spark, root).collect()] == [("001", "FAILED", 0, 0, "FAILED")]
    routing.route_batch(good, root, "001")
    want = rows(routing.accepted(spark, root))
    assert len(want) == 5
    with pytest.raises(Exception, match="torn file"):
        routing.route_batch(broken(good).repartition(5), root, "001", mode=mode)
    assert rows(routing.accepted(spark, root)) == want
    assert [tuple(r) for r in routing.batches(spark, root).collect()] == [("001", "ROUTED", 5, 0, "FAILED")]
    assert routing.route_batch(good.limit(1), root, "001", mode="skip").status == "SKIPPED"


def test_skip_looks_for_the_rows(spark, root):
    from wardflow.sources import files
    from wardflow.sources.snapshots import SnapshotTable

    routing.route_batch(batch(spark, GOOD + INVALID), root, "001")
    table = SnapshotTable(spark, f"{root}/batch_id=001")
    files.delete(spark, f"{table.latest().paths(table.root)[0]}/status=quarantined")
    again = routing.route_batch(batch(spark, GOOD + INVALID), root, "001", mode="skip")
    assert (again.status, again.quarantined) == ("ROUTED", 4) and routing.quarantined(spark, root).count() == 4


def test_merge_updates_by_key(spark, root):
    keys = ["vendor_id"]
    first = routing.route_batch(batch(spark, GOOD + INVALID), root, "001", mode="merge", keys=keys)
    assert (first.accepted, first.quarantined) == (5, 4)
    # One row is new, one changes its value, one that was rejected comes right, one that was good comes wrong.
    newer = [("VL-000009", *GOOD[0][1:]), (GOOD[0][0], *GOOD[0][1:4], "7", *GOOD[0][5:]),
             ("VL-000021", "MRN-900001", "GLU", "Glucose", "1", "mg/dL", "2024-10-21", "N"), (*GOOD[1][:7], "?")]
    for _ in range(2):
        result = routing.route_batch(batch(spark, newer), root, "001", mode="merge", keys=keys)
        assert (result.accepted, result.quarantined) == (6, 4)
    good = dict(rows(routing.accepted(spark, root), "vendor_id", "result_value"))
    assert good == {"VL-000001": "7", "VL-000003": "95", "VL-000004": "95", "VL-000005": "95", "VL-000009": "95", "VL-000021": "1"}
    bad = {r.vendor_id: r.rejection_reasons for r in routing.quarantined(spark, root).collect()}
    assert bad["VL-000002"] == ["ABNORMAL_YN invalid value: ?"] and set(bad) == {"VL-000002", "BADID", "VL-000020\n", None}
    assert [tuple(r) for r in routing.batches(spark, root).collect()] == [("001", "ROUTED", 6, 4, "ROUTED")]
    routing.route_batch(batch(spark, [(None, *GOOD[0][1:])]), root, "001", mode="merge", keys=keys)  # a missing key is a key
    assert routing.quarantined(spark, root).where("vendor_id IS NULL").count() == 1


def test_failed_import_keeps_the_rows(spark, root, importer):
    importer.run_import("alpha", "B-1")
    broken_rows = spark.range(6).select(F.when(F.col("id") == 5, F.raise_error(F.lit("torn file")).cast("long")).otherwise(F.col("id")).alias("id"))
    spark.range(3).write.mode("overwrite").parquet(f"{root}/raw/alpha")
    import wardflow.operators.imports as imports

    known = imports.read
    imports.read = lambda *a: broken_rows if a[1].endswith("/alpha") else known(*a)
    try:
        assert importer.run_import("alpha", "B-2").status == "FAILED"
    finally:
        imports.read = known
    kept = read(spark, f"{root}/curated/a")
    assert kept.count() == 5 and {r.batch_id for r in kept.collect()} == {"B-1"}
    assert {r.source_table: r.last_run_status for r in importer.status().collect()}["alpha"] == "FAILED"


def test_empty_batch(spark, root):
    result = routing.route_batch(batch(spark, []), root, "EMPTY")
    assert (result.accepted, result.quarantined) == (0, 0)


def test_bad_arguments(spark, root):
    with pytest.raises(ValueError, match="batch id"):
        routing.route_batch(batch(spark, GOOD), root, "../x")
    with pytest.raises(ValueError, match="mode"):
        routing.route_batch(batch(spark, GOOD), root, "x", mode="other")


def test_failure_is_reported(spark, root):
    broken = batch(spark, GOOD).withColumn("vendor_id", F.expr("raise_error('torn file')").cast("string"))
    result = routing.process_vendor_batch(broken, f"{root}/v", "B-1", RunLog(spark, f"{root}/log"))
    assert result.status == "FAILED" and "torn file" in result.message
    assert read(spark, f"{root}/log", RUN_LOG).where("log_level = 'ERROR'").count() == 1


def test_drift(spark):
    df = drifted(spark).drop("result_unit").withColumn("result_value", F.lit(1))
    drift = validation.detect_drift(df, VENDOR_LAB)
    assert (drift.incoming, drift.expected, drift.drifted) == (9, 8, True)
    assert set(drift.differences) == {
        ("missing", "result_unit", "string", None), ("retyped", "result_value", "string", "int"),
        ("extra", "lab_site", None, "string"), ("extra", "version", None, "int"),
    }
    report = {r.column_name: r.rows_with_value for r in validation.drift_report(df, VENDOR_LAB).collect()}
    assert report == {"result_unit": 0, "result_value": 2, "lab_site": 2, "version": 2}
    assert not validation.detect_drift(batch(spark, GOOD), VENDOR_LAB).differences
    assert validation.drift_report(batch(spark, GOOD), VENDOR_LAB).count() == 0


def test_missing_column_is_a_reason(spark, root):
    result = routing.route_batch(batch(spark, GOOD).drop("test_code"), root, "B")
    assert (result.accepted, result.quarantined) == (0, 5)
    assert routing.quarantined(spark, root).first().rejection_reasons == ["TEST_CODE is NULL"]


def test_reason_counts(spark):
    got = dict(rows(validation.reason_counts(validation.with_validation(batch(spark, INVALID)))))
    assert got["VENDOR_ID format invalid"] == 2 and got["VENDOR_ID is NULL"] == 1


def test_normalize_formats(spark):
    raw = spark.createDataFrame([(" vl-1 ", "20.10.2024", ""), ("VL-2", "2024-10-20", "y"), (None, "?", " N")],
                                "vendor_id string, result_date string, abnormal_yn string")
    spec = {
        "vendor_id": ["trim", "upper"],
        "result_date": [("date", "yyyy-MM-dd", "dd.MM.yyyy")],
        "abnormal_yn": ["trim", "upper", "empty_to_null"],
    }
    day = dt.date(2024, 10, 20)
    assert rows(validation.normalize_formats(raw, spec)) == [("VL-1", day, None), ("VL-2", day, "Y"), (None, None, "N")]
    with pytest.raises(ValueError, match="unknown step"):
        validation.normalize_formats(raw, {"vendor_id": [("other",)]})


@pytest.fixture
def importer(spark, root):
    data = [
        (2, "raw", "beta", "curated", "b", "id", True),
        (1, "raw", "alpha", "curated", "a", "id", True),
        (3, "raw", "gone", "curated", "g", "id", True),
        (4, "raw", "alpha_off", "curated", "off", "id", False),
    ]
    spark.range(5).write.parquet(f"{root}/raw/alpha")
    spark.range(7).write.parquet(f"{root}/raw/beta")
    config = rows_frame(spark, data, IMPORT_CONFIG)
    return Importer(spark, config, RunLog(spark, f"{root}/log"), f"{root}/status", lambda s, t: f"{root}/{s}/{t}")


def test_imports(spark, root, importer):
    results = importer.run_all_imports("BATCH-2024-10-25-001")
    assert [(r.source_table, r.status, r.rows_loaded) for r in results] == [
        ("alpha", "SUCCESS", 5), ("beta", "SUCCESS", 7), ("gone", "FAILED", None),
    ]
    assert results[0].message == "SUCCESS: Loaded into curated.a"
    loaded = read(spark, f"{root}/curated/a")
    assert loaded.columns == ["id", "loaded_at", "batch_id"]
    assert {r.batch_id for r in loaded.collect()} == {"BATCH-2024-10-25-001"}
    status = {r.source_table: r.last_run_status for r in importer.status().collect()}
    assert status == {"alpha": "SUCCESS", "beta": "SUCCESS", "gone": "FAILED", "alpha_off": None}
    assert importer.run_import("alpha_off", "B").status == "DISABLED"
    assert importer.run_import("nothing", "B").status == "UNKNOWN"
    assert importer.run_import("beta", "B-2").status == "SUCCESS"
    assert {r.batch_id for r in read(spark, f"{root}/curated/b").collect()} == {"B-2"}

    from wardflow.operators.runlog import batch_health, import_details

    log = read(spark, f"{root}/log", RUN_LOG)
    details = {(r.target_table, int(r.rows_loaded)) for r in import_details(log).collect()}
    assert details == {("curated.a", 5), ("curated.b", 7)}
    health = {r.batch_prefix: r.health_status for r in batch_health(log).collect()}
    assert health == {"BATCH-2024": "RED", "B-2": "GREEN"}
    assert [r.source_table for r in enabled_imports(importer.config).collect()] == ["alpha", "beta", "gone"]


def test_newest_status_counts(spark, importer):
    mark_run(spark, importer.status_target, "alpha", "FAILED", dt.datetime(2024, 1, 1))
    mark_run(spark, importer.status_target, "alpha", "SUCCESS", dt.datetime(2024, 1, 2))
    row = importer.status().where("source_table = 'alpha'").first()
    assert (row.last_run_status, row.last_run_ts) == ("SUCCESS", dt.datetime(2024, 1, 2))


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    import pytest

    from wardflow import session

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

        def set(self, key, value):
            self.values[key] = value

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("__", "."): v for k, v in values.items()})

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_dir(Session(spark__master=master))
    assert session.shared_dir(Session(spark__master="yarn", spark__checkpoint__dir="s3a://b/c/")) == "s3a://b/c"
    local = Session(spark__master="local[4]")
    assert session.shared_dir(local) == session.shared_dir(local)

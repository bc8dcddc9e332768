import datetime as dt

from clinic import rows

from wardflow.operators import runlog
from wardflow.sources.schemas import RUN_LOG
from wardflow.sources.tables import append, read, rows_frame
from wardflow.streaming import alerts

EVENTS = [
    ("BATCH-2024-10-25-001-a", "RUN_IMPORT", "INFO", "Starting import of T1", '{"target":"c.t1"}', "2024-10-25 01:00:00"),
    ("BATCH-2024-10-25-002-b", "RUN_IMPORT", "INFO", "Completed import of T1", '{"target":"c.t1","rows_loaded":5,"batch_id":"B"}', "2024-10-25 01:59:59"),
    ("GOOD-001-c", "PROCESS", "INFO", "Batch complete", '{"accepted":5,"quarantined":0,"batch_id":"GOOD-001"}', "2024-10-25 02:00:00"),
    ("GOOD-001-c", "PROCESS", "WARN", "3 rows quarantined", None, "2024-10-25 02:00:30"),
    ("BAD-001-d", "PROCESS", "ERROR", "Cannot read 'file1' after 3 tries", None, "2024-10-25 02:10:00"),
    ("BAD-001-e", "PROCESS", "ERROR", "Cannot read 'file2' after 10 tries", None, "2024-10-25 02:11:00"),
]


def log(spark):
    return rows_frame(spark, EVENTS, RUN_LOG)


def test_summary(spark):
    got = rows(runlog.run_summary(log(spark)))
    assert got[0][:4] == (dt.datetime(2024, 10, 25, 2), "PROCESS", "ERROR", 2)
    assert got[-1] == (dt.datetime(2024, 10, 25, 1), "RUN_IMPORT", "INFO", 2, dt.datetime(2024, 10, 25, 1),
                       dt.datetime(2024, 10, 25, 1, 59, 59))


def test_health(spark):
    got = {r.batch_prefix: r for r in runlog.batch_health(log(spark)).collect()}
    assert {k: r.health_status for k, r in got.items()} == {
        "BATCH-2024": "GREEN", "GOOD-001": "YELLOW", "BAD-001": "RED",
    }
    assert got["BATCH-2024"].duration_sec == 3599 and got["BAD-001"].error_count == 2
    by_step = {r.batch_prefix: r.health_status for r in runlog.batch_health(log(spark), "step_name").collect()}
    assert by_step == {"RUN_IMPORT": "GREEN", "PROCESS": "RED"}


def test_details(spark):
    assert rows(runlog.import_details(log(spark)), "rows_loaded", "target_table", "batch_id") == [(5, "c.t1", "B")]
    assert rows(runlog.quarantine_details(log(spark)), "accepted", "quarantined") == [(5, 0)]


def test_problem_events_newest_first(spark):
    assert [r[0] for r in rows(runlog.problem_events(log(spark)))] == ["BAD-001-e", "BAD-001-d", "GOOD-001-c"]
    assert runlog.events_of(log(spark), "GOOD-001-c").count() == 2


def test_recent_errors(spark):
    assert runlog.has_recent_errors(log(spark), 5, "2024-10-25 02:15:00")
    assert runlog.recent_errors(log(spark), 5, "2024-10-25 02:15:00").count() == 1  # 02:10:00 is not later than 02:10
    assert not runlog.has_recent_errors(log(spark), 5, "2024-10-25 03:00:00")


def test_patterns(spark):
    got = rows(runlog.error_patterns(log(spark), 5))
    assert [r[:2] for r in got] == [("Cannot read <text> after <n> tries", 2)]


def test_log_event(spark, root):
    assert runlog.log_event(spark, root, "MANUAL-1", "STEP", "info", "it's \"quoted\"", {"test": True}) == "LOGGED"
    row = runlog.events_of(read(spark, root, RUN_LOG), "MANUAL-1").first()
    assert row.log_level == "INFO" and row.message == "it's \"quoted\"" and row.logged_at is not None
    assert row.detail.toPython() == {"test": True}
    with runlog.RunLog(spark, root) as many:
        for i in range(20):
            many.event(f"R-{i}", "S", "warn", "m")
    assert read(spark, root, RUN_LOG).count() == 21


def test_streams_over_the_log(spark, root):
    path, schema = f"{root}/log", log(spark).schema
    append(log(spark), path)
    stream = alerts.log_stream(spark, path, schema)
    found = alerts.error_alerts(stream)

    def run():
        alerts.write_alerts(found, f"{root}/alerts", f"{root}/state", every=None).awaitTermination()
        return sorted(rows(read(spark, f"{root}/alerts", found.schema), "window_start", "error_count"))

    run()
    # A healthy event closes the window although it is no error; a second round sees the new watermark.
    append(rows_frame(spark, [("OK-1", "S", "INFO", "fine", None, "2024-10-25 04:00:00")], RUN_LOG), path)
    run()
    assert run() == [(dt.datetime(2024, 10, 25, 2, 10), 2)]
    assert rows(alerts.error_alerts(log(spark)), "error_count") == [(2,)]

    summary = alerts.run_summary_stream(stream)
    query = summary.writeStream.format("memory").queryName("hours").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.log_hour.hour, r.step_name, r.log_level): r.event_count for r in spark.table("hours").collect()}
    assert got[1, "RUN_IMPORT", "INFO"] == 2 and got[2, "PROCESS", "ERROR"] == 2


def line(spark, *events):
    return rows_frame(spark, [("R", step, level, "m", None, f"2024-10-25 {at}") for step, level, at in events], RUN_LOG)


def test_alerts_are_raised_at_once_and_cleared_by_a_timer(spark, root):
    path, schema = f"{root}/log", log(spark).schema

    def after(*events):
        if events:
            append(line(spark, *events), path)
        found = alerts.step_alerts(alerts.log_stream(spark, path, schema), late="0 seconds")
        alerts.start_alerts(found, f"{root}/alerts", f"{root}/state", every=None).awaitTermination()
        got = rows(spark.read.schema(found.schema).parquet(f"{root}/alerts"), "step_name", "event", "at", "error_count")
        return sorted((s, e, f"{at:%H:%M:%S}", n) for s, e, at, n in got)

    raised = [("LOAD", "RAISED", "02:00:00", 1)]
    assert after(("LOAD", "ERROR", "02:00:00")) == raised  # no other event has to come first
    assert after(("LOAD", "ERROR", "02:04:59"), ("LOAD", "INFO", "02:05:00")) == raised  # prolonged, not raised again
    assert after(("LOAD", "WARN", "02:09:58")) == raised
    # A healthy event of another step moves time: five minutes after the last error the timer clears the alert.
    cleared = [("LOAD", "CLEARED", "02:09:59", 2), *raised]
    assert after(("SAVE", "INFO", "02:10:00")) == cleared
    again = [("LOAD", "RAISED", "02:20:00", 3), ("SAVE", "RAISED", "02:20:00", 1)]
    assert after(*[("LOAD", "ERROR", t) for t in ("02:22:00", "02:20:00", "02:21:00")], ("SAVE", "ERROR", "02:20:00")) == sorted(cleared + again)
    # Backlog: spells that are over are cleared in the trigger that reads them; errors from before stand alone.
    late = [("LOAD", "RAISED", "01:00:00", 1), ("LOAD", "CLEARED", "01:05:00", 1)]
    more = [("LOAD", "CLEARED", "02:27:00", 3), ("LOAD", "RAISED", "03:00:00", 1), ("SAVE", "CLEARED", "02:25:00", 1)]
    assert after(("LOAD", "ERROR", "03:00:00"), ("LOAD", "ERROR", "01:00:00")) == sorted(cleared + again + late + more)
    assert after() == sorted(cleared + again + late + more)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != alerts.STATE_STORE


def test_steps_and_times_may_be_missing(spark, root):
    path, schema = f"{root}/log", log(spark).schema
    broken = [("R", None, "ERROR", "m", None, "2024-10-25 02:00:00"), ("R", "A", "ERROR", "m", None, None), ("R", "A", None, "m", None, "2024-10-25 02:00:00")]
    append(rows_frame(spark, broken, RUN_LOG), path)
    append(line(spark, *[("HOT", "ERROR", f"03:00:{i % 60:02d}") for i in range(3000)]).repartition(8), path)
    found = alerts.step_alerts(alerts.log_stream(spark, path, schema))
    alerts.start_alerts(found, f"{root}/alerts", f"{root}/state", every=None).awaitTermination()
    got = rows(spark.read.schema(found.schema).parquet(f"{root}/alerts"), "step_name", "event", "error_count")
    assert set(got) >= {("HOT", "RAISED", 3000), (None, "RAISED", 1)} and not any(s == "A" for s, *_ in got)


def test_spells_join_in_any_order():
    import random

    r = random.Random(4)
    for _ in range(200):
        times = [r.randint(0, 400) for _ in range(r.randint(1, 30))]
        whole = alerts.joined_spells([(t, t, 1) for t in times], 10)
        parts = [times[i::3] for i in range(3)]
        packed = [s for p in parts for s in alerts.joined_spells([(t, t, 1) for t in p], 10)]
        r.shuffle(packed)
        assert alerts.joined_spells(packed, 10) == whole
        ordered = sorted(times)
        assert len(whole) == 1 + sum(b - a >= 10 for a, b in zip(ordered, ordered[1:], strict=False))


def test_windows_are_current_after_every_trigger(spark, root):
    path, schema = f"{root}/log", log(spark).schema

    def after(*events):
        append(line(spark, *events), path)
        found = alerts.error_alerts(alerts.log_stream(spark, path, schema))
        alerts.keep_current(found, f"{root}/alerts", f"{root}/state", ["window_start"], every=None).awaitTermination()
        return sorted((w.minute, n) for w, n in rows(read(spark, f"{root}/alerts"), "window_start", "error_count"))

    assert after(("LOAD", "INFO", "02:00:00")) == []
    assert after(("LOAD", "ERROR", "02:01:00")) == [(0, 1)]
    assert after(("LOAD", "ERROR", "02:02:00"), ("SAVE", "ERROR", "02:06:00")) == [(0, 2), (5, 1)]
    assert after(("LOAD", "INFO", "05:00:00")) == [(0, 2), (5, 1)]


def test_details_that_do_not_fit(spark):
    from pyspark.sql import functions as F

    from wardflow.functions.details import detail_field, has_field, misfits

    raw = spark.createDataFrame([('{"k": "many"}',), ("no json",), ('{"k": 4}',), (None,)], "d string")
    parsed = raw.select(F.try_parse_json("d").alias("v"))
    assert [r[0] for r in parsed.select(detail_field(F.col("v"), "k", "bigint")).collect()] == [None, None, 4, None]
    assert [r[0] for r in parsed.select(has_field(F.col("v"), "k")).collect()][:1] == [True]
    assert raw.agg(misfits(F.col("d"))).first()[0] == 1

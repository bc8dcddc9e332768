"""Split a batch into accepted and quarantined rows in one pass and one write."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.runlog import RunLog, make_run_id
from wardflow.operators.validation import REJECTED, VENDOR_LAB_RULES, Drift, Rule, align, detect_drift, with_validation
from wardflow.sources.files import write_text
from wardflow.sources.schemas import BATCH_RUN, VENDOR_LAB
from wardflow.sources.snapshots import RUN, SnapshotTable, Version, newest_versions

ACCEPTED, QUARANTINED = "accepted", "quarantined"
STEP = "PROCESS_VENDOR_BATCH"
# What names a lab result that is sent again.
KEYS = ("vendor_id", "pat_mrn", "test_code", "result_date")


@dataclass(frozen=True)
class BatchResult:
    batch_id: str
    status: str  # ROUTED, SKIPPED or FAILED
    accepted: int = 0
    quarantined: int = 0
    drift: Drift | None = None
    error: str | None = None

    @property
    def message(self) -> str:
        if self.status == "FAILED":
            return f"FAILED: {self.error}"
        return f"Accepted: {self.accepted}, Quarantined: {self.quarantined}"


def route_batch(
    df: DataFrame,
    base: str,
    batch_id: str,
    rules: Sequence[Rule] = VENDOR_LAB_RULES,
    schema: T.StructType = VENDOR_LAB,
    mode: str = "replace",
    keys: Sequence[str] = KEYS,
) -> BatchResult:
    """Validate a batch and write it, split by status, as the next version of the table ``base/batch_id=...``.

    A second run of a batch replaces its rows (mode "replace"), updates them by key (mode "merge": rows of a key that
    comes again take the new values and may change their status, other keys stay) or leaves them alone (mode "skip", if
    all rows of the earlier run are still there). Rows never double. The rows of an earlier run count until the new ones
    are written as a whole, so a run that fails changes nothing. There is no shuffle when a batch is replaced: every
    task writes its own rows, whatever their status; the counts are collected during the write.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch_id):
        raise ValueError(f"batch id {batch_id!r} cannot name a folder")
    if mode not in ("replace", "merge", "skip"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    drift = detect_drift(df, schema)
    table = SnapshotTable(spark, f"{base}/batch_id={batch_id}")
    if mode == "skip":
        done = table.latest()
        if done is not None and done.note["state"] == "ROUTED" and _intact(table, done):
            return BatchResult(batch_id, "SKIPPED", int(done.note[ACCEPTED]), int(done.note[QUARANTINED]), drift)
    _record(spark, base, batch_id, "STARTED")
    try:
        checked = with_validation(align(df, schema), rules)
        status = F.when(F.col("is_valid"), ACCEPTED).otherwise(QUARANTINED).alias("status")
        rows = checked.select(*[c for c in checked.columns if c != "is_valid"], status)
        if mode == "merge" and table.latest() is not None:
            version = table.merge(rows, keys, lambda stored: {"state": "ROUTED", **_counted(stored)})
        else:
            seen = Observation()
            counts = [F.count_if(F.col("status") == s).alias(s) for s in (ACCEPTED, QUARANTINED)]
            run, n = table.written(rows.observe(seen, *counts), ["status"])
            version = table.adopt(run, rows.schema, ["status"], n, {"state": "ROUTED", **seen.get})
    except Exception:
        _record(spark, base, batch_id, "FAILED")
        raise
    accepted, quarantined = int(version.note[ACCEPTED]), int(version.note[QUARANTINED])
    _record(spark, base, batch_id, "ROUTED")
    return BatchResult(batch_id, "ROUTED", accepted, quarantined, drift)


def _counted(rows: DataFrame) -> dict[str, int]:
    """Rows by status; reads no column, as the status is a folder name."""
    found = {r.status: r["count"] for r in rows.groupBy("status").count().collect()}
    return {s: found.get(s, 0) for s in (ACCEPTED, QUARANTINED)}


def _intact(table: SnapshotTable, version: Version) -> bool:
    """Whether the rows that a version counted are still there."""
    try:
        return all(int(version.note[s]) == n for s, n in _counted(table.read(version)).items())
    except (PySparkException, Py4JJavaError):  # files are gone or torn
        return False


def delete_batch(spark: SparkSession, base: str, batch_id: str) -> None:
    """Remove the rows of one batch: its next version has none."""
    SnapshotTable(spark, f"{base}/batch_id={batch_id}").clear({"state": "DELETED", ACCEPTED: 0, QUARANTINED: 0})
    _record(spark, base, batch_id, "DELETED")


def routed(spark: SparkSession, base: str, schema: T.StructType = VENDOR_LAB) -> DataFrame:
    """The rows in force of all batches, with batch id and status (both are folder names, so filters on them skip whole
    folders). The driver gets one pointer per batch."""
    full = _routed_schema(schema).add("batch_id", "string").add("status", "string")
    paths = [p for root, version in newest_versions(spark, f"{base}/batch_id=*") for p in version.paths(root)]
    if not paths:
        return spark.createDataFrame([], full)
    with_run = T.StructType([*full.fields, T.StructField(RUN, T.StringType())])
    return spark.read.schema(with_run).option("basePath", base).parquet(*paths).select(*full.names)


def accepted(spark: SparkSession, base: str, schema: T.StructType = VENDOR_LAB) -> DataFrame:
    return routed(spark, base, schema).where(F.col("status") == ACCEPTED).drop("status", REJECTED, "rejection_reasons")


def quarantined(spark: SparkSession, base: str, schema: T.StructType = VENDOR_LAB) -> DataFrame:
    return routed(spark, base, schema).where(F.col("status") == QUARANTINED).drop("status")


def batches(spark: SparkSession, base: str) -> DataFrame:
    """Every batch with the state and counts of the rows in force, and how its last run went. A batch that was never
    routed has the state of that run; STARTED means that the run goes on or that its driver was lost."""
    try:
        runs = spark.read.schema(BATCH_RUN).json(f"{base}/_batches")
    except AnalysisException:  # nothing was routed yet
        runs = spark.createDataFrame([], BATCH_RUN)
    last = runs.groupBy("batch_id").agg(F.max_by("state", "at").alias("last_run"))
    pointers = newest_versions(spark, f"{base}/batch_id=*")
    found = [(root.rpartition("batch_id=")[2], *[v.note[k] for k in ("state", ACCEPTED, QUARANTINED)]) for root, v in pointers]
    in_force = spark.createDataFrame(found, "batch_id string, state string, accepted string, quarantined string")
    counts = [F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) for c in (ACCEPTED, QUARANTINED)]
    return in_force.join(last, "batch_id", "full").select("batch_id", F.coalesce("state", "last_run").alias("state"), *counts, "last_run")


def _record(spark: SparkSession, base: str, batch_id: str, state: str) -> None:
    """One small file per event, whole or not at all; it needs no Spark job."""
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    line = json.dumps({"batch_id": batch_id, "state": state, "at": now.isoformat()})
    write_text(spark, f"{base}/_batches/{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}.json", line)


def _routed_schema(schema: T.StructType) -> T.StructType:
    more = [T.StructField(REJECTED, T.MapType(T.StringType(), T.StringType())), T.StructField("rejection_reasons", T.ArrayType(T.StringType()))]
    return T.StructType([*schema.fields, *more])


def process_vendor_batch(
    df: DataFrame,
    base: str,
    batch_id: str,
    log: RunLog,
    name: str = "batch",
    rules: Sequence[Rule] = VENDOR_LAB_RULES,
    schema: T.StructType = VENDOR_LAB,
    mode: str = "replace",
    keys: Sequence[str] = KEYS,
) -> BatchResult:
    """Route one batch and log start, drift, counts and any failure."""
    # The step name and the log messages below are fixed values.
    run = make_run_id(batch_id)
    log.event(run, STEP, "INFO", f"Processing vendor batch: {name} as {batch_id}")
    try:
        drift = detect_drift(df, schema)
        if drift.drifted:
            log.event(
                run,
                STEP,
                "WARN",
                f"Schema drift detected: incoming has {drift.incoming} columns, expected {drift.expected}",
                {"incoming_cols": drift.incoming, "expected_cols": drift.expected},
            )
        result = route_batch(df, base, batch_id, rules, schema, mode, keys)
        log.event(
            run,
            STEP,
            "INFO",
            f"Batch complete: {result.accepted} accepted, {result.quarantined} quarantined",
            {"accepted": result.accepted, "quarantined": result.quarantined, "batch_id": batch_id},
        )
        if result.quarantined:
            log.event(run, STEP, "WARN", f"{result.quarantined} rows quarantined - review the quarantine table")
    except Exception as exc:
        text = str(exc).split("\n", 1)[0]
        log.event(run, STEP, "ERROR", f"Batch processing failed: {text}")
        result = BatchResult(batch_id, "FAILED", error=text)
    log.flush()
    return result
